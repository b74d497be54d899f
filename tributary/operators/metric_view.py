"""Metric views: measures defined once, evaluated at the grain of each query."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LITERAL = r"'(?:[^']|'')*'"


@dataclass(frozen=True)
class Field:
    """A dimension or a measure: SQL expression and display metadata.

    A measure that can be added up has `parts`, aggregates over source columns by
    name, and `combine`, the measure over the sums of these parts.
    """

    name: str
    expr: str
    meta: dict = field(default_factory=dict)
    parts: dict[str, str] = field(default_factory=dict)
    combine: str | None = None


@dataclass(frozen=True)
class Join:
    """A many-to-one left join; `path` is its name below its parents, `on` uses local names."""

    path: tuple[str, ...]
    source: str
    on: str

    @property
    def alias(self) -> str:
        return "__".join(self.path)


class MetricView:
    """A source, its joins, named dimensions and named measures.

    `tables` gives the DataFrame for each source name of the spec. The joined
    tables must hold one row per join key (`check_keys` tests it); then a join no
    selected field refers to can be left out, and is. Where all measures can be
    added up, the source is added up to the join keys first, so the joins see
    one row per key and not every event.
    """

    def __init__(self, spec: dict, tables: dict[str, DataFrame]):
        self.source: DataFrame = tables[spec["source"]]
        self.tables = tables
        self.joins: list[Join] = list(_flatten(spec.get("joins", []), ()))
        self.dimensions = _fields(spec.get("dimensions", []))
        self.measures = _fields(spec.get("measures", []))

    def _localise(self, text: str, scope: list[tuple[str, str]]) -> tuple[str, set[str]]:
        """Replace dotted join names by aliases; return the text and the aliases it uses."""
        aliases = dict(scope)
        names = sorted(aliases, key=len, reverse=True)
        pattern = _LITERAL + r"|(?<![\w.`])(" + "|".join(map(re.escape, names)) + r")\."
        used: set[str] = set()

        def swap(match: re.Match) -> str:
            if match.group(1) is None:
                return match.group(0)
            used.add(aliases[match.group(1)])
            return aliases[match.group(1)] + "."

        return re.sub(pattern, swap, text), used

    @property
    def _paths(self) -> list[tuple[str, str]]:
        return [("source", "source")] + [(".".join(j.path), j.alias) for j in self.joins]

    def _needed(self, used: set[str]) -> list[tuple[Join, str]]:
        """The joins in `used` and their parents, each with its condition over aliases."""
        needed = {
            "__".join(j.path[: depth + 1]) for j in self.joins if j.alias in used for depth in range(len(j.path))
        }
        found = []
        for join in self.joins:
            if join.alias in needed:
                parents = [(join.path[d], "__".join(join.path[: d + 1])) for d in range(len(join.path))]
                found.append((join, self._localise(join.on, [("source", "source"), *parents])[0]))
        return found

    def _joined(self, source: DataFrame, joins: list[tuple[Join, str]]) -> DataFrame:
        df = source.alias("source")
        for join, on in joins:
            df = df.join(self.tables[join.source].alias(join.alias), F.expr(on), "left")
        return df

    def _added_up(self, source: DataFrame, texts: list[str], measures: list[Field]) -> DataFrame:
        """The source per combination of the columns in `texts`, with the parts of the measures."""
        columns = sorted({c for text in texts for c in _source_columns(text)})
        parts = {name: expr for m in measures for name, expr in m.parts.items()}
        keys = [F.col(f"source.{c}").alias(c) for c in columns]
        if not parts:
            return source.alias("source").select(*keys).distinct()
        return source.alias("source").groupBy(*keys).agg(*[F.expr(e).alias(n) for n, e in parts.items()])

    def query(
        self,
        dimensions: list[str] | None = None,
        measures: list[str] | None = None,
        where: str | None = None,
    ) -> DataFrame:
        """Measures at the grain of the dimensions; `where` filters the joined rows.

        In `where` a dimension is written as its expression, like in the spec.
        """
        chosen = [self.dimensions[d] for d in dimensions or []]
        chosen_measures = [self.measures[m] for m in measures or []]
        used: set[str] = set()

        def local(text: str) -> str:
            out, names = self._localise(text, self._paths)
            used.update(names)
            return out

        dimension_texts = [local(d.expr) for d in chosen]
        measure_texts = [local(m.expr) for m in chosen_measures]
        filter_uses: set[str] = set()
        if where:
            where, filter_uses = self._localise(where, self._paths)
            used.update(filter_uses)
        joins = self._needed(used)
        source = self.source
        additive = all(m.combine for m in chosen_measures)
        if joins and additive and filter_uses <= {"source"}:
            if where:
                source, where = source.alias("source").filter(where), None
            source = self._added_up(source, [*dimension_texts, *(on for _, on in joins)], chosen_measures)
            measure_texts = [m.combine for m in chosen_measures]
        rows = self._joined(source, joins)
        if where:
            rows = rows.filter(where)
        keys = [F.expr(t).alias(d.name, metadata=d.meta) for t, d in zip(dimension_texts, chosen)]
        values = [F.expr(t).alias(m.name, metadata=m.meta) for t, m in zip(measure_texts, chosen_measures)]
        if not values:
            return rows.select(*keys).distinct()
        return rows.groupBy(*keys).agg(*values) if keys else rows.agg(*values)

    def check_keys(self) -> DataFrame:
        """Join keys that occur more than once; empty when every join is many-to-one."""
        found = None
        for join in self.joins:
            key = _dimension_key(join)
            repeated = (
                self.tables[join.source]
                .filter(F.col(key).isNotNull())
                .groupBy(F.col(key).cast("string").alias("key"))
                .count()
                .filter("count > 1")
                .select(F.lit(join.alias).alias("join_name"), "key", "count")
            )
            found = repeated if found is None else found.unionByName(repeated)
        return found


def _dimension_key(join: Join) -> str:
    """Column of the joined table in an `a.x = b.y` condition."""
    name = join.path[-1]
    found = re.findall(rf"(?<![\w.]){re.escape(name)}\.(\w+)", join.on)
    if len(found) != 1:
        raise ValueError(f"join {name} must compare exactly one of its columns")
    return found[0]


def _flatten(joins: list[dict], parents: tuple[str, ...]):
    for join in joins:
        path = (*parents, join["name"])
        yield Join(path, join["source"], join["on"])
        yield from _flatten(join.get("joins", []), path)


def _source_columns(text: str) -> set[str]:
    """Columns of the source an expression reads."""
    return {m.group(1) for m in re.finditer(_LITERAL + r"|(?<![\w.`])source\.(\w+)", text) if m.group(1)}


def _fields(items: list[dict]) -> dict[str, Field]:
    own = ("name", "expr", "parts", "combine")
    return {
        i["name"]: Field(
            i["name"],
            i["expr"],
            {k: v for k, v in i.items() if k not in own},
            i.get("parts", {}),
            i.get("combine"),
        )
        for i in items
    }


def load_spec(text: str) -> dict:
    """Read a metric view spec from YAML text."""
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading a YAML spec needs the yaml package") from error
    spec = yaml.safe_load(text)
    missing = {"source", "measures"} - set(spec)
    if missing:
        raise ValueError(f"metric view spec lacks {sorted(missing)}")
    return spec
