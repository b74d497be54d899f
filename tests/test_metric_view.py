"""Metric views: grain, join choice and spec loading."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from small import by, rows

from tributary.operators.metric_view import MetricView, load_spec
from tributary.plans import semantic

SPEC = """
source: fact
joins:
  - name: jobs
    source: dim_jobs
    "on": source.job = jobs.job
    joins:
      - name: clients
        source: dim_clients
        "on": jobs.client = clients.client
dimensions:
  - {name: day, expr: source.day, display_name: Day}
  - {name: category, expr: jobs.category}
  - {name: company, expr: "concat(jobs.clients.company, ' jobs.x')"}
measures:
  - {name: shown, expr: COUNT(source.shown)}
  - {name: ctr, expr: "try_divide(COUNT(source.clicked), COUNT(source.shown))", synonyms: [Click Rate]}
"""


@pytest.fixture(scope="module")
def view(spark):
    return MetricView(
        load_spec(SPEC),
        {
            "fact": spark.createDataFrame(
                [(1, "j1", 1, 1), (1, "j2", 1, None), (2, "j1", 1, None), (2, None, None, None), (2, "j9", 1, 1)],
                "day int, job string, shown int, clicked int",
            ),
            "dim_jobs": spark.createDataFrame(
                [("j1", "Data", "c1"), ("j2", "Design", "c1")], "job string, category string, client string"
            ),
            "dim_clients": spark.createDataFrame([("c1", "Acme")], "client string, company string"),
        },
    )


def _joins(df) -> int:
    return df._jdf.queryExecution().analyzed().toString().count("Join ")


def test_measures_follow_the_grain(view):
    assert rows(view.query(measures=["shown", "ctr"])) == [{"shown": 4, "ctr": 0.5}]
    got = by(view.query(["category"], ["shown", "ctr"]), "category")
    assert (got["Data"]["shown"], got["Data"]["ctr"]) == (2, 0.5)
    assert (got[None]["shown"], got[None]["ctr"]) == (1, 1.0)
    fine = rows(view.query(["day", "category"], ["shown"]))
    assert sum(r["shown"] for r in fine) == 4


def test_only_needed_joins_are_made(view):
    assert _joins(view.query(["day"], ["shown"])) == 0
    assert _joins(view.query(["category"], ["shown"])) == 1
    assert _joins(view.query(["company"], ["shown"])) == 2


def test_nested_names_and_literals(view):
    got = {r["company"] for r in rows(view.query(["company"]))}
    assert got == {"Acme jobs.x", None}


def test_adding_up_first_changes_no_result(spark, view):
    spec = load_spec(SPEC)
    spec["measures"] = [
        {
            "name": "shown",
            "expr": "COUNT(source.shown)",
            "parts": {"n": "COUNT(source.shown)"},
            "combine": "COALESCE(SUM(source.n), 0)",
        },
        {
            "name": "ctr",
            "expr": "try_divide(COUNT(source.clicked), COUNT(source.shown))",
            "parts": {"n": "COUNT(source.shown)", "c": "COUNT(source.clicked)"},
            "combine": "try_divide(SUM(source.c), SUM(source.n))",
        },
    ]
    adding = MetricView(spec, view.tables)
    for dimensions in ([], ["day"], ["category"], ["day", "company"]):
        for where in (None, "source.day = 2", "jobs.category = 'Data' AND source.day = 1", "source.day = 9"):
            got, want = (v.query(dimensions, ["shown", "ctr"], where) for v in (adding, view))
            assert sorted(map(str, rows(got))) == sorted(map(str, rows(want))), (dimensions, where)
    assert {r["category"] for r in rows(adding.query(["category"]))} == {"Data", "Design", None}
    plan = adding.query(["category"], ["ctr"])._jdf.queryExecution().analyzed().toString()
    assert plan.index("Join ") < plan.rindex("Aggregate ")


def test_where_and_metadata(view):
    df = view.query(["day"], ["shown"], where="jobs.category = 'Data'")
    assert sorted((r["day"], r["shown"]) for r in rows(df)) == [(1, 1), (2, 1)]
    assert df.schema["day"].metadata == {"display_name": "Day"}


def test_key_check_finds_repeated_keys(spark, view):
    assert rows(view.check_keys()) == []
    twice = dict(view.tables, dim_jobs=view.tables["dim_jobs"].union(view.tables["dim_jobs"]))
    assert {r["key"] for r in rows(MetricView(load_spec(SPEC), twice).check_keys())} == {"j1", "j2"}


def test_spec_must_be_complete():
    with pytest.raises(ValueError, match="measures"):
        load_spec("source: fact")


def test_clickstream_view_has_all_fields():
    assert len(semantic.CLICKSTREAM["dimensions"]) == 30
    assert [m["name"] for m in semantic.CLICKSTREAM["measures"]] == ["total_impressions", "CTR"]
    assert {m["name"] for m in semantic.CLIENT_PORTFOLIO["measures"]} >= {"clients_tracked", "unique_categories"}


def test_expressions_parse(spark):
    for spec in (semantic.CLIENT_PORTFOLIO, semantic.SEARCH_FUNNEL, semantic.POSITION_BIAS):
        for item in spec["dimensions"] + spec["measures"]:
            F.expr(item["expr"])
