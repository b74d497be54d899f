"""Language identification by character models with interpolated Kneser-Ney smoothing.

Texts are folded to lower-case letters and single blanks, four characters make one gram of 64
bits (16 per character). Counts of the highest order are summed by Spark over all documents
that may be learned from; lower orders are continuation counts of it, and counts, discounts and
probabilities are made of all grams, however rare. The model lies in the shared folder: per order
the interpolated log probabilities of every language, sorted by hash and cut into parts by it;
what a language has not seen is backed off. A batch of texts asks for each of its distinct grams
once, part by part; a worker keeps `CACHE_BYTES` of parts and reads the others when they are asked
for. The driver knows the languages, their discounts and the names of the parts. A text gets the
language with the lowest cross-entropy per character.

Rejection is calibrated on all learned documents: how far their cross-entropy lies above their
language's mean, in units of its spread at their length. Spark aggregates medians and the limit over
values rounded to `STEPS` decimals (lengths to that many of their logarithm), so a group holds few
distinct ones. A language with fewer than `LEAST_ROWS` documents takes the mean, spread and limit of the
documents of all languages together.

Learned from: text and non-null lang of rows whose crc32(doc_id as text) mod 3 is not 1 (a null doc_id is
neither learned from nor held out). A null text, or one without a letter, is `und` with score
0 and rejected. If nothing can be learned, every text is `und`. Ties go to the language that
sorts first. Repeated rows are predicted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.storage import free_name, importable, join_path, keeping, open_folder, stored, tidy
from tributary.llm.text import mix
from tributary.session import scratch_dir

ORDER = 4
BLANK = 32
# Documents from which a language has limits of its own, and decimals of what its quantiles are taken of.
LEAST_ROWS = 20
STEPS = 3
# Numbers in one part of a model (grams times languages), and bytes of parts that a worker keeps.
PART_NUMBERS = 1 << 18
CACHE_BYTES = 192 << 20
UNDETERMINED = "und"
# Spreads above the mean at which a text is in no learned language: at least this many, and
# this many times what the sample shows.
LEAST_SPREADS = 6.0
MARGIN = 1.5
# Characters of evidence that the score of a prediction counts at most.
EVIDENCE = 40
# Stands for all languages together.
POOL = -1


@lru_cache(maxsize=1)
def folding() -> tuple[np.ndarray, np.ndarray]:
    """Per code point its folded 16-bit symbol, and whether it is a letter."""
    symbols = np.full(0x110000, BLANK, np.uint16)
    letters = np.zeros(0x110000, bool)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LM":
            low = chr(code).lower()
            # Characters beyond 16 bits share symbols.
            symbols[code] = (ord(low) if len(low) == 1 else code) % 0xFFF1
            letters[code] = kind == "L"
    return symbols, letters


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of all texts in a row, where each text's begin, and which texts have a letter.

    Every text is led by three blanks, so each character has a full context.
    """
    table, letters = folding()
    lead = " " * (ORDER - 1)
    codes = np.frombuffer((lead + lead.join(texts)).encode("utf-32-le", "replace"), np.uint32)
    lengths = np.fromiter((len(t) + len(lead) for t in texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    symbols = table[codes].astype(np.uint64)
    inside = np.ones(len(codes), bool)
    for i in range(len(lead)):
        inside[starts[:-1] + i] = False
    # A blank after a blank says nothing; the leading ones are kept as context.
    keep = ~inside
    keep[1:] |= (symbols[1:] != BLANK) | (symbols[:-1] != BLANK)
    keep[0] = True
    position = np.concatenate(([0], np.cumsum(keep)))
    has = np.concatenate(([0], np.cumsum(letters[codes])))
    with_letter = has[starts[1:]] > has[starts[:-1]]
    symbols, inside, starts = symbols[keep], inside[keep], position[starts]
    grams = symbols.copy()
    for i in range(1, ORDER):
        grams[i:] |= symbols[:-i] << np.uint64(16 * i)
    ends = np.cumsum(np.concatenate(([0], inside)))
    return grams[inside], ends[starts], with_letter


def slices(texts: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a million characters."""
    begin = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all documents that may be learned from."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        # Sums of one task; handed on when they get large.
        sums: dict[str, dict[int, int]] = {}

        def out():
            for lang, own in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own)), pa.array(np.fromiter(own, np.uint64, len(own)).view(np.int64)), pa.array(own.values(), pa.int64())],
                    names=["lang", "gram", "n"],
                )
            sums.clear()

        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                part = [t for t, at in zip(texts, langs) if at == lang]
                own = sums.setdefault(lang, {})
                for begin, end in slices(part):
                    found, counts = np.unique(folded(part[begin:end])[0], return_counts=True)
                    for gram, n in zip(found.tolist(), counts.tolist()):
                        own[gram] = own.get(gram, 0) + n
            if sum(map(len, sums.values())) > 1_000_000:
                yield from out()
        yield from out()

    learned = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    rows = learned.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# Parts that this process keeps, by path; once full, others are read each time.
_kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}
KEEPER = "language"


def keep(key: str, part: tuple[np.ndarray, np.ndarray], size: int) -> None:
    """Keep a part if there is room for it."""
    if sum(h.nbytes + r.nbytes for h, r in _kept.values()) + size <= CACHE_BYTES:
        _kept[key] = part
        keeping(KEEPER, _kept.clear)


class Shelf:
    """Rows by hash in files of the shared folder, one file per leading part of the hash."""

    def __init__(self, folder: str, bits: int, width: int, files: dict[int, tuple[str, int]]) -> None:
        self.folder, self.bits, self.width, self.files = folder, bits, width, files
        self.sizes = np.array([files.get(part, ("", 0))[1] for part in range(1 << bits)], np.int64)

    def part(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes and rows of one part."""
        name, size = self.files[number]
        key = join_path(self.folder, name)
        if key in _kept:
            return _kept[key]
        files, path = open_folder(self.folder)
        with files.open_input_stream(join_path(path, name), compression=None) as source:
            data = source.read()
        found = np.frombuffer(data, np.uint64, size), np.frombuffer(data, np.float32, offset=8 * size).reshape(size, self.width)
        keep(key, found, len(data))
        return found

    def hits(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per part: its number, which keys lie in it, where, and their rows."""
        hashes = mix(keys)
        order = np.argsort(hashes)
        starts = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        edges = np.append(np.searchsorted(hashes[order], starts), len(keys))
        for number in np.flatnonzero((np.diff(edges) > 0) & (self.sizes > 0)):
            at = order[edges[number] : edges[number + 1]]
            own, rows = self.part(int(number))
            place = np.minimum(np.searchsorted(own, hashes[at]), len(own) - 1)
            same = own[place] == hashes[at]
            yield int(number), at[same], place[same], rows[place[same]]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key's row, -1 if there is none."""
        out = np.full(len(keys), -1, np.int64)
        before = np.cumsum(self.sizes) - self.sizes
        for number, at, place, _ in self.hits(keys):
            out[at] = before[number] + place
        return out

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys there are, and their rows; zeros for the others."""
        known, out = np.zeros(len(keys), bool), np.zeros((len(keys), self.width), np.float32)
        for _, at, _, rows in self.hits(keys):
            known[at] = True
            out[at] = rows
        return known, out

    @property
    def hashes(self) -> np.ndarray:
        """All hashes in order; only for small models."""
        return np.concatenate([self.part(number)[0] for number in sorted(self.files)])


def shelved(rows: DataFrame, count: int, width: int, build: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> Shelf:
    """The shelf of what `build` makes of the rows of each part; the rows' `gram` says in which they lie."""
    bits = max(1, int(count * width // PART_NUMBERS).bit_length())
    folder = scratch_dir(rows.sparkSession, "language-model")
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)

    def place(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("gram").to_numpy().view(np.uint64)
            part = (mix(keys) >> np.uint64(64 - bits)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns], names=["part", *batch.schema.names])

    def write(batches) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)

        def put(part: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
            keys, values = build(pa.Table.from_batches(held))
            hashes = mix(keys)
            order = np.argsort(hashes)
            # A name of its own: only files of successful attempts are read.
            name = f"{part}-{uuid.uuid4().hex}"
            with files.open_output_stream(join_path(path, name), compression=None) as sink:
                sink.write(hashes[order].tobytes())
                sink.write(values[order].astype(np.float32).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(keys)], pa.int64())], names=["part", "name", "size"])

        # Rows come sorted by part; the last one of a batch may go on in the next.
        now, held = -1, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(parts)) + 1
            for a, b in zip([0, *edges], [*edges, len(parts)]):
                if b > a:
                    if held and parts[a] != now:
                        yield put(now, held)
                        held = []
                    now = int(parts[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield put(now, held)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = rows.mapInArrow(tidy(place, KEEPER), f"part int, {schema}").repartition("part").sortWithinPartitions("part")
    found = placed.mapInArrow(tidy(write, KEEPER), "part int, name string, size long").collect()
    return Shelf(folder, bits, width, {r["part"]: (r["name"], r["size"]) for r in found})


class Model:
    """Interpolated Kneser-Ney models of all languages on shared shelves."""

    def __init__(self, langs: list[str], symbols: int) -> None:
        self.langs = langs
        size = len(langs)
        self.floor = -np.log(max(2, symbols + 1))
        self.tables: list[Shelf] = []
        self.backoff: list[Shelf] = []
        self.mean = np.zeros(size)
        self.noise = np.ones(size)
        self.spread = np.full(size, 0.05)
        self.limit = np.full(size, np.inf)

    def add_order(self, rows: DataFrame, count: int, discounts: dict[str, float]) -> None:
        """The next order, of all its `count` rows lang, gram, n."""
        size, order = len(self.langs), len(self.tables) + 1
        index = {lang: i for i, lang in enumerate(self.langs)}
        discount = np.array([discounts[lang] for lang in self.langs])
        context = F.shiftrightunsigned("gram", 16)

        def owners(rows: pa.Table) -> np.ndarray:
            codes = rows.column("lang").combine_chunks().dictionary_encode()
            codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
            return np.array([index[x] for x in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()]

        def column(rows: pa.Table, name: str) -> np.ndarray:
            return rows.column(name).to_numpy().astype(float)

        def left(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            """What the contexts of each language leave for the shorter gram."""
            keys, place = np.unique(rows.column("gram").to_numpy().view(np.uint64), return_inverse=True)
            owner, kept = owners(rows), np.ones((len(keys), size))
            kept[place, owner] = discount[owner] * column(rows, "types") / column(rows, "total")
            return keys, np.log(np.maximum(kept, 1e-12))

        contexts = rows.groupBy("lang", context.alias("gram")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        self.backoff.append(shelved(contexts, count, size, left))

        def probabilities(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(rows.column("gram").to_numpy().view(np.uint64), return_inverse=True)
            owner, direct = owners(rows), np.zeros((len(keys), size))
            direct[place, owner] = np.maximum(column(rows, "n") - discount[owner], 0) / column(rows, "total")
            kept = self.backoff[order - 1].rows(keys >> np.uint64(16))[1]
            full = direct + np.exp(kept.astype(float) + self._lower(keys, order))
            return keys, np.log(np.maximum(full, 1e-12))

        total = F.sum("n").over(Window.partitionBy("lang", "context"))
        known = rows.withColumn("context", context).withColumn("total", total).select("lang", "gram", "n", "total")
        self.tables.append(shelved(known, count, size, probabilities))

    def _lower(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Log probabilities of the grams without their first character."""
        if order == 1:
            return np.full((len(keys), len(self.langs)), self.floor)
        return self.log_probabilities(keys & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)

    def log_probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Per gram and language; what no language has seen is backed off."""
        known, out = self.tables[order - 1].rows(keys)
        missing = np.flatnonzero(~known)
        if len(missing):
            unseen, back = np.unique(keys[missing], return_inverse=True)
            left = self.backoff[order - 1].rows(unseen >> np.uint64(16))[1]
            out[missing] = (left + self._lower(unseen, order))[back]
        return out

    def settle(self) -> None:
        """Drop the parts of other models that this process still keeps."""
        own = tuple(f"{shelf.folder}/" for shelf in [*self.tables, *self.backoff])
        for key in [key for key in _kept if not key.startswith(own)]:
            del _kept[key]

    def batch(self) -> int:
        """Characters whose distinct grams are looked up together."""
        return max(1 << 16, (1 << 26) // max(1, len(self.langs)))

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text and language; characters of each text; which have a letter."""
        pieces = []
        for begin, end in slices(texts):
            grams, edges, with_letter = folded(texts[begin:end])
            codes = pa.array(grams).dictionary_encode()
            pieces.append((codes.dictionary.to_numpy(), codes.indices.to_numpy(), edges, with_letter))
        # Each distinct gram of all texts is looked up once.
        union = np.unique(np.concatenate([p[0] for p in pieces])) if pieces else np.zeros(0, np.uint64)
        values = self.log_probabilities(union)
        step = max(1, (1 << 22) // max(1, len(self.langs)))
        sums, n, letters = [np.zeros((0, len(self.langs)))], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for own, place, edges, with_letter in pieces:
            rows = np.searchsorted(union, own)
            total = np.zeros((len(edges) - 1, len(self.langs)))
            for a in range(0, len(place), step):
                b = min(len(place), a + step)
                first, last = np.searchsorted(edges, [a, b - 1], "right") - 1
                some = first + np.flatnonzero(np.diff(edges[first : last + 2]) > 0)
                total[some] += np.add.reduceat(values[rows[place[a:b]]], np.maximum(edges[some], a) - a, axis=0, dtype=np.float64)
            sums.append(total)
            n.append(np.diff(edges))
            letters.append(with_letter)
        n = np.concatenate(n)
        return -np.concatenate(sums) / np.maximum(n, 1)[:, None], n, np.concatenate(letters)

    def calibrate(self, measured: DataFrame) -> None:
        """Mean, spread and limit per language from rows place, n, entropy of its own documents."""
        own = {r["place"]: r["rows"] for r in measured.groupBy("place").agg(F.count(F.lit(1)).alias("rows")).collect()}
        if not own:
            return
        scarce = [lang for lang in range(len(self.langs)) if own.get(lang, 0) < LEAST_ROWS]
        if scarce:
            measured = measured.unionAll(measured.withColumn("place", F.lit(POOL).cast("long")))
        measured = measured.withColumn("length", F.round(F.log(F.greatest("n", F.lit(1))), STEPS))

        def per_place(aggregated: DataFrame, name: str) -> F.Column:
            # A literal, one number per language: a join would bring all rows of a language to one task.
            found = {r["place"]: r[name] for r in aggregated.collect()}
            return F.map_from_arrays(F.lit([int(p) for p in found]).cast("array<bigint>"), F.lit([float(v) for v in found.values()]).cast("array<double>"))[F.col("place")]

        def median(of: F.Column) -> F.Column:
            return F.percentile(F.round(of, STEPS + 1), 0.5)

        halves = measured.groupBy("place").agg(F.percentile("length", 0.5).alias("half"))
        rows = measured.withColumn("long", F.col("length") >= per_place(halves, "half"))
        middles = rows.filter("long").groupBy("place").agg(median(F.col("entropy")).alias("middle"))
        rows = rows.withColumn("middle", per_place(middles, "middle"))
        # The spread of single characters, from the shorter half.
        away = F.abs(F.col("entropy") - F.col("middle"))
        widths = rows.groupBy("place").agg(
            median(F.when(F.col("long"), away)).alias("away"), median(F.when(~F.col("long"), away * F.sqrt("n"))).alias("noise")
        )
        widths = widths.select(
            "place",
            F.greatest(F.lit(0.02), 1.4826 * F.col("away")).alias("spread"),
            F.when(F.col("noise").isNull(), 1.0).otherwise(F.greatest(F.lit(0.5), F.col("noise") / float(np.sqrt(0.4549)))).alias("noise"),
        )
        widths = stored(measured.sparkSession, widths, "language-widths")
        rows = rows.withColumn("spread", per_place(widths, "spread")).withColumn("noise", per_place(widths, "noise"))
        width = F.sqrt(F.col("spread") ** 2 + F.col("noise") ** 2 / F.greatest("n", F.lit(1)))
        above = F.percentile(F.round((F.col("entropy") - F.col("middle")) / width, STEPS), 0.999)
        found = rows.groupBy("place").agg(
            F.first("middle").alias("mean"), F.first("spread").alias("spread"), F.first("noise").alias("noise"), above.alias("above")
        )
        by_place = {r["place"]: r for r in found.collect()}
        for lang in range(len(self.langs)):
            own = by_place[POOL if lang in scarce else lang]
            self.mean[lang], self.spread[lang], self.noise[lang] = own["mean"], own["spread"], own["noise"]
            self.limit[lang] = max(LEAST_SPREADS, MARGIN * own["above"])

    def spreads(self, entropy: np.ndarray, n: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """How many spreads above the language's mean."""
        width = np.sqrt(self.spread[lang] ** 2 + self.noise[lang] ** 2 / np.maximum(n, 1))
        return (entropy - self.mean[lang]) / width

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the language (-1: undetermined), score, rejected."""
        if not self.langs:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, n, with_letter = self.cross_entropies(texts)
        best = entropy.argmin(axis=1)
        lead = (entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(n, EVIDENCE)[:, None]
        score = 1 / np.exp(-lead).sum(axis=1)
        rejected = ~with_letter | (self.spreads(entropy.min(axis=1), n, best) > self.limit[best])
        return np.where(with_letter, best, -1), np.where(with_letter, score, 0.0), rejected


def fitted(docs: DataFrame) -> Model:
    """The model of all grams of the documents that may be learned from."""
    spark = importable(docs.sparkSession)
    levels = [stored(spark, gram_counts(docs), "grams")]
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: in how many distinct left extensions a shorter gram occurs.
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))
        levels.insert(0, stored(spark, levels[0].groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams"))
    discounts, counts = [], []
    for level in levels:
        found = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"), F.count(F.lit(1)).alias("all")).collect()
        discounts.append({r["lang"]: r["once"] / (r["once"] + 2 * r["twice"]) if r["once"] and r["twice"] else 0.5 for r in found})
        counts.append(sum(r["all"] for r in found))
    model = Model(sorted(discounts[0]), levels[0].select("gram").distinct().count())
    if model.langs:
        for level, own, count in zip(levels, discounts, counts):
            model.add_order(level, count, own)
    return model


def train(docs: DataFrame) -> Model:
    """Model of the documents that may be learned from, with its limits."""
    model = fitted(docs)
    if not model.langs:
        return model
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def measure(batches) -> Iterator[pa.RecordBatch]:
        own = shared.value
        own.settle()
        index = {lang: i for i, lang in enumerate(own.langs)}
        for batch in batches:
            # A language all of whose texts are blank has no model.
            known = [(index[x], t) for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if x in index]
            texts = [t for _, t in known]
            for begin, end in slices(texts, own.batch()):
                entropy, n, _ = own.cross_entropies(texts[begin:end])
                at = np.array([i for i, _ in known[begin:end]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(n, pa.int64()), pa.array(entropy[np.arange(len(at)), at], pa.float64())],
                    names=["place", "n", "entropy"],
                )

    texts = rows.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    measured = stored(spark, texts.mapInArrow(tidy(measure, KEEPER), "place long, n long, entropy double"), "language-entropies")
    model.calibrate(measured.filter("n > 0"))
    return model


def identified(spark: SparkSession, docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """All columns of `docs`, and a struct as the last one: lang_pred, score, rejected."""
    importable(spark)
    shared = spark.sparkContext.broadcast(model)
    own_name = free_name(docs, name)
    place = docs.columns.index("text")
    fields = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())]

    def predict(batches) -> Iterator[pa.RecordBatch]:
        own = shared.value
        own.settle()
        names = np.array([*own.langs, UNDETERMINED], object)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(place).to_pylist()]
            for begin, end in slices(texts, own.batch()):
                lang, score, rejected = own.predict(texts[begin:end])
                found = pa.StructArray.from_arrays([pa.array(names[lang].tolist(), pa.string()), pa.array(score), pa.array(rejected)], fields=fields)
                columns = [c.slice(begin, end - begin) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*batch.schema.names, own_name])

    from pyspark.sql import types as T

    struct = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(tidy(predict, KEEPER), T.StructType([*docs.schema.fields, T.StructField(own_name, struct)]))
