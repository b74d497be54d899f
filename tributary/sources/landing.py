"""The CSV landing zone: one sub-folder per dataset, new files added over time.

Every file names its columns in its first line, in any order. Headers are data: files are read as
lines, the first line of each is found where the file begins, and rows are joined to the header of their file, all of
it by the executors, so a file may arrive at any time and no job is run for a single file.
Values are found by the names in the header and converted here. What does not fit is kept in
`_rescued_data` as JSON: values of the wrong type, columns that are not declared, and,
under `_line`, the whole line of a row with more or fewer fields than its header. Blank lines are no rows, and
neither is a line that repeats its file's header, as in files that were joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tributary.operators.rollup import tally
from tributary.schemas import INGESTED_AT, RAW, RESCUED, SOURCE_FILE
from tributary.session import CLEANED, settings

DEFAULT_ROOT = "/data/landing"
ROOT_SETTING = "raw_data_path"
_LINE = "_line"
_START = "_start"
_BROKEN = "_broken"

# Files a stream takes in per micro-batch; a backlog is worked off in several.
FILES_PER_BATCH = 10_000
# Rows in a file that `write_landing` writes: files are compressed, and a task reads a compressed file as a whole.
ROWS_PER_FILE = 250_000
# A comma outside of quotes: an even number of quotes follows.
_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def landing_root(spark: SparkSession, root: str | None = None) -> str:
    """The landing folder: the argument, else the session setting, else the default."""
    return root or spark.conf.get(ROOT_SETTING, DEFAULT_ROOT)


def lines_of(reader, folder: str) -> DataFrame:
    """Lines of text files, with their file and where in it their block begins. For a batch or a stream reader."""
    return (
        reader.text(folder)
        .withColumns({SOURCE_FILE: F.col("_metadata.file_path"), _START: F.col("_metadata.file_block_start")})
        .withColumnRenamed("value", _LINE)
        .filter(F.trim(_LINE) != "")
    )


def headers_of(lines: DataFrame) -> DataFrame:
    """One row per file: its first line and the column names in it.

    A file's first line is the first of the block at its beginning; blocks are read in order.
    """
    begun = lines.filter(F.col(_START) == 0).withColumn("_place", F.monotonically_increasing_id())
    first = tally(begun, SOURCE_FILE, _first=F.min_by(_LINE, "_place"))

    def unquoted(name: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(name, '^"(.*)"$', "$1"), '""', '"')

    return first.withColumn("_header", F.transform(F.split("_first", _COMMA, -1), unquoted))


def widest(headers: DataFrame) -> int:
    """Fields of the widest header."""
    return headers.agg(F.coalesce(F.max(F.size("_header")), F.lit(0))).first()[0]


def _fields_in(line: Column) -> Column:
    """Fields of a CSV line; a quoted one counts as one."""
    return F.size(F.split(F.regexp_replace(line, '"([^"]|"")*"', "q"), ","))


def converted(lines: DataFrame, headers: DataFrame, schema: StructType) -> DataFrame:
    """Lines as rows of declared columns, by the names in the header of each line's file.

    The headers are one row per file, far fewer than lines: they are looked up by file,
    and Spark sends them to all tasks if they are small.
    """
    fields = max(1, widest(headers))
    names = [f.name for f in schema.fields]
    # Where the declared columns are is settled per file, not per row.
    places = F.array(*[F.nullif(F.array_position("_header", n), F.lit(0)).cast("int") for n in names])
    foreign = F.exists("_header", lambda n: ~n.isin(names))
    looked_up = headers.withColumns({"_places": places, "_foreign": F.coalesce(foreign, F.lit(False))})
    rows = lines.join(looked_up, SOURCE_FILE).filter(F.col(_LINE) != F.col("_first"))
    text = ", ".join(f"_c{i} string" for i in range(fields))
    options = {"nullValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    rows = rows.withColumn("_parsed", F.from_csv(_LINE, f"{text}, {_BROKEN} string", options))
    values = F.array(*[F.col(f"_parsed._c{i}") for i in range(fields)])
    # The parser marks every line that has not the number of fields of the widest header.
    broken = F.when(_fields_in(F.col(f"_parsed.{_BROKEN}")) != F.size("_header"), F.col(_LINE))
    rows = rows.select("_header", "_places", "_foreign", SOURCE_FILE, values.alias("_values"), broken.alias(_LINE))
    found = {n: F.try_element_at("_values", F.col("_places")[i]) for i, n in enumerate(names)}
    rows = rows.select("_header", "_foreign", "_values", SOURCE_FILE, _LINE, *[c.alias(n) for n, c in found.items()])
    # Of the values that do not fit and of the columns nobody declared, those that say something.
    unfit = {
        f.name: F.when(F.col(f.name).try_cast(f.dataType).isNull(), F.col(f.name))
        for f in schema.fields
        if not isinstance(f.dataType, StringType)
    }
    wrong = [F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in unfit.items()]
    pairs = F.arrays_zip(F.col("_header").alias("key"), F.slice("_values", F.lit(1), F.size("_header")).alias("value"))
    unknown = F.filter(pairs, lambda p: ~p["key"].isin(names))
    line = F.array(F.struct(F.lit(_LINE).alias("key"), F.col(_LINE).alias("value")))
    kept = F.filter(F.concat(F.array(*wrong) if wrong else line, unknown, line), lambda p: p["value"].isNotNull())
    rescued = F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(F.array_distinct(kept))))
    # Few rows have anything to rescue: the arrays are built for these and for files with other columns alone.
    doubtful = F.col("_foreign") | F.col(_LINE).isNotNull()
    for value in unfit.values():
        doubtful = doubtful | value.isNotNull()
    return rows.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields],
        F.when(doubtful, rescued).alias(RESCUED),
        SOURCE_FILE,
        F.current_timestamp().alias(INGESTED_AT),
    )


def read_batch(spark: SparkSession, name: str, root: str | None = None, schema: StructType | None = None) -> DataFrame:
    """All files of a dataset as they are now."""
    lines = lines_of(spark.read, f"{landing_root(spark, root)}/{name}")
    return converted(lines, headers_of(lines), schema or RAW[name])


def stream_lines(spark: SparkSession, name: str, root: str | None = None, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The lines of a dataset's files as a stream; the checkpoint of the query knows which files are done.

    A file is never split between micro-batches, so each batch holds the headers of its lines.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return lines_of(reader, f"{landing_root(spark, root)}/{name}")


def infer_schema(spark: SparkSession, name: str, root: str | None = None, files: str = "*") -> StructType:
    """Column types found in the first files, to be kept and given to the stream.

    `files` is a pattern of the file names to look at, such as those of one day: a
    large landing folder need not be read for its types. Values of later files
    that do not fit are rescued.
    """
    reader = spark.read.option("header", True).option("nullValue", "").option("inferSchema", True)
    return reader.option("pathGlobFilter", files).csv(f"{landing_root(spark, root)}/{name}").schema


def write_landing(df: DataFrame, name: str, root: str, files: int | None = None) -> None:
    """Write a dataset into the landing zone in the raw file format.

    Times are written with a zone offset and flags as `True`/`False`, like the
    files the marketplace delivers. Files are compressed (readers know it by their names) and of a bounded size.
    """
    out = []
    for field in RAW[name].fields:
        column = F.col(field.name)
        kind = field.dataType.simpleString()
        if kind == "timestamp":
            text = F.date_format(column.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
        elif kind == "boolean":
            text = F.when(column, "True").when(~column, "False")
        else:
            text = column.cast("string")
        out.append(text.alias(field.name))
    rows = df.select(*out)
    if files:
        rows = rows.repartition(files)
    writer = rows.write.mode("append").option("header", True).option("compression", "gzip")
    with settings(df.sparkSession, CLEANED):
        writer.option("maxRecordsPerFile", ROWS_PER_FILE).csv(f"{root}/{name}")
