"""URL filters by dated lists: a capture meets the entries that were active when it was fetched.

List events (list, pattern, at, action) become validity intervals: an `add` is active until the
next event of the same list and pattern. Intervals are cut at fixed time slices, so an as-of join
is an equi-join on pattern and slice with a range check; a popular host is spread over its slices
and AQE may split it further. A URL is looked up under its host, every parent domain, and the
host with each leading part of its path, as deep as any pattern of the lists.

Of the active entries the one with the longest pattern decides, `allow` before other lists at equal
length, then the list that sorts first; a capture without one is kept. An event counts from its own instant on, a date
from its midnight in the session's time zone, so a capture of 09:00 does not meet an entry added at 18:00 that day. Of
events of one list and pattern at the same instant `remove` counts. Patterns have no port: one with a port matches nothing. Events with a null or unknown action,
pattern, list or time are ignored; a null, empty or unreadable URL and a null time match nothing.
Repeated captures are decided alike. Empty lists keep everything, no captures give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.storage import free_name

ALLOW = "allow"
# Days in one slice of time.
SLICE_DAYS = 30


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.regexp_replace(F.lower(host), r"\.+$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)


def intervals(events: DataFrame) -> DataFrame:
    """list, pattern, since, until (null: still active)."""
    known = events.select(
        F.col("list").cast("string").alias("list"),
        F.regexp_replace(F.lower(F.col("pattern").cast("string")), "/+$", "").alias("pattern"),
        F.col("at").cast("timestamp").alias("at"),
        F.col("action").cast("string").alias("action"),
    ).filter("list IS NOT NULL AND pattern <> '' AND at IS NOT NULL AND action IN ('add', 'remove')")
    # One event per time: `remove` sorts last.
    single = known.groupBy("list", "pattern", "at").agg(F.max("action").alias("action"))
    after = F.lead("at").over(Window.partitionBy("list", "pattern").orderBy("at"))
    return single.withColumn("until", after).filter("action = 'add'").select("list", "pattern", F.col("at").alias("since"), "until")


def lookups(url: Column, host_parts: int, path_parts: int) -> Column:
    """The patterns under which a URL is looked up; an empty array if it has no host."""
    host, path = host_of(url), F.lower(path_of(url))
    labels = F.split(host, r"\.")
    count = F.size(labels)
    # The whole host and its endings of up to `host_parts` labels.
    endings = F.transform(
        F.sequence(F.lit(1), F.least(count, F.lit(max(1, host_parts)))),
        lambda i: F.array_join(F.slice(labels, count - i + 1, i), "."),
    )
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    leading = F.transform(
        F.filter(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(path_parts))), lambda i: i > 0),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
    )
    return F.when(F.coalesce(host, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(F.array(host), endings, leading))
    )


def _slice(at: Column, days: int) -> Column:
    """The number of the slice that holds an instant; slices begin at fixed instants whatever the time zone."""
    return F.floor(F.unix_seconds(at) / (86_400 * days))


def decided(captures: DataFrame, events: DataFrame, url: str = "url", at: str = "fetched_on", slice_days: int = SLICE_DAYS) -> DataFrame:
    """`captures` and a struct as last column: list, pattern, since (a timestamp; null without entry), kept."""
    valid = intervals(events)
    seen = captures.select(F.col(url).cast("string").alias("u"), F.col(at).cast("timestamp").alias("d"))
    asked = seen.filter("u IS NOT NULL AND d IS NOT NULL").distinct()
    # Three numbers: how deep patterns are, and the time the captures span.
    slash = F.instr("pattern", "/") > 0
    host_part = F.substring_index("pattern", "/", 1)
    depth = valid.agg(
        F.max(F.size(F.split(host_part, r"\."))).alias("host"), F.max(F.when(slash, F.size(F.split("pattern", "/")) - 1)).alias("path")
    ).first()
    span = asked.agg(F.unix_micros(F.min("d")).alias("first"), F.unix_micros(F.max("d")).alias("last")).first()
    # Only time in which something was captured is cut into slices.
    first, last = (F.timestamp_micros(F.lit(span[name]).cast("bigint")) for name in ("first", "last"))
    begin = F.greatest(F.col("since"), first)
    # The slice in which an interval ends may hold captures before its end; the range check tells them apart.
    end = F.least(F.coalesce(F.col("until"), last), last)
    sliced = (
        valid.withColumn("begin", begin)
        .withColumn("end", end)
        .filter("begin <= end")
        .select("list", "pattern", "since", "until", F.explode(F.sequence(_slice(F.col("begin"), slice_days), _slice(F.col("end"), slice_days))).alias("slice"))
    )
    keyed = asked.select("u", "d", _slice(F.col("d"), slice_days).alias("slice"), F.explode(lookups(F.col("u"), depth["host"] or 1, depth["path"] or 0)).alias("pattern"))
    active = keyed.join(sliced, ["pattern", "slice"]).filter((F.col("d") >= F.col("since")) & (F.col("until").isNull() | (F.col("d") < F.col("until"))))
    # The smallest tuple decides: longest pattern, `allow` first, then the list's name.
    entry = F.struct((-F.length("pattern")).alias("length"), (F.col("list") != ALLOW).alias("other"), "list", "pattern", "since")
    best = active.groupBy("u", "d").agg(F.min(entry).alias("entry"))
    name = free_name(captures, "decision")
    left, right = free_name(captures, "u"), free_name(captures, "d")
    decision = F.struct(
        F.col("entry")["list"].alias("list"),
        F.col("entry")["pattern"].alias("pattern"),
        F.col("entry")["since"].alias("since"),
        F.coalesce(F.col("entry")["list"] == ALLOW, F.lit(True)).alias("kept"),
    )
    found = best.select(F.col("u").alias(left), F.col("d").alias(right), decision.alias(name))
    rows = captures.withColumn(left, F.col(url).cast("string")).withColumn(right, F.col(at).cast("timestamp"))
    none = F.struct(F.lit(None).cast("string").alias("list"), F.lit(None).cast("string").alias("pattern"), F.lit(None).cast("timestamp").alias("since"), F.lit(True).alias("kept"))
    joined = rows.join(found, [left, right], "left")
    return joined.select(*captures.columns, F.coalesce(name, none).alias(name))
