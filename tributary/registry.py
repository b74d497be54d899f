"""Every query by name: `name -> (spark, folder of the given tables) -> DataFrame`."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tributary.functions.labels import latency_bucket
from tributary.functions.scalars import lenient_double, lenient_int, numeric_text, percent, text_flag
from tributary.operators import governance
from tributary.operators.event_log import batch_log
from tributary.operators.expectations import enforce, fail, quarantine, rejected, rule_counts
from tributary.operators.keyed import first_per_key, latest_per_key
from tributary.operators.rollup import same_key, tally
from tributary.plans import (
    dashboards,
    marts_exact,
    marts_funnel,
    periods,
    quality_reports,
    questions,
    reports,
    semantic,
    silver,
    star,
)
from tributary.schemas import INGESTED_AT, RAW, RESCUED, SOURCE_FILE
from tributary.session import COMPRESSED, apply_settings, expect_shuffles_of, scratch_dir
from tributary.sources import landing
from tributary.sources.bind import RawTables
from tributary.sources.tables import Lake
from tributary.streaming import bronze, days, entities, events, refresh

Query = Callable[[SparkSession, str], DataFrame]

# Moment against which bound dates count as future, the client of the client
# questions, the week asked about, and the CTR (percent) that counts as low in
# the bound data, where about a third of all impressions are clicked.
AS_OF = "2001-01-01 00:00:00"
CLIENT = 3
WEEK_START = "1998-06-01"
LAST_DAY = "1998-06-30"
LOW_CTR = 33.0
LEAST_SEEN = 10
# Of all clicks; a search term has about a fifth.
FEW_CLICKS = 0.2
# Standard error of approx_count_distinct as it is called.
APPROXIMATION = 0.05


_REFRESHED: dict[tuple[str, str], tuple[Lake, dict[str, DataFrame]]] = {}


class Market:
    """All layers over one folder of tables, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.raw = RawTables(spark, folder)
        # Events with their search's columns take up to twice the bytes of the tables in a shuffle.
        expect_shuffles_of(spark, 2 * self.raw.gigabytes())

    @cached_property
    def silver(self) -> silver.SilverOverRaw:
        return silver.SilverOverRaw(self.raw)

    @cached_property
    def funnel(self) -> marts_funnel.Funnel:
        return marts_funnel.Funnel(self.silver)

    @cached_property
    def fact(self) -> DataFrame:
        return marts_funnel.funnel_fact(self.silver)

    @cached_property
    def job_performance(self) -> DataFrame:
        return marts_exact.job_performance(self.silver)

    @cached_property
    def job_ctr(self) -> DataFrame:
        """The per-job mart without the quartiles, which no dashboard shows."""
        return marts_funnel.job_performance_ctr(self.funnel, quartiles=False)

    @cached_property
    def postings(self) -> DataFrame:
        return reports.client_posting_performance(self.job_performance, self.silver.clients)

    @cached_property
    def benchmark(self) -> DataFrame:
        categories = marts_exact.category_performance(self.silver)
        return reports.client_category_benchmark(self.job_performance, categories, self.silver.clients)

    @cached_property
    def opportunities(self) -> DataFrame:
        return reports.client_opportunities(self.postings, self.benchmark)

    @cached_property
    def clickstream(self):
        return semantic.clickstream_view(self.fact, self.silver)

    @cached_property
    def quality_log(self) -> DataFrame:
        """Log of the three event flows, one run per day of events."""
        run = F.date_trunc("day", "event_ts")
        flows = [
            ("search_events", self.raw.search_events, silver.SEARCH_RULES),
            ("impression_events", silver.typed_impressions(self.raw.impression_events), silver.IMPRESSION_RULES),
            ("click_events", silver.typed_clicks(self.raw.click_events), silver.CLICK_RULES),
        ]
        logs = [batch_log(rows, rules, f"silver.{name}", run) for name, rows, rules in flows]
        return logs[0].unionByName(logs[1]).unionByName(logs[2])

    def refreshed(self) -> tuple[Lake, dict[str, DataFrame]]:
        """A lake with all layers from landing files on, and its gold tables; one per session and folder."""
        key = (self.spark.sparkContext.applicationId, self.raw.folder)
        if key not in _REFRESHED:
            lake = self.lake("medallion")
            _REFRESHED[key] = lake, refresh.refresh(lake, self.land(lake, *RAW))
        return _REFRESHED[key]

    @property
    def stored_funnel(self) -> marts_funnel.Funnel:
        """The funnel over stored silver tables and cells."""
        lake, gold = self.refreshed()
        return marts_funnel.Funnel(refresh.silver_tables(lake), gold["funnel_cells"])

    def lake(self, purpose: str) -> Lake:
        return Lake(self.spark, scratch_dir(self.spark, purpose))

    def land(self, lake: Lake, *names: str) -> str:
        """Write raw datasets as landing files and return the landing folder."""
        root = lake.path("raw", "landing")
        for name in names:
            landing.write_landing(getattr(self.raw, name), name, root)
        return root


_QUERIES: dict[str, Callable[[Market], DataFrame]] = {}


def _register(name: str):
    def keep(build: Callable[[Market], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} exists")
        _QUERIES[name] = build
        return build

    return keep


def _add(prefix: str, builds: dict[str, Callable[[Market], DataFrame]]) -> None:
    for name, build in builds.items():
        _register(prefix + name)(build)


def queries() -> dict[str, Query]:
    def bound(build):
        return lambda spark, folder: build(Market(spark, folder))

    return {name: bound(build) for name, build in _QUERIES.items()}


def _naive(df: DataFrame) -> DataFrame:
    """Zoned times as times without zone, the type of the given tables."""
    zoned = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _without_lineage(df: DataFrame) -> DataFrame:
    return _naive(df.drop(SOURCE_FILE, INGESTED_AT, RESCUED, "processed_at"))


# --- landing files and bronze ------------------------------------------------


def _bronze_query(name: str):
    def build(m: Market) -> DataFrame:
        lake = m.lake(f"bronze-{name}")
        bronze.ingest(lake, [name], m.land(lake, name))
        return _naive(lake.read("bronze", name).drop(SOURCE_FILE, INGESTED_AT))

    return build


_add("bronze_", {name: _bronze_query(name) for name in RAW})


@_register("csv_batch_scan")
def _csv_batch_scan(m: Market) -> DataFrame:
    lake = m.lake("csv-scan")
    return _without_lineage(landing.read_batch(m.spark, "click_events", m.land(lake, "click_events")))


@_register("csv_root_setting")
def _csv_root_setting(m: Market) -> DataFrame:
    """The landing folder named by the session setting instead of an argument."""
    lake = m.lake("csv-root")
    m.spark.conf.set(landing.ROOT_SETTING, m.land(lake, "click_events"))
    try:
        return _without_lineage(landing.read_batch(m.spark, "click_events"))
    finally:
        m.spark.conf.unset(landing.ROOT_SETTING)


@_register("csv_inferred_read")
def _csv_inferred_read(m: Market) -> DataFrame:
    """Types found in the first drop of files and kept; the stream reads later drops with them."""
    lake = m.lake("csv-infer")
    root = lake.path("raw", "landing")
    for late in (False, True):
        landing.write_landing(m.raw.freelancers.filter((F.col("visitor_id") % 5 == 0) == F.lit(late)), "freelancers", root)
        schema = bronze.kept_schema(lake, "freelancers", root)
        bronze.start(lake, "freelancers", root, schema=schema).awaitTermination()
    return _without_lineage(lake.read("bronze", "freelancers"))


@_register("csv_reordered_columns")
def _csv_reordered_columns(m: Market) -> DataFrame:
    """Two drops, the later one with another order of columns and a column nobody declared."""
    lake = m.lake("csv-reorder")
    root = lake.path("raw", "landing")
    first = F.col("client_uid") % 2 == 0
    landing.write_landing(m.raw.clients.filter(first), "clients", root)
    bronze.ingest(lake, ["clients"], root)
    moved = m.raw.clients.filter(~first).select(
        "company_name", F.concat(F.lit("region "), F.col("client_uid") % 3).alias("region"), "total_spend_usd", "client_uid",
        F.col("payment_verified").cast("string").alias("payment_verified"), "member_since", "industry", "avg_rating", "country",
    )
    moved.write.mode("append").option("header", True).csv(f"{root}/clients")
    bronze.ingest(lake, ["clients"], root)
    return _naive(lake.read("bronze", "clients").drop(SOURCE_FILE, INGESTED_AT))


@_register("rescued_values")
def _rescued_values(m: Market) -> DataFrame:
    """Budgets declared as numbers: words do not fit and are rescued as JSON."""
    lake = m.lake("rescue")
    strict = StructType(
        [StructField(f.name, DoubleType()) if f.name == "budget_amount" else f for f in RAW["job_openings"].fields]
    )
    rows = landing.read_batch(m.spark, "job_openings", m.land(lake, "job_openings"), strict)
    return rows.select("opening_uid", "budget_amount", RESCUED)


@_register("source_lineage")
def _source_lineage(m: Market) -> DataFrame:
    """Rows that know their file and their time of arrival."""
    lake = m.lake("lineage")
    rows = landing.read_batch(m.spark, "search_events", m.land(lake, "search_events"))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col(SOURCE_FILE).contains("/search_events/"), 1)).alias("rows_with_file"),
        F.count(INGESTED_AT).alias("rows_with_time"),
    )


@_register("incremental_files")
def _incremental_files(m: Market) -> DataFrame:
    """Two drops of files, three runs: every file is taken in once."""
    lake = m.lake("incremental")
    root = lake.path("raw", "landing")
    featured = F.col("sublocation").eqNullSafe("featured_jobs")
    landing.write_landing(m.raw.search_events.filter(featured), "search_events", root)
    bronze.ingest(lake, ["search_events"], root, files_per_batch=2)
    landing.write_landing(m.raw.search_events.filter(~featured), "search_events", root)
    bronze.ingest(lake, ["search_events"], root)
    bronze.ingest(lake, ["search_events"], root)
    return tally(lake.read("bronze", "search_events"), "sublocation", searches=F.count("search_guid"))


# --- silver ------------------------------------------------------------------


_add(
    "silver_",
    {
        "search_events": lambda m: m.silver.searches,
        "impression_events": lambda m: m.silver.impressions,
        "click_events": lambda m: m.silver.clicks,
    },
)


def _entity_query(clean, raw_name: str, key: str, sequence: str):
    def build(m: Market) -> DataFrame:
        rows = clean(getattr(m.raw, raw_name)).drop("processed_at")
        return latest_per_key(rows, [key], sequence)

    return build


_add(
    "silver_",
    {
        "freelancers": _entity_query(silver.clean_freelancers, "freelancers", "visitor_id", "member_since"),
        "clients": _entity_query(silver.clean_clients, "clients", "client_uid", "member_since"),
        "job_openings": _entity_query(silver.clean_jobs, "job_openings", "opening_uid", "posted_at"),
    },
)


def _streamed_silver(name: str):
    def build(m: Market) -> DataFrame:
        lake = m.lake(f"silver-{name}")
        bronze.ingest(lake, [name], m.land(lake, name), files_per_batch=4)
        events.start(lake, name).awaitTermination()
        return _without_lineage(events.read_events(lake, name))

    return build


_add("streamed_silver_", {name: _streamed_silver(name) for name in events.EVENT_FLOWS})


@_register("streamed_quarantine_impressions")
def _streamed_quarantine(m: Market) -> DataFrame:
    lake = m.lake("quarantine")
    bronze.ingest(lake, ["impression_events"], m.land(lake, "impression_events"))
    events.start_quarantine(lake).awaitTermination()
    return _without_lineage(lake.read("silver", "quarantine_impression_events"))


@_register("streamed_event_log")
def _streamed_event_log(m: Market) -> DataFrame:
    """Rule outcomes logged by the streams, summed over their batches."""
    lake = m.lake("event-log")
    names = ["search_events", "click_events"]
    bronze.ingest(lake, names, m.land(lake, *names), files_per_batch=2)
    for query in [events.start(lake, name) for name in names]:
        query.awaitTermination()
    return quality_reports.expectation_breakdown(events.read_log(lake))


@_register("streamed_click_dedup")
def _streamed_click_dedup(m: Market) -> DataFrame:
    """Clicks delivered twice, in files of no particular order and several batches."""
    lake = m.lake("dedup")
    root = lake.path("raw", "landing")
    for _ in range(2):
        landing.write_landing(m.raw.click_events, "click_events", root, files=6)
    bronze.ingest(lake, ["click_events"], root, files_per_batch=3)
    clicks = bronze.new_rows(lake, "click_events").drop(SOURCE_FILE, INGESTED_AT, RESCUED)
    unique = events.without_repeats(clicks.filter("event_id IS NOT NULL"), "event_id")
    target = lake.path("silver", "unique_clicks")
    (
        unique.writeStream.format("parquet")
        .options(**COMPRESSED)
        .option("checkpointLocation", lake.checkpoint("dedup"))
        .trigger(availableNow=True)
        .start(target)
        .awaitTermination()
    )
    return _naive(m.spark.read.parquet(target)).select("event_id", "search_guid", "event_ts", "time_to_click_secs")


# --- change feeds ------------------------------------------------------------


def _order_changes(m: Market) -> DataFrame:
    """Orders as versions of their customer's record."""
    return m.raw.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")


@_register("scd1_customer_orders")
def _scd1_batch(m: Market) -> DataFrame:
    return latest_per_key(_order_changes(m), ["o_custkey"], "o_orderdate", ["o_orderkey"])


@_register("scd1_customer_orders_stream")
def _scd1_stream(m: Market) -> DataFrame:
    """The same state kept by a stream of several batches, with a compaction in between."""
    lake = m.lake("scd1")
    feed = lake.path("raw", "order_changes")
    changes = _order_changes(m)
    target = entities.CurrentState(
        lake, lake.path("silver", "customer_orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]
    )
    # The closed orders arrive first, so later batches hold older rows as well.
    for late in (False, True):
        part = changes.filter((F.col("o_orderstatus") == "F") != F.lit(late))
        part.repartition(4).write.mode("append").options(**COMPRESSED).parquet(feed)
        stream = m.spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 2).parquet(feed)
        entities.start_changes(target, stream, lake.checkpoint("customer_orders")).awaitTermination()
        if not late:
            target.compact()
    return target.current()


# --- quality rules -------------------------------------------------------------


def _mart_rule_counts(mart, rules):
    return lambda m: rule_counts(mart(m.silver), rules)


_add(
    "expect_",
    {
        "counts_search_events": lambda m: rule_counts(m.raw.search_events, silver.SEARCH_RULES),
        "counts_impression_events": lambda m: rule_counts(
            silver.typed_impressions(m.raw.impression_events), silver.IMPRESSION_RULES
        ),
        "counts_click_events": lambda m: rule_counts(
            silver.typed_clicks(m.raw.click_events), silver.CLICK_RULES
        ),
        "warn_job_mart": _mart_rule_counts(marts_exact.job_performance, silver.JOB_MART_RULES),
        "warn_daily_mart": _mart_rule_counts(marts_exact.daily_metrics, silver.DAILY_MART_RULES),
        "or_fail_searches": lambda m: enforce(
            m.raw.search_events, [fail("has_guid", "search_guid IS NOT NULL")]
        ),
    },
)


def _documented_tables(m: Market) -> dict[str, DataFrame]:
    entity = silver.documented_entities
    return {
        "search_events": m.raw.search_events,
        "impression_events": silver.typed_impressions(m.raw.impression_events),
        "click_events": silver.documented_clicks(m.raw.click_events),
        "job_openings": entity(m.raw.job_openings, {"numeric_budget_amount": "budget_amount"}),
        "clients": entity(m.raw.clients, {"numeric_total_spend_usd": "total_spend_usd"}),
        "freelancers": entity(
            m.raw.freelancers,
            {"numeric_hourly_rate": "hourly_rate", "numeric_job_success_score": "job_success_score"},
        ),
    }


@_register("documented_rule_counts")
def _documented_rule_counts(m: Market) -> DataFrame:
    """Outcome of every documented rule on all six datasets."""
    rules = silver.documented_rules(AS_OF)
    out = None
    for name, rows in _documented_tables(m).items():
        counts = rule_counts(rows, rules[name]).select(F.lit(name).alias("dataset"), "*")
        out = counts if out is None else out.unionByName(counts)
    return out


@_register("documented_click_events")
def _documented_click_events(m: Market) -> DataFrame:
    """Clicks by the documented rules: organic clicks kept, one row per event id."""
    rows = enforce(_documented_tables(m)["click_events"], silver.documented_rules(AS_OF)["click_events"])
    order = [F.col(c).asc_nulls_last() for c in ("event_ts", "visitor_id", "opening_uid", "time_to_click_secs")]
    return first_per_key(rows, ["event_id"], order)


@_register("documented_numbers")
def _documented_numbers(m: Market) -> DataFrame:
    """Numbers found by pattern in the freelancer texts."""
    return _documented_tables(m)["freelancers"].select(
        "visitor_id", "hourly_rate", "numeric_hourly_rate", "job_success_score", "numeric_job_success_score"
    )


_add(
    "quarantine_",
    {
        "impression_events": lambda m: silver.quarantine_impressions(m.raw.impression_events),
        "click_events": lambda m: silver.quarantine_clicks(m.raw.click_events),
        "balance": lambda m: silver.quarantine_balance(m.raw),
        "rejected_searches": lambda m: rejected(m.raw.search_events, silver.SEARCH_RULES),
        "reasons_impression_events": lambda m: tally(
            quarantine(silver.typed_impressions(m.raw.impression_events), silver.IMPRESSION_RULES),
            "quarantine_reason",
            rows=F.count(F.lit(1)),
        ),
    },
)
_register("quality_event_log")(
    lambda m: m.quality_log.select("timestamp", "event_type", F.col("origin.flow_name").alias("flow_name"), "details")
)


def _log_report(report):
    return lambda m: report(m.quality_log)


_add("", {name: _log_report(report) for name, report in quality_reports.REPORTS.items()})


@_register("named_parameter_query")
def _named_parameter_query(m: Market) -> DataFrame:
    """SQL text over a view with a named parameter."""
    quality_reports.flow_counts(m.quality_log).createOrReplaceTempView("flow_counts")
    return m.spark.sql(
        "SELECT table_name, SUM(rows_passed) AS rows_passed, SUM(rows_dropped) AS rows_dropped "
        "FROM flow_counts WHERE table_name = :flow GROUP BY table_name",
        args={"flow": "silver.click_events"},
    )


# --- tables and views ------------------------------------------------------------


@_register("materialized_mart")
def _materialized_mart(m: Market) -> DataFrame:
    return m.lake("mart").materialize(marts_exact.position_ctr(m.silver), "gold", "p_position_ctr")


@_register("published_table")
def _published_table(m: Market) -> DataFrame:
    """A stored table named in the catalog, read by its name."""
    lake = m.lake("published")
    lake.materialize(star.dim_category(m.silver), "gold", "dim_category")
    name = lake.publish("gold", "dim_category", "One row per job category", prefix="tributary_")
    return m.spark.table(name)


@_register("persistent_view")
def _persistent_view(m: Market) -> DataFrame:
    """A view kept in the catalog over a stored report."""
    lake = m.lake("views")
    lake.materialize(m.postings, "gold", "client_posting_performance")
    table = lake.publish("gold", "client_posting_performance", "One row per posting", prefix="tributary_")
    view = lake.publish_view(
        "gold",
        "active_postings",
        f"SELECT client_uid, company_name, opening_uid, title, impressions, clicks FROM {table} WHERE is_active",
        prefix="tributary_",
    )
    return m.spark.table(view)


@_register("sql_view")
def _sql_view(m: Market) -> DataFrame:
    """A report registered as a view and queried with SQL."""
    m.postings.createOrReplaceTempView("client_posting_performance")
    return m.spark.sql(
        "SELECT opportunity_segment, COUNT(*) AS postings, SUM(impressions) AS impressions "
        "FROM client_posting_performance GROUP BY opportunity_segment"
    )


@_register("medallion_job_performance")
def _medallion_job_performance(m: Market) -> DataFrame:
    """From landing files through all streams to the stored per-job mart."""
    lake = m.lake("medallion")
    tables = refresh.refresh_silver(lake, m.land(lake, *RAW))
    stored = lake.materialize(marts_exact.job_performance(tables), "gold", "p_job_performance")
    return _naive(stored)


_add(
    "medallion_",
    {
        "s_daily_metrics": lambda m: marts_funnel.daily_metrics(m.stored_funnel),
        "s_sublocation_performance": lambda m: marts_funnel.sublocation_performance(m.stored_funnel),
        "fact_search_events": lambda m: _naive(m.refreshed()[1]["fact_search_events"]),
        "client_opportunities": lambda m: m.refreshed()[1]["client_opportunities"],
    },
)


@_register("incremental_fact_search_events")
def _incremental_fact(m: Market) -> DataFrame:
    """The fact after two landings: late clicks and impressions rebuild the days of their searches alone."""
    lake = m.lake("by-days")
    root = lake.path("raw", "landing")
    # What comes late belongs to searches of the last months.
    recent = F.to_date("event_ts") >= F.lit("2001-06-01").cast("date")
    late = recent & (F.xxhash64("event_id") % 4 == 0)
    for second in (False, True):
        for name in days.EVENTS:
            rows = getattr(m.raw, name)
            # The second landing brings late events of searches that the first one held, and of new ones.
            new = late if name != "search_events" else recent & (F.xxhash64("search_guid") % 16 == 0)
            landing.write_landing(rows.filter(new == F.lit(second)), name, root)
        bronze.ingest(lake, list(days.EVENTS), root)
        for query in [events.start(lake, name) for name in days.EVENTS]:
            query.awaitTermination()
        days.refresh_days(lake, lambda known: _stored_events(known, m))
    return _naive(days.read_day_table(lake, "fact_search_events", _stored_events(lake, m)))


def _stored_events(lake: Lake, m: Market) -> silver.SilverTables:
    stored = [events.read_events(lake, name) for name in days.EVENTS]
    return silver.SilverTables(*stored, m.silver.jobs, m.silver.clients, m.silver.freelancers)


_register("client_picker")(lambda m: dashboards.client_picker(m.silver.clients))


# --- marts, star schema, reports ---------------------------------------------


def _over_silver(build):
    return lambda m: build(m.silver)


def _over_funnel(build, *args):
    return lambda m: build(m.funnel, *args)


def _flat_quantiles(build, stored: bool = False):
    """Quartiles as three columns beside the other measures."""

    def flat(m: Market) -> DataFrame:
        rows = build(m.stored_funnel if stored else m.funnel)
        quantiles = F.col("click_time_quantiles")
        names = ("click_time_p25", "click_time_p50", "click_time_p75")
        return rows.withColumns({n: quantiles[i] for i, n in enumerate(names)}).drop("click_time_quantiles")

    return flat


def _approximation_error(build):
    """Per group whether the approximate distinct counts are near the exact ones."""

    def compared(m: Market) -> DataFrame:
        key, *measures = [
            f.name for f in build(m.funnel, marts_funnel.approximate).schema.fields if not isinstance(f.dataType, ArrayType)
        ]
        exact = build(m.funnel).select(F.col(key).alias("group"), F.struct(*measures).alias("exact"))
        near = build(m.funnel, marts_funnel.approximate).select(F.col(key).alias("group"), F.struct(*measures).alias("near"))
        counts = [n for n in measures if n.startswith(("unique_", "search_sessions", "total_searches"))]
        fits = F.lit(True)
        for name in counts:
            # Four standard errors of the sketch, and one for the smallest groups.
            off = F.abs(F.col("near")[name] - F.col("exact")[name])
            fits = fits & (off <= 4 * APPROXIMATION * F.col("exact")[name] + 1)
        both = same_key(exact, near, "group", "full")
        return both.select(F.col("group").cast("string").alias("group"), F.coalesce(fits, F.lit(False)).alias("within_bound"))

    return compared


_add("", {name: _over_silver(build) for name, build in marts_exact.MARTS.items()})
_add("", {name: _over_silver(build) for name, build in marts_funnel.DIMENSIONS.items()})
_add("", {name: _over_funnel(build) for name, build in marts_funnel.EXACT_ONLY.items()})
_register("distinct_by_period")(lambda m: periods.by_period(periods.daily_states(m.silver)[0]))
_register("s_fact_search_funnel")(lambda m: m.fact)
for _name, _build in marts_funnel.WITH_DISTINCT.items():
    has_quantiles = _name in ("s_job_performance_ctr", "s_job_click_engagement")
    _register(_name)(_flat_quantiles(_build) if has_quantiles else _over_funnel(_build))
    # Approximate distinct counts differ between engines: rows only, no oracle.
    _register(f"{_name}_approx")(_over_funnel(_build, marts_funnel.approximate))
    _register(f"{_name}_approx_error")(_approximation_error(_build))
_register("medallion_s_job_performance_ctr")(_flat_quantiles(marts_funnel.job_performance_ctr, stored=True))
_add("", {name: _over_silver(build) for name, build in star.TABLES.items()})
_add(
    "",
    {
        "client_posting_performance": lambda m: m.postings,
        "client_category_benchmark": lambda m: m.benchmark,
        "client_opportunities": lambda m: m.opportunities,
    },
)


# --- metric views ---------------------------------------------------------------


_add(
    "mv_",
    {
        "clickstream_by_country_and_skill": lambda m: m.clickstream.query(
            ["country", "primary_skill"], ["total_impressions", "CTR"]
        ),
        "clickstream_by_industry": lambda m: m.clickstream.query(
            ["industry", "category"], ["total_impressions", "CTR"]
        ),
        "clickstream_overall": lambda m: m.clickstream.query(measures=["total_impressions", "CTR"]),
        "clickstream_featured_by_position": lambda m: m.clickstream.query(
            ["position"], ["total_impressions", "CTR"], where="source.sublocation = 'featured_jobs'"
        ),
        "clickstream_key_check": lambda m: m.clickstream.check_keys(),
        "client_portfolio": lambda m: semantic.client_portfolio_view(m.postings).query(
            ["company_name"],
            [
                "clients_tracked",
                "jobs_posted",
                "active_jobs",
                "total_impressions",
                "total_clicks",
                "ctr_pct",
                "avg_budget_amount",
                "unique_categories",
            ],
        ),
        "category_performance": lambda m: semantic.category_view(m.postings).query(
            ["category"], ["impressions", "clicks", "ctr_pct", "ctr", "avg_budget_amount"]
        ),
        "search_funnel": lambda m: semantic.search_funnel_view(m.funnel).query(
            ["search_query", "sublocation"],
            ["searches", "searches_with_clicks", "impressions", "clicks", "ctr_pct", "avg_time_to_click_secs"],
        ),
        "search_funnel_by_date": lambda m: semantic.search_funnel_view(m.funnel).query(
            ["search_date"], ["searches", "impressions", "clicks", "ctr_pct"]
        ),
        "position_bias": lambda m: semantic.position_bias_view(m.funnel).query(
            ["position"], ["impressions", "clicks", "ctr_pct", "avg_time_to_click_secs"]
        ),
        "from_yaml": lambda m: semantic.placement_view(m.fact).query(
            ["placement", "search_page_position"], ["shown", "clicked", "click_share"]
        ),
    },
)


# --- dashboards -------------------------------------------------------------------


_add(
    "ins_",
    {
        "funnel_summary": lambda m: dashboards.funnel_summary(m.job_ctr),
        "top_jobs_by_impressions": lambda m: dashboards.top_jobs_by_impressions(m.job_ctr, m.silver.jobs),
        "top_jobs_by_ctr": lambda m: dashboards.top_jobs_by_ctr(m.job_ctr, m.silver.jobs),
        "position_bias": lambda m: dashboards.position_bias(marts_funnel.impression_position_ctr(m.funnel)),
        "category_performance": lambda m: dashboards.category_performance(
            marts_funnel.category_performance(m.funnel)
        ),
        "category_ctr_vs_budget": lambda m: dashboards.category_ctr_vs_budget(
            marts_funnel.category_performance(m.funnel)
        ),
        "search_query_performance": lambda m: dashboards.search_query_performance(
            marts_funnel.search_query_performance(m.funnel)
        ),
        "sublocation_performance": lambda m: dashboards.sublocation_performance(
            marts_funnel.sublocation_performance(m.funnel)
        ),
        "daily_trend": lambda m: dashboards.daily_trend(marts_funnel.daily_metrics(m.funnel)),
        "time_to_click": lambda m: dashboards.time_to_click(m.silver.clicks),
        "budget_type_distribution": lambda m: dashboards.budget_type_distribution(m.job_ctr, m.silver.jobs),
        "client_activity": lambda m: dashboards.client_activity(m.job_ctr, m.silver.jobs),
    },
)
_add(
    "cli_",
    {
        "portfolio_overview": lambda m: dashboards.portfolio_overview(m.postings),
        "top_accounts": lambda m: dashboards.top_accounts(m.postings),
        "posting_watchlist": lambda m: dashboards.posting_watchlist(m.postings),
        "category_benchmark": lambda m: dashboards.category_benchmark(m.benchmark),
        "opportunities": lambda m: dashboards.opportunities(m.opportunities),
        "marketplace_snapshot": lambda m: dashboards.marketplace_snapshot(m.postings),
    },
)


# --- business questions ---------------------------------------------------------


def _s_queries(m: Market) -> DataFrame:
    return marts_funnel.search_query_performance(m.funnel)


def _s_category(m: Market) -> DataFrame:
    return marts_funnel.category_performance(m.funnel)


def _s_sublocation(m: Market) -> DataFrame:
    return marts_funnel.sublocation_performance(m.funnel)


def _s_position(m: Market) -> DataFrame:
    return marts_funnel.impression_position_ctr(m.funnel)


def _star_fact(m: Market) -> DataFrame:
    return star.fact_search_events(m.silver)


_add(
    "q_",
    {
        "week_traffic": lambda m: questions.week_traffic(m.silver, WEEK_START),
        "overall_ctr": lambda m: dashboards.funnel_summary(m.job_ctr).select("overall_ctr_pct"),
        "recent_days": lambda m: questions.recent_days(m.silver, LAST_DAY),
        "busiest_hour": lambda m: questions.busiest_hour(marts_funnel.hourly_activity(m.funnel)),
        "jobs_by_impressions": lambda m: questions.jobs_by(m.job_ctr, "impressions"),
        "jobs_by_ctr": lambda m: questions.jobs_by(m.job_ctr, "ctr_pct", least_impressions=5),
        "jobs_at_top": lambda m: questions.jobs_at_top(m.silver),
        "seen_but_not_clicked": lambda m: questions.seen_but_not_clicked(m.postings, LEAST_SEEN, LOW_CTR),
        "queries_by_clicks": lambda m: questions.queries_by_clicks(_s_queries(m)),
        "queries_without_clicks": lambda m: questions.queries_without_clicks(_s_queries(m), FEW_CLICKS),
        "queries_by_ctr": lambda m: questions.queries_by_ctr(_s_queries(m)),
        "categories_by_ctr": lambda m: questions.categories_by_ctr(_s_category(m)),
        "budget_by_category": lambda m: questions.budget_by_category(star.dim_category(m.silver)),
        "impressions_per_active_job": lambda m: questions.impressions_per_active_job(_s_category(m)),
        "featured_vs_organic_ctr": lambda m: questions.placement(_s_sublocation(m), "ctr_pct"),
        "position_by_placement": lambda m: questions.placement(_s_sublocation(m), "avg_position"),
        "featured_click_speed": lambda m: questions.featured_click_speed(_s_sublocation(m)),
        "ctr_by_position": lambda m: questions.ctr_by_position(_s_position(m)),
        "click_time_at_positions": lambda m: questions.click_time_at(_s_position(m), [1, 7]),
        "clients_by_ctr": lambda m: questions.ctr_by(m.clickstream, "company_name"),
        "clients_by_jobs_shown": lambda m: questions.clients_by_jobs_shown(m.clickstream),
        "ctr_spread_in_category": lambda m: questions.ctr_spread_in_category(m.benchmark),
        "client_spend_vs_ctr": lambda m: questions.client_spend_vs_ctr(m.clickstream),
        "spend_ctr_correlation": lambda m: questions.spend_ctr_correlation(m.clickstream),
        "ctr_by_country": lambda m: questions.ctr_by(m.clickstream, "country"),
        "ctr_by_top_rated": lambda m: questions.ctr_by(m.clickstream, "top_rated"),
        "ctr_by_skill": lambda m: questions.ctr_by(m.clickstream, "primary_skill"),
        "clients_at_risk": lambda m: questions.clients_at_risk(
            semantic.client_portfolio_view(m.postings), LOW_CTR
        ),
        "demand_against_posting_mix": lambda m: questions.demand_against_posting_mix(m.postings, CLIENT),
        "weakest_jobs_of_client": lambda m: questions.weakest_jobs(m.opportunities, CLIENT),
        "gaps_of_client": lambda m: questions.client_gaps(m.benchmark, CLIENT),
        "click_speed_of_top_rated": lambda m: questions.click_speed_of_top_rated(
            star.impression_outcomes(m.silver), star.dim_freelancer(m.silver)
        ),
        "behaviour_by_hourly_rate": lambda m: questions.behaviour_by_hourly_rate(
            star.impression_outcomes(m.silver), star.dim_freelancer(m.silver)
        ),
    },
)


# --- governance -------------------------------------------------------------------


def _masked_clicks(m: Market, privileged: bool) -> DataFrame:
    return governance.masked(m.silver.clicks, privileged).select("event_id", "visitor_id", "opening_uid")


@_register("sql_governance_functions")
def _sql_governance_functions(m: Market) -> DataFrame:
    """Mask and row filter as SQL functions over a view."""
    governance.register_functions(m.spark)
    star.dim_job(m.silver).createOrReplaceTempView("dim_job")
    return m.spark.sql(
        "SELECT opening_uid, client_uid, mask_visitor_id(CAST(opening_uid AS STRING), false) AS masked "
        "FROM dim_job WHERE client_row_filter(CAST(client_uid AS STRING), :caller, false)",
        args={"caller": str(CLIENT)},
    )


_add(
    "gov_",
    {
        "masked_clicks": lambda m: _masked_clicks(m, privileged=False),
        "clear_clicks": lambda m: _masked_clicks(m, privileged=True),
        "masked_fact": lambda m: governance.masked(_star_fact(m), privileged=False),
        # Any five rows: no order is asked for, so there is no oracle.
        "masked_peek": lambda m: governance.masked_peek(m.silver.clicks, privileged=False),
        "masked_peek_in_order": lambda m: governance.masked_peek(m.silver.clicks.orderBy("event_id"), privileged=False),
        "own_jobs": lambda m: governance.own_rows(star.dim_job(m.silver), CLIENT, privileged=False),
        "all_jobs": lambda m: governance.own_rows(star.dim_job(m.silver), CLIENT, privileged=True),
        "recent_access": lambda m: governance.recent_access(m.raw.audit_log, "market"),
        "column_lineage": lambda m: governance.column_lineage_of(m.raw.column_lineage, "market.gold.table_7"),
        "masked_distinct_visitors": lambda m: governance.masked(m.silver.clicks, privileged=False).agg(
            F.countDistinct("visitor_id").alias("visitors")
        ),
    },
)


# --- single operators on whole tables -----------------------------------------------


_add(
    "",
    {
        "lenient_casts": lambda m: m.raw.click_events.select(
            "event_id",
            lenient_double("time_to_click_secs").alias("seconds"),
            lenient_int("time_to_click_secs").alias("whole_seconds"),
            numeric_text("time_to_click_secs").alias("seconds_by_pattern"),
            text_flag("is_bot").alias("is_bot"),
        ),
        "latency_labels": lambda m: m.silver.clicks.select(
            "event_id", latency_bucket(F.col("time_to_click_secs")).alias("latency_bucket")
        ),
        "first_click_per_search_and_job": lambda m: star.first_clicks(m.silver).drop("matched"),
        "distinct_search_attributes": lambda m: m.silver.searches.select("search_query", "sublocation").distinct(),
        "impressions_with_search": lambda m: m.silver.impressions.select("event_id", "search_guid").join(
            m.silver.searches.select("search_guid", "search_query", "sublocation"), "search_guid", "left"
        ),
        "click_rate_of_pairs": lambda m: m.funnel.cells().select(
            "search_guid", "opening_uid", "rows", "impressions", "clicks",
            percent(F.col("clicks"), F.col("impressions")).alias("ctr_pct"),
        ),
    },
)
