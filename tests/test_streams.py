"""Landing files, bronze, silver streams and the whole run."""

from __future__ import annotations

import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from small import by, rows

from tributary.plans import marts_exact, quality_reports, silver
from tributary.schemas import INGESTED_AT, RAW, RESCUED, SOURCE_FILE, columns
from tributary.sources import landing
from tributary.sources.tables import Lake
from tributary.streaming import bronze, entities, events, refresh

CSV = {
    "search_events": [
        "search_guid,visitor_id,search_query,sublocation,sort,page,event_ts",
        "g1,v1,welder,search_results,recency,1,2023-06-04T10:20:30.000+0000",
        "g2,v2,gardener,featured_jobs,relevance,x,2023-06-05T07:08:00.000+0000",
        "g3,,painter,search_results,recency,2,2023-06-05T07:08:00.000+0000",
        "g4,v2,painter,homepage_banner,recency,2,2023-06-05T07:08:00.000+0000",
        ",,,,,,",
    ],
    "impression_events": [
        "event_id,visitor_id,search_guid,opening_uid,position,event_ts,collector_ts,is_bot",
        "i1,v1,g1,j1,1,2023-06-04T10:20:30.000+0000,2023-06-04T10:20:32.000+0000,False",
        "i2,v1,g1,j2,2,2023-06-04T10:20:30.000+0000,2023-06-04T10:20:32.000+0000,False",
        "i3,v2,g2,j1,1,2023-06-05T07:08:00.000+0000,2023-06-05T07:08:02.000+0000,True",
    ],
    "click_events": [
        "event_id,visitor_id,search_guid,opening_uid,position,event_ts,collector_ts,is_bot,time_to_click_secs",
        "c1,v1,g1,j1,1,2023-06-04T10:21:15.000+0000,2023-06-04T10:21:17.000+0000,False,8",
        "c2,v1,g1,j2,2,2023-06-04T10:21:15.000+0000,2023-06-04T10:21:17.000+0000,False,instant",
    ],
    "job_openings": [
        "opening_uid,title,category,budget_type,budget_amount,client_uid,posted_at,is_active",
        "j1,House Painter,Data,hourly,41.50,CL_1,2023-05-01T00:00:00.000+0000,True",
        "j2,,Design,monthly,negotiable,CL_1,2023-05-01T00:00:00.000+0000,True",
    ],
    "clients": [
        "client_uid,company_name,country,industry,payment_verified,total_spend_usd,member_since,avg_rating",
        "CL_1,Acme,US,IT,True,not disclosed,2020-09-02,",
    ],
    "freelancers": [
        "visitor_id,name,country,primary_skill,hourly_rate,job_success_score,member_since,top_rated,is_verified",
        "v1,Ann,US,Brushes,31.25,N/A,2021-11-30,True,True",
    ],
}


def drop_file(root: Path, name: str, lines: list[str], file: str = "a.csv", end: str = "\r\n") -> None:
    folder = root / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_bytes((end.join(lines) + end).encode())


@pytest.fixture
def landed(tmp_path):
    for name, lines in CSV.items():
        drop_file(tmp_path, name, lines)
    return tmp_path


def test_batch_scan_types_values_and_rescues_the_rest(spark, landed):
    extra = ["g9,v9,painter,search_results,recency,3,2023-06-05T07:08:00.000+0000,surplus"]
    drop_file(landed, "search_events", [CSV["search_events"][0], *extra], "b.csv")
    got = by(landing.read_batch(spark, "search_events", str(landed)), "search_guid")
    assert got["g1"]["page"] == 1 and got["g1"][RESCUED] is None
    assert got["g1"]["event_ts"] == datetime(2023, 6, 4, 10, 20, 30)
    assert got["g2"]["page"] is None and got["g2"][RESCUED] == '{"page":"x"}'
    assert got["g3"]["visitor_id"] is None
    assert "surplus" in got["g9"][RESCUED]
    assert got["g1"][SOURCE_FILE].endswith("/search_events/a.csv") and got["g1"][INGESTED_AT] is not None


def test_root_comes_from_argument_setting_or_default(spark):
    assert landing.landing_root(spark) == landing.DEFAULT_ROOT
    spark.conf.set(landing.ROOT_SETTING, "/somewhere")
    try:
        assert landing.landing_root(spark) == "/somewhere"
        assert landing.landing_root(spark, "/else") == "/else"
    finally:
        spark.conf.unset(landing.ROOT_SETTING)


def test_columns_are_found_by_name(lake, spark, landed):
    """Another order, a new column, a missing one, a quoted comma; in batch and stream."""
    drop_file(landed, "clients", ["company_name,client_uid,region,total_spend_usd", '"Bolt, Nut",CL_2,NA,12.5', "Odd,CL_3,,x,surplus"], "b 2.csv")
    batch = landing.read_batch(spark, "clients", str(landed))
    bronze.ingest(lake, ["clients"], str(landed), files_per_batch=1)
    for got in (by(batch, "client_uid"), by(lake.read("bronze", "clients"), "client_uid")):
        assert (got["CL_1"]["company_name"], got["CL_1"]["payment_verified"], got["CL_1"][RESCUED]) == ("Acme", True, None)
        assert (got["CL_2"]["company_name"], got["CL_2"]["industry"], got["CL_2"]["total_spend_usd"]) == ("Bolt, Nut", None, "12.5")
        assert got["CL_2"][RESCUED] == '{"region":"NA"}'
        assert "surplus" in got["CL_3"][RESCUED] and got["CL_3"]["company_name"] == "Odd"
    drop_file(landed, "clients", ["x,client_uid", "1,CL_4"], "c.csv")
    bronze.ingest(lake, ["clients"], str(landed))
    assert by(lake.read("bronze", "clients"), "client_uid")["CL_4"][RESCUED] == '{"x":"1"}'


def test_headers_of_odd_files(spark, lake, landed):
    """Blank lines before a header, a file of its header alone, an empty one, quoted names and a repeated header."""
    drop_file(landed, "clients", ["", " ", '"company_name",client_uid,"a ""b"", c"', "Dot,CL_5,7", "", '"company_name",client_uid,"a ""b"", c"', "Eel,CL_6,"], "d.csv")
    drop_file(landed, "clients", ["client_uid,company_name"], "e.csv")
    (landed / "clients" / "f.csv").write_bytes(b"")
    bronze.ingest(lake, ["clients"], str(landed))
    for rows in (landing.read_batch(spark, "clients", str(landed)), lake.read("bronze", "clients")):
        got = by(rows, "client_uid")
        assert sorted(got) == ["CL_1", "CL_5", "CL_6"] and rows.count() == 3
        assert got["CL_5"]["company_name"] == "Dot" and got["CL_5"][RESCUED] == '{"a \\"b\\", c":"7"}'
        assert got["CL_6"][RESCUED] is None


def test_rescued_values_are_built_for_rows_that_have_some(spark, landed):
    """Whether a row has anything to rescue is settled without walking through arrays; the outcome stays the same."""
    rows = landing.read_batch(spark, "search_events", str(landed))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("THEN CASE WHEN (size(filter(") == plan.count("CASE WHEN (size(filter(") == 1
    drop_file(landed, "search_events", ["sort,seen,seen on,search_guid,page", "recency,1,,h1,2", "recency,,,h2,2", "recency,,,h3,z", "recency,,,h4,"], "c.csv")
    got = by(landing.read_batch(spark, "search_events", str(landed)), "search_guid")
    assert [got[g][RESCUED] for g in ("h1", "h2", "h3", "h4")] == ['{"seen":"1"}', None, '{"page":"z"}', None]


def test_landing_files_are_compressed_and_bounded(lake, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_PER_FILE", 10)
    others = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW["clients"].fields[2:]]
    made = spark.range(25).selectExpr("concat('CL_', id) AS client_uid", "'a, b' AS company_name", *others)
    landing.write_landing(made, "clients", str(tmp_path), files=1)
    assert len(list((tmp_path / "clients").glob("*.csv.gz"))) == 3
    bronze.ingest(lake, ["clients"], str(tmp_path))
    found = rows(lake.read("bronze", "clients").select("client_uid", "company_name", RESCUED))
    assert {r["client_uid"] for r in found} == {f"CL_{i}" for i in range(25)} and len(found) == 25
    assert all(r["company_name"] == "a, b" and r[RESCUED] is None for r in found)


def test_layers_are_zstd_and_the_sessions_codec_stays(lake, spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/own")
    assert not list(tmp_path.glob("own/*.zstd.parquet")) and list(tmp_path.glob("own/*.parquet"))
    lake.materialize(spark.range(10), "gold", "compressed")
    layer = list(Path(lake.path("gold", "compressed").removeprefix("file:")).glob("*.parquet"))
    assert layer and all(f.name.endswith(".zstd.parquet") for f in layer)


def test_folders_of_a_table_are_listed_by_few_tasks(lake, spark):
    path = lake.path("gold", "by_days")
    spark.range(100).withColumn("d", F.col("id")).repartition(2, "d").write.partitionBy("d").parquet(path)
    context = spark.sparkContext
    context.setJobGroup("listing", "folders of a table")
    try:
        table = spark.read.schema("id long, d long").parquet(path)
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 32
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert table.count() == 100


def test_jobs_do_not_grow_with_files(lake, spark, landed):
    """Two thousand files, in any of three column orders, take as many jobs as twenty."""
    orders = ["client_uid,company_name,country", "company_name,client_uid,country", "extra,country,client_uid"]

    def jobs(folder: str, files: int) -> int:
        for i in range(files):
            values = {"client_uid": f"CL_{i}", "company_name": f"c{i}", "country": "US", "extra": str(i)}
            order = orders[i % 3]
            drop_file(landed / folder, "clients", [order, ",".join(values[c] for c in order.split(","))], f"{i}.csv")
        own = Lake(spark, f"{lake.root}/{folder}")
        query = bronze.start(own, "clients", str(landed / folder))
        query.awaitTermination()
        rows = own.read("bronze", "clients")
        assert rows.select("client_uid").distinct().count() == rows.count() == files
        assert rows.filter("country = 'US'").count() == files
        assert rows.filter(f"{RESCUED} IS NOT NULL").count() == files // 3
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(query.runId))

    few, many = jobs("few", 21), jobs("many", 2001)
    assert many <= few + 2


def test_files_that_arrive_later_need_no_restart(lake, landed):
    query = bronze.start(lake, "clients", str(landed), every="100 milliseconds")
    try:
        query.processAllAvailable()
        drop_file(landed, "clients", ["country,client_uid,new", "FR,CL_8,1"], "late.csv")
        query.processAllAvailable()
    finally:
        query.stop()
    got = by(lake.read("bronze", "clients"), "client_uid")
    assert sorted(got) == ["CL_1", "CL_8"] and got["CL_8"]["country"] == "FR" and got["CL_8"][RESCUED] == '{"new":"1"}'


def test_a_repeated_batch_is_not_written_again(lake, spark, landed):
    """A crash after the rows were committed and before the stream noted it."""
    bronze.ingest(lake, ["clients"], str(landed))
    before = sorted(lake.read("bronze", "clients").inputFiles())
    for noted in Path(lake.checkpoint("bronze_clients"), "commits").iterdir():
        noted.unlink()
    bronze.ingest(lake, ["clients"], str(landed))
    assert sorted(lake.read("bronze", "clients").inputFiles()) == before and len(before) > 0


def test_inferred_schema_is_kept(lake, spark, landed):
    first = bronze.kept_schema(lake, "freelancers", str(landed))
    bronze.start(lake, "freelancers", str(landed), schema=first).awaitTermination()
    header, _ = CSV["freelancers"]
    drop_file(landed, "freelancers", [header, "v2,Bo,US,Clay,none,80,2020-02-02,False,True"], "b.csv")
    assert bronze.kept_schema(lake, "freelancers", str(landed)) == first
    bronze.start(lake, "freelancers", str(landed), schema=first).awaitTermination()
    got = by(lake.read("bronze", "freelancers"), "visitor_id")
    assert got["v1"]["hourly_rate"] == 31.25 and got["v2"]["hourly_rate"] is None
    assert got["v2"][RESCUED] == '{"hourly_rate":"none"}'


def test_inferred_types(spark, landed):
    found = {f.name: f.dataType.simpleString() for f in landing.infer_schema(spark, "click_events", str(landed))}
    assert (found["time_to_click_secs"], found["is_bot"], found["event_ts"]) == ("string", "boolean", "timestamp")


def test_every_file_is_taken_in_once(lake, landed):
    def total():
        bronze.ingest(lake, ["click_events"], str(landed), files_per_batch=1)
        return lake.read("bronze", "click_events").count()

    assert total() == 2
    assert total() == 2
    drop_file(landed, "click_events", CSV["click_events"], "b.csv")
    assert total() == 4


def test_stream_equals_batch_and_logs_counts(lake, spark, landed):
    for n in range(3):
        drop_file(landed, "search_events", CSV["search_events"], f"more{n}.csv")
    bronze.ingest(lake, ["search_events"], str(landed), files_per_batch=1)
    events.start(lake, "search_events").awaitTermination()
    raw = landing.read_batch(spark, "search_events", str(landed))
    keep = [f.name for f in RAW["search_events"]]
    want = sorted(map(str, silver.search_events(raw).select(keep).collect()))
    assert sorted(map(str, events.read_events(lake, "search_events").select(keep).collect())) == want
    summary = rows(quality_reports.rows_processed_vs_dropped(events.read_log(lake)))
    assert summary == [{"table_name": "silver.search_events", "rows_passed": 8, "rows_dropped": 12, "drop_rate_pct": 60.0}]


def test_repeated_batch_replaces_itself(lake, spark, landed):
    raw = landing.read_batch(spark, "click_events", str(landed))
    typed, rules = events.EVENT_FLOWS["click_events"]
    for _ in range(2):
        events.store_checked(lake, typed(raw), "silver", "click_events", rules, 0)
    assert events.read_events(lake, "click_events").count() == 1
    assert rows(quality_reports.rows_processed_vs_dropped(events.read_log(lake)))[0]["rows_passed"] == 1


def test_state_ignores_older_rows_and_survives_repeats(lake, spark):
    target = entities.CurrentState(lake, lake.path("silver", "people"), ["k"], "seq", ["name"])
    schema = "k int, seq int, name string"
    target.apply(spark.createDataFrame([(1, 5, "new"), (1, 4, "old"), (2, 1, "b")], schema), 0)
    late = spark.createDataFrame([(1, 3, "late"), (3, 1, "c")], schema)
    target.apply(late, 1)
    target.apply(late, 1)
    want = [(1, 5, "new"), (2, 1, "b"), (3, 1, "c")]

    def state():
        return sorted(tuple(r) for r in target.current().collect())

    assert state() == want
    target.compact()
    assert state() == want
    target.apply(spark.createDataFrame([(2, 2, "b2")], schema), 2)
    assert state() == [want[0], (2, 2, "b2"), want[2]]
    target.compact()
    target.compact()
    assert state() == [want[0], (2, 2, "b2"), want[2]]


def test_incomplete_base_is_not_read(lake, spark):
    target = entities.CurrentState(lake, lake.path("silver", "people"), ["k"], "seq", [])
    with pytest.raises(ValueError, match="no change"):
        target.current()
    target.apply(spark.createDataFrame([(1, 1)], "k int, seq int"), 0)
    (Path(target.path) / "manifest" / "version=0").mkdir(parents=True)
    assert target.current().count() == 1


@pytest.mark.parametrize("files_per_batch", [1, 2, 10_000])
def test_repeats_are_dropped_whatever_the_batches(lake, spark, landed, files_per_batch):
    """Days apart and in any order: no batch boundary may lose a row or keep a repeat."""
    header, *known = CSV["click_events"]
    for n, day in enumerate((20, 3, 28, 1)):
        moved = [re.sub(r"2023-\d\d-\d\d", f"2023-07-{day:02}", row.replace("c1", f"d{n}").replace("c2", f"e{n}")) for row in known]
        drop_file(landed, "click_events", [header, *moved], f"day{n}.csv")
        drop_file(landed, "click_events", [header, *moved], f"again{n}.csv")
    bronze.ingest(lake, ["click_events"], str(landed), files_per_batch)
    stream = bronze.new_rows(lake, "click_events", files_per_batch)
    out = lake.path("silver", "unique")
    unique = events.without_repeats(stream.filter("event_id IS NOT NULL"), "event_id").writeStream.format("parquet")
    unique.option("checkpointLocation", lake.checkpoint("u")).trigger(availableNow=True).start(out).awaitTermination()
    want = ["c1", "c2", *(f"{k}{n}" for k in "de" for n in range(4))]
    assert sorted(r["event_id"] for r in rows(spark.read.parquet(out))) == want


def test_whole_run_and_second_run_with_changes(lake, spark, landed):
    gold = refresh.refresh(lake, str(landed))
    jobs = by(gold["p_job_performance"], "opening_uid")
    assert (jobs["j1"]["impressions"], jobs["j1"]["clicks"], jobs["j1"]["ctr_pct"]) == (1, 1, 100.0)
    assert (jobs["j2"]["impressions"], jobs["j2"]["clicks"]) == (1, None)
    assert gold["fact_search_events"].count() == 2
    assert lake.read("silver", "quarantine_impression_events").count() == 1
    assert {r["table_name"] for r in rows(quality_reports.rows_processed_vs_dropped(events.read_log(lake)))} == {
        "silver.search_events",
        "silver.impression_events",
        "silver.click_events",
        "gold.p_job_performance",
        "gold.p_daily_metrics",
    }
    renamed = [CSV["job_openings"][0], CSV["job_openings"][1].replace("House Painter", "Head Painter")]
    drop_file(landed, "job_openings", renamed, "b.csv")
    again = refresh.refresh_silver(lake, str(landed))
    titles = {r["opening_uid"]: r["title"] for r in rows(again.jobs)}
    assert titles == {"j1": "Head Painter", "j2": None}
    assert again.clicks.count() == 1
    assert marts_exact.job_performance(again).count() == 2


def test_published_tables_carry_comment_and_quality(lake, spark, landed):
    refresh.refresh(lake, str(landed))
    names = refresh.publish(lake, "test_")
    assert spark.table("test_bronze.search_events").count() == 5
    assert len(names) == len(set(names)) and spark.table("test_gold.fact_search_events").count() == 2
    for name, quality, comment in (
        ("test_bronze.search_events", "bronze", "Searches"),
        ("test_gold.p_daily_metrics", "gold", "Funnel per day"),
    ):
        properties = {r["key"]: r["value"] for r in rows(spark.sql(f"SHOW TBLPROPERTIES {name}"))}
        assert properties["quality"] == quality
        described = {r["col_name"]: r["data_type"] for r in rows(spark.sql(f"DESCRIBE EXTENDED {name}"))}
        assert described["Comment"].startswith(comment)
    for database in ("test_bronze", "test_gold"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_schema_text():
    assert columns("a int, b string").simpleString() == "struct<a:int,b:string>"
