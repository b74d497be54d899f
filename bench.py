"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads, BENCH_RUNS the timed runs
per query after a warm-up pass over all queries (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary import registry  # noqa: E402
from tributary.session import build_session  # noqa: E402

HEADLINE = """
silver_impression_events silver_click_events expect_counts_click_events quarantine_click_events
scd1_customer_orders dq_expectation_breakdown
p_job_performance p_search_query_performance p_position_ctr p_category_performance
p_sublocation_performance p_daily_metrics
s_fact_search_funnel s_job_performance_ctr s_job_performance_ctr_approx s_impression_position_ctr
s_search_query_performance s_category_performance s_sublocation_performance s_daily_metrics
s_daily_metrics_approx s_visitor_engagement s_job_click_engagement s_search_to_click_conversion
s_hourly_activity
dim_client fact_search_events client_posting_performance client_category_benchmark client_opportunities
mv_clickstream_by_industry mv_clickstream_by_country_and_skill mv_search_funnel
ins_client_activity q_behaviour_by_hourly_rate gov_masked_clicks
""".split()

# Measured once: they write files, so a warm-up run would only repeat the writing.
STREAMS = ["streamed_silver_click_events", "scd1_customer_orders_stream", "medallion_job_performance"]


def run(query, spark, folder: str) -> float:
    """Seconds until all rows were produced; nothing is sent to the driver."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = registry.queries()
    seconds = {}
    # One whole pass first, so that no query pays for the compiler of the others.
    for name in HEADLINE:
        run(found[name], spark, folder)
    for name in HEADLINE:
        seconds[name] = round(statistics.median(run(found[name], spark, folder) for _ in range(runs)), 3)
    for name in STREAMS:
        seconds[name] = round(run(found[name], spark, folder), 3)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
