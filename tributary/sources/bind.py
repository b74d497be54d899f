"""The given tables read as the six raw marketplace datasets.

Every expression works row by row, so a bound dataset is as large as the table
it comes from: searches are orders, impressions are line items, clicks are the
returned line items, jobs are parts, clients are suppliers, freelancers are
customers.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOUND = ("orders", "lineitem", "part", "supplier", "customer", "events")
SEARCH_TS = "o_orderdate + (o_orderkey % 24) * interval '1' hour"
SEARCHER = "CASE WHEN o_custkey % 100 = 7 THEN NULL ELSE o_custkey END"


class RawTables:
    """Raw datasets over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its footer is read once, however often it is used."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def gigabytes(self) -> float:
        """The size of the tables that are bound, as they are stored."""
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        paths = [self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet") for name in BOUND]
        found = [(path, path.getFileSystem(conf)) for path in paths]
        return sum(system.getContentSummary(path).getLength() for path, system in found if system.exists(path)) / 2**30

    @cached_property
    def search_events(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS search_guid",
            f"{SEARCHER} AS visitor_id",
            "o_orderpriority AS search_query",
            "CASE WHEN o_orderkey % 50 = 0 THEN 'homepage_banner' "
            "WHEN o_orderstatus = 'F' THEN 'featured_jobs' ELSE 'search_results' END AS sublocation",
            "CASE WHEN o_orderkey % 3 = 0 THEN 'relevance' ELSE 'recency' END AS sort",
            "CAST(1 + o_orderkey % 10 AS INT) AS page",
            f"{SEARCH_TS} AS event_ts",
        )

    def _shown(self) -> DataFrame:
        searches = self.table("orders").selectExpr(
            "o_orderkey AS l_orderkey", f"{SEARCHER} AS visitor_id", f"{SEARCH_TS} AS search_ts"
        )
        return self.table("lineitem").join(searches, "l_orderkey")

    _EVENT = (
        "concat_ws('-', l_orderkey, l_partkey, l_linenumber, l_suppkey) AS event_id",
        "visitor_id",
        "l_orderkey AS search_guid",
    )

    @cached_property
    def impression_events(self) -> DataFrame:
        """Every line item. Some are shown under the next job's id, so that jobs have clicks but no impression, as in a feed with gaps."""
        return self._shown().selectExpr(
            *self._EVENT,
            "CASE WHEN l_partkey % 53 = 7 THEN l_partkey + 1 ELSE l_partkey END AS opening_uid",
            "l_linenumber AS position",
            "search_ts AS event_ts",
            "l_shipdate AS collector_ts",
            "CASE WHEN l_tax = 0 THEN 'True' ELSE 'False' END AS is_bot",
        )

    @cached_property
    def click_events(self) -> DataFrame:
        return self._shown().filter("l_returnflag = 'R'").selectExpr(
            *self._EVENT,
            "CASE WHEN l_orderkey % 97 = 3 THEN NULL ELSE l_partkey END AS opening_uid",
            "l_linenumber AS position",
            "search_ts + CAST(l_quantity AS INT) * interval '1' second AS event_ts",
            "l_shipdate AS collector_ts",
            "CASE WHEN l_tax = 0 THEN 'True' ELSE 'False' END AS is_bot",
            "CASE CAST(l_quantity AS INT) WHEN 50 THEN 'instant' WHEN 49 THEN 'fast' WHEN 48 THEN '-5' "
            "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS time_to_click_secs",
        )

    @cached_property
    def job_openings(self) -> DataFrame:
        owners = self.table("supplier").agg((F.count("s_suppkey") - 1).alias("n")).scalar()
        return self.table("part").select(
            F.col("p_partkey").alias("opening_uid"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("budget_type"),
            F.expr(
                "CASE WHEN p_size = 50 THEN 'negotiable' ELSE CAST(p_retailprice AS STRING) END"
            ).alias("budget_amount"),
            (F.col("p_partkey") % owners).alias("client_uid"),
            F.expr("DATE '2024-01-01' + CAST(p_partkey % 365 AS INT)").alias("posted_at"),
            (F.col("p_size") <= 40).alias("is_active"),
        )

    def _with_country(self, people: DataFrame, nation_key: str) -> DataFrame:
        nations = self.table("nation").selectExpr(f"n_nationkey AS {nation_key}", "n_name AS country")
        return people.join(nations, nation_key, "left")

    @cached_property
    def clients(self) -> DataFrame:
        return self._with_country(self.table("supplier"), "s_nationkey").selectExpr(
            "s_suppkey AS client_uid",
            "s_name AS company_name",
            "country",
            "CASE s_suppkey % 4 WHEN 0 THEN 'IT & Networking' WHEN 1 THEN 'Design & Creative' "
            "WHEN 2 THEN 'Marketing & Sales' ELSE 'Business Consulting' END AS industry",
            "s_suppkey % 5 <> 0 AS payment_verified",
            "CASE WHEN s_suppkey % 10 = 9 THEN 'not disclosed' ELSE CAST(s_acctbal AS STRING) END "
            "AS total_spend_usd",
            "DATE '2017-01-01' + CAST(s_suppkey % 1000 AS INT) AS member_since",
            "CAST(CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 3.0 + (s_suppkey % 20) / 10.0 END AS DOUBLE) "
            "AS avg_rating",
        )

    @cached_property
    def freelancers(self) -> DataFrame:
        return self._with_country(self.table("customer"), "c_nationkey").selectExpr(
            "c_custkey AS visitor_id",
            "c_name AS name",
            "country",
            "c_mktsegment AS primary_skill",
            "CASE WHEN c_custkey % 20 = 3 THEN 'negotiable' ELSE CAST(20 + c_custkey % 60 AS STRING) END "
            "AS hourly_rate",
            "CASE WHEN c_custkey % 8 = 5 THEN 'N/A' ELSE CAST(c_custkey % 100 AS STRING) END "
            "AS job_success_score",
            "DATE '2016-01-01' + CAST(c_custkey % 1500 AS INT) AS member_since",
            "c_acctbal > 5000 AS top_rated",
            "c_custkey % 6 <> 0 AS is_verified",
        )

    @cached_property
    def audit_log(self) -> DataFrame:
        """Access records: who did what to which table."""
        return self.table("events").selectExpr(
            "event_id",
            "ts AS event_time",
            "named_struct('email', concat('user', user_id, '@example.com')) AS user_identity",
            "CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'click' THEN 'CREATE TABLE' "
            "WHEN 'signup' THEN 'ALTER TABLE' WHEN 'purchase' THEN 'GRANT' ELSE 'LOGIN' END AS action_name",
            "named_struct('table_full_name', concat(CASE WHEN user_id % 3 = 0 THEN 'sandbox.' "
            "ELSE 'market.gold.' END, 'table_', user_id % 20)) AS request_params",
        )

    @cached_property
    def column_lineage(self) -> DataFrame:
        """One row per recorded column derivation."""
        return self.table("events").selectExpr(
            "event_id",
            "concat('market.silver.', event_type) AS source_table_full_name",
            "concat('col_', user_id % 7) AS source_column_name",
            "concat('market.gold.table_', user_id % 20) AS target_table_full_name",
            "concat('col_', event_id % 11) AS target_column_name",
        )
