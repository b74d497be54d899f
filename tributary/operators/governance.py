"""Column masks, row filters and audit queries.

The caller's role and identity are arguments: Spark itself has no group
membership to ask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ACCESS_ACTIONS = ("SELECT", "CREATE TABLE", "ALTER TABLE", "GRANT")


def mask_visitor_id(visitor_id: Column, privileged: bool) -> Column:
    """The id itself for the privileged role, else its SHA-256 in hex.

    Equal ids have equal hashes, so distinct visitors can still be counted.
    """
    text = visitor_id.cast("string")
    return text if privileged else F.sha2(text, 256)


def masked(df: DataFrame, privileged: bool, column: str = "visitor_id") -> DataFrame:
    return df.withColumn(column, mask_visitor_id(F.col(column), privileged))


def own_rows(df: DataFrame, user: str, privileged: bool, column: str = "client_uid") -> DataFrame:
    """All rows for the privileged role, else those that carry the user's own key.

    A plain filter, so it reaches the scan.
    """
    return df if privileged else df.filter(F.col(column) == F.lit(user))


def masked_peek(df: DataFrame, privileged: bool, rows: int = 5) -> DataFrame:
    return masked(df, privileged).select("visitor_id").limit(rows)


def recent_access(audit: DataFrame, catalog: str, rows: int = 50) -> DataFrame:
    """The newest accesses to tables of a catalog; ties by `event_id`."""
    table = F.col("request_params.table_full_name")
    return (
        audit.filter(F.col("action_name").isin(*ACCESS_ACTIONS) & table.startswith(f"{catalog}."))
        .orderBy(F.desc("event_time"), "event_id")
        .limit(rows)
        .select(
            "event_time",
            F.col("user_identity.email").alias("user_email"),
            "action_name",
            table.alias("table_name"),
        )
    )


def column_lineage_of(lineage: DataFrame, table: str) -> DataFrame:
    """Which columns feed the columns of a table."""
    return (
        lineage.filter(F.col("target_table_full_name") == table)
        .select(
            "source_table_full_name", "source_column_name", "target_table_full_name", "target_column_name"
        )
        .orderBy("target_column_name", "source_table_full_name", "source_column_name")
    )


def register_functions(spark: SparkSession) -> None:
    """The mask and the row filter as SQL functions; role and user are arguments."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_visitor_id(visitor_id STRING, privileged BOOLEAN) "
        "RETURNS STRING RETURN CASE WHEN privileged THEN visitor_id ELSE sha2(visitor_id, 256) END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION client_row_filter(client_uid STRING, caller STRING, "
        "privileged BOOLEAN) RETURNS BOOLEAN RETURN privileged OR client_uid = caller"
    )
