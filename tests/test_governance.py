"""Masks, row filters and audit queries."""

from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from small import rows

from tributary.operators import governance


@pytest.fixture
def visits(spark):
    return spark.createDataFrame([("v1", "c1"), ("v2", "c2"), ("v1", "c2"), (None, "c3")], "visitor_id string, client_uid string")


def test_mask_hides_ids_but_keeps_them_countable(visits):
    hidden = governance.masked(visits, privileged=False)
    digest = hashlib.sha256(b"v1").hexdigest()
    assert [r["visitor_id"] for r in rows(hidden)].count(digest) == 2
    count = F.countDistinct("visitor_id")
    assert hidden.agg(count).first() == visits.agg(count).first()
    assert rows(governance.masked(visits, privileged=True)) == rows(visits)
    assert len(rows(governance.masked_peek(visits, False, 2))) == 2


def test_row_filter(visits):
    assert [r["client_uid"] for r in rows(governance.own_rows(visits, "c2", False))] == ["c2", "c2"]
    assert len(rows(governance.own_rows(visits, "c2", True))) == 4


def test_sql_functions(spark, visits):
    governance.register_functions(spark)
    visits.createOrReplaceTempView("visits")
    got = spark.sql("SELECT mask_visitor_id(visitor_id, true) AS v FROM visits WHERE client_row_filter(client_uid, 'c1', false)")
    assert rows(got) == [{"v": "v1"}]


def test_audit_and_lineage(spark):
    audit = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 1), ("a@x",), "SELECT", ("market.gold.t",)),
            (2, datetime(2024, 1, 3), ("b@x",), "GRANT", ("market.gold.t",)),
            (3, datetime(2024, 1, 4), ("c@x",), "LOGIN", ("market.gold.t",)),
            (4, datetime(2024, 1, 5), ("d@x",), "SELECT", ("marketing.t",)),
        ],
        "event_id int, event_time timestamp, user_identity struct<email:string>, action_name string, "
        "request_params struct<table_full_name:string>",
    )
    assert [r["user_email"] for r in rows(governance.recent_access(audit, "market"))] == ["b@x", "a@x"]
    lineage = spark.createDataFrame(
        [("s", "b", "t", "y"), ("s", "a", "t", "x"), ("s", "a", "u", "x")],
        "source_table_full_name string, source_column_name string, target_table_full_name string, target_column_name string",
    )
    assert [r["target_column_name"] for r in rows(governance.column_lineage_of(lineage, "t"))] == ["x", "y"]
