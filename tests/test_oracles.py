"""Every registered query against its DuckDB oracle on the smallest tables, and its plan."""

import os

import pytest

import checks.families  # noqa: F401
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, oracle, name):
    ok, note = compare(spark, oracle, SF_DIR, name)
    assert ok, note


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


# Everything that pairs two inputs: none may fall back to comparing all pairs.
JOINING = [
    "lineage_consumers", "recent_writes", "external_location_cover", "parent_managed_location", "schema_audit", "object_state", "claim",
    "drop_decisions", "log_directory_evidence", "table_checksum_evidence", "inherited_grant_revokes", "compare_listings", "capture_snapshot",
    "writes_while_cloned", "illegal_log_events",
]


@pytest.mark.parametrize("name", JOINING)
def test_no_pairwise_join_even_without_broadcasts(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_time_bound_reaches_the_scan(spark):
    plan = QUERIES["lineage_consumers"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_shipdate" in plan


def test_both_halves_of_a_listing_compare_share_one_shuffle(spark):
    frame = QUERIES["compare_listings"](spark, SF_DIR)
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()
