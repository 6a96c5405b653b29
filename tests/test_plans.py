"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from gantry.catalog import QUERIES
from gantry.operators.contract import contract_report
from gantry.operators.merge import merge_upsert
from gantry.plans.stages import to_dim, to_silver
from gantry.sources import sample
from gantry.sources.scratch import stored

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def telemetry(spark):
    return stored(sample.telemetry(spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "NestedLoopJoin", "Pandas"):
        assert node not in text


def test_bounds_reach_the_scan(telemetry):
    text = plan(to_silver(telemetry))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    for part in ("IsNotNull(message_id)", "IsNotNull(crane_id)", "GreaterThanOrEqual(hoist_load_kg,0.0)",
                 "LessThanOrEqual(hoist_load_kg,50000.0)", "LessThanOrEqual(vibration_mm_s,100.0)"):
        assert part in pushed
    assert "Exchange" not in text


def test_dim_reads_only_what_it_needs(telemetry):
    text = plan(to_dim(to_silver(telemetry)))
    assert "timestamp" not in text
    # One shuffle, after combining.
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("HashAggregate") == 2


def test_contract_is_one_pass(telemetry):
    text = plan(contract_report(telemetry))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "crane_model" not in text


def test_small_batch_does_not_shuffle_the_target(spark, telemetry):
    batch = stored(sample.telemetry(spark, SF_DIR))
    text = plan(merge_upsert(telemetry, batch, "message_id"))
    assert "SortMergeJoin" not in text
    # The only shuffle is of keys that were already matched.
    exchanges = re.findall(r"Exchange hashpartitioning.*\n.*\n.*", text)
    assert len(exchanges) == 1
    assert "LeftSemi" in exchanges[0]


def test_large_batch_is_shuffled_once(spark, telemetry):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        merged = merge_upsert(telemetry, stored(sample.telemetry(spark, SF_DIR)), "message_id")
        merged.collect()
        text = plan(merged).split("Initial Plan")[0]
    finally:
        for k in off:
            spark.conf.unset(k)
    assert "BroadcastHashJoin" not in text
    assert text.count("ReusedExchange") == 1


def test_stored_dim_is_broadcast_by_its_size(spark):
    text = plan(QUERIES["star_rollup"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        text = plan(QUERIES["star_rollup"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text
