from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gantry import (
    AmbiguousMergeError,
    ContractViolation,
    LakePaths,
    build_gold,
    cleanse_silver,
    ingest_bronze,
    read_table,
    run_pipeline,
)
from gantry.schema import FACT_COLUMNS
from gantry.sources.landing import read_landing, write_landing
from gantry.sources.tables import latest_snapshot
from tests.helpers import FIELDS, FIVE, bag, land, message

LINEAGE = ["ingestion_timestamp", "source_system"]


@pytest.fixture
def paths(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


def contents(spark, paths):
    """All four tables without the ingestion instant."""
    return [
        bag(read_table(spark, p).drop("ingestion_timestamp"))
        for p in (paths.bronze, paths.silver, paths.fact, paths.dim)
    ]


def test_five_readings(spark, paths, tmp_path):
    landing = land(tmp_path / "in", FIVE)
    ingest_bronze(spark, landing, paths.bronze)
    bronze = read_table(spark, paths.bronze)
    assert bronze.count() == 5
    assert set(bronze.columns) == {*FIELDS, "_corrupt_record", "_extra_fields", *LINEAGE}
    assert bag(bronze, "source_system") == Counter({("crane_iot_sensors",): 5})
    assert bronze.select("ingestion_timestamp").distinct().count() == 1

    assert cleanse_silver(spark, paths.bronze, paths.silver) == []
    silver = read_table(spark, paths.silver)
    assert bag(silver, "message_id") == Counter([("m1",), ("m2",), ("m3",)])
    assert silver.schema == bronze.schema

    build_gold(spark, paths.silver, paths.fact, paths.dim)
    fact, dim = read_table(spark, paths.fact), read_table(spark, paths.dim)
    assert fact.columns == FACT_COLUMNS
    assert dict(fact.dtypes)["event_time"] == "timestamp"
    assert fact.count() == 3
    assert bag(dim) == Counter([("A", "M1", "R1"), ("B", "M2", "R2")])


@pytest.mark.parametrize("incremental", [True, False])
def test_rerun_changes_nothing(spark, paths, tmp_path, incremental):
    landing = land(tmp_path / "in", FIVE)
    run_pipeline(spark, landing, paths, incremental=incremental)
    before = contents(spark, paths)
    run_pipeline(spark, landing, paths, incremental=incremental)
    assert contents(spark, paths) == before


@pytest.mark.parametrize("incremental", [True, False])
def test_second_batch_updates_inserts_and_keeps(spark, paths, tmp_path, incremental):
    run_pipeline(spark, land(tmp_path / "one", FIVE), paths, incremental=incremental)
    batch = [
        message("m1", "A", "2030-05-01T08:00:00Z", 111.0, 2.0),
        message("m3", "B", "2030-05-03T08:00:00Z", 333.0, 3.0, "M2", "R2"),
        message("m6", "D", "2030-05-02T08:00:00Z", 666.0, 6.0, "M3", "R3"),
    ]
    run_pipeline(spark, land(tmp_path / "two", batch), paths, incremental=incremental)
    loads = {r.message_id: r.hoist_load_kg for r in read_table(spark, paths.fact).collect()}
    assert loads == {"m1": 111.0, "m2": 45000.0, "m3": 333.0, "m6": 666.0}
    assert read_table(spark, paths.bronze).count() == 6
    assert bag(read_table(spark, paths.dim), "crane_id") == Counter([("A",), ("B",), ("D",)])


@pytest.mark.parametrize("incremental", [True, False])
def test_row_that_becomes_invalid_stays_in_silver(spark, paths, tmp_path, incremental):
    run_pipeline(spark, land(tmp_path / "one", [message("m1", load=10.0), message("m2")]), paths)
    run_pipeline(spark, land(tmp_path / "two", [message("m1", load=-1.0)]), paths, incremental=incremental)
    stored = {r.message_id: r.hoist_load_kg for r in read_table(spark, paths.silver).collect()}
    assert stored["m1"] == 10.0
    bronze = {r.message_id: r.hoist_load_kg for r in read_table(spark, paths.bronze).collect()}
    assert bronze["m1"] == -1.0


def test_older_batch_replayed_wins(spark, paths, tmp_path):
    """There is no order between batches: the last one merged counts."""
    old, new = land(tmp_path / "one", [message("m1", load=1.0)]), land(tmp_path / "two", [message("m1", load=2.0)])
    for landing in (old, new, old):
        run_pipeline(spark, landing, paths)
    assert bag(read_table(spark, paths.fact), "hoist_load_kg") == Counter([(1.0,)])


def test_unreadable_lines(spark, paths, tmp_path):
    broken = ["{bad json", json.dumps({**message("m9"), "hoist_load_kg": "abc"})]
    landing = land(tmp_path / "in", [message("m1")], broken)
    run_pipeline(spark, landing, paths)
    kept = {(r.message_id, r._corrupt_record) for r in read_table(spark, paths.bronze).collect()}
    assert kept == {("m1", None), (None, "{bad json"), ("m9", broken[1])}
    assert bag(read_table(spark, paths.silver), "message_id") == Counter([("m1",)])
    # A line without an id matches nothing, so it is added again.
    run_pipeline(spark, landing, paths)
    assert bag(read_table(spark, paths.bronze), "message_id") == Counter([("m1",), ("m9",), (None,), (None,)])


def test_null_timestamp(spark, paths, tmp_path):
    landing = land(tmp_path / "in", [message("m1"), message("m2", when=None), message("m3", when="soon")])
    with pytest.raises(ContractViolation):
        run_pipeline(spark, landing, paths)
    found = run_pipeline(spark, landing, LakePaths(paths.base + "2"), mode="report")
    assert [(v.column, v.check, v.failures) for v in found] == [("timestamp", "not_null", 1)]
    times = {r.message_id: r.event_time for r in read_table(spark, paths.base + "2/gold/fact_telemetry").collect()}
    assert times["m1"] is not None and times["m2"] is None and times["m3"] is None


def test_conflicting_crane(spark, paths, tmp_path):
    rows = [
        message("m1", "A", "2030-05-01T08:00:00Z", model="OLD"),
        message("m2", "A", "2030-05-02T08:00:00Z", model="NEW"),
    ]
    landing = land(tmp_path / "in", rows)
    run_pipeline(spark, landing, paths)
    assert bag(read_table(spark, paths.dim), "crane_model") == Counter([("OLD",), ("NEW",)])
    with pytest.raises(AmbiguousMergeError):
        run_pipeline(spark, landing, paths)
    build_gold(spark, paths.silver, paths.fact, paths.base + "/gold/dim_latest", latest_wins=True)
    assert bag(read_table(spark, paths.base + "/gold/dim_latest")) == Counter([("A", "NEW", "R1")])


def test_landing_types(spark, tmp_path):
    whole = {**message("m1"), "hoist_load_kg": 25000}
    landing = land(tmp_path / "in", [whole])
    assert dict(read_landing(spark, landing).dtypes)["hoist_load_kg"] == "double"
    inferred = read_landing(spark, landing, infer=True)
    assert dict(inferred.dtypes)["hoist_load_kg"] == "bigint"
    assert inferred.columns == [*sorted(FIELDS), "_corrupt_record"]


def test_unknown_fields_reach_silver(spark, paths, tmp_path):
    landing = land(tmp_path / "in", [{**message("m1"), "firmware": "v2", "site": {"dock": 4}}, message("m2")])
    run_pipeline(spark, landing, paths)
    kept = {r.message_id: r._extra_fields for r in read_table(spark, paths.silver).collect()}
    assert kept == {"m1": '{"firmware":"v2","site":"{\\"dock\\":4}"}', "m2": None}


def test_inferred_batches_with_and_without_a_broken_line(spark, paths, tmp_path):
    ingest_bronze(spark, land(tmp_path / "a", [message("m1")], ["{bad json"]), paths.bronze, infer=True)
    ingest_bronze(spark, land(tmp_path / "b", [message("m2")]), paths.bronze, infer=True)
    assert read_table(spark, paths.bronze).count() == 3


def test_inferred_batch_through_all_layers(spark, paths, tmp_path):
    landing = land(tmp_path / "in", FIVE)
    ingest_bronze(spark, landing, paths.bronze, infer=True)
    cleanse_silver(spark, paths.bronze, paths.silver)
    assert read_table(spark, paths.silver).count() == 3


def test_landing_round_trip(spark, tmp_path):
    landing = land(tmp_path / "in", [*FIVE, message("n", crane=None, load=None)])
    rows = read_landing(spark, landing)
    write_landing(rows, str(tmp_path / "copy"))
    assert bag(read_landing(spark, str(tmp_path / "copy"))) == bag(rows)


def test_nan_literal(spark, tmp_path):
    line = json.dumps(message("m1")).replace("100.0", "NaN")
    landing = land(tmp_path / "in", [], [line])
    assert read_landing(spark, landing).filter(F.isnan("hoist_load_kg")).count() == 1


def test_repeated_message_ids(spark, paths, tmp_path):
    """The first load keeps repeats, in every layer; merging them again is refused."""
    landing = land(tmp_path / "in", [message("m1", load=1.0), message("m1", load=2.0), message("m2")])
    run_pipeline(spark, landing, paths)
    for path in (paths.bronze, paths.silver, paths.fact):
        assert read_table(spark, path).count() == 3
        assert latest_snapshot(spark, path).unique_key is None
    with pytest.raises(AmbiguousMergeError):
        run_pipeline(spark, landing, paths)


def test_uniqueness_is_handed_down(spark, paths, tmp_path):
    landing = land(tmp_path / "in", FIVE)
    for _ in range(2):
        run_pipeline(spark, landing, paths)
        keys = [latest_snapshot(spark, p).unique_key for p in (paths.bronze, paths.silver, paths.fact, paths.dim)]
        assert keys == ["message_id", "message_id", "message_id", "crane_id"]
