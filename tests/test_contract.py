from __future__ import annotations

import math

import pytest

from gantry.operators.contract import ContractViolation, Violation, contract_report, enforce, keep_valid
from gantry.schema import TELEMETRY
from tests.helpers import bag, message


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], TELEMETRY)


def test_bounds_are_inclusive_and_nan_is_out(spark):
    loads = [-0.0, 0.0, 50000.0, 50000.0000001, math.nan, None, -0.1]
    rows = [message(str(i), load=load) for i, load in enumerate(loads)]
    rows += [message(f"v{v}", vibration=v) for v in (0.0, 100.0, 100.0000001, math.nan, None)]
    kept = {r.message_id for r in keep_valid(frame(spark, rows)).collect()}
    assert kept == {"0", "1", "2", "v0.0", "v100.0"}


def test_rows_without_ids_are_dropped_without_timestamp_kept(spark):
    rows = [message(None), message("a", crane=None), message("b", when=None), message("c", model=None, region=None)]
    assert {r.message_id for r in keep_valid(frame(spark, rows)).collect()} == {"b", "c"}


def test_report_counts_every_rule(spark):
    rows = [
        message(None, load=-1.0, vibration=101.0),
        message("a", when=None, load=None),
        message("b", load=math.nan, vibration=-1.0),
    ]
    counts = {(r.column_name, r.check_name): r.failures for r in contract_report(frame(spark, rows)).collect()}
    assert counts == {
        ("message_id", "not_null"): 1,
        ("crane_id", "not_null"): 0,
        ("timestamp", "not_null"): 1,
        ("hoist_load_kg", "not_null"): 1,
        ("hoist_load_kg", "at_least"): 1,
        # NaN sorts above every number.
        ("hoist_load_kg", "at_most"): 1,
        ("vibration_mm_s", "not_null"): 0,
        ("vibration_mm_s", "at_least"): 1,
        ("vibration_mm_s", "at_most"): 1,
    }


def test_report_of_no_rows(spark):
    report = contract_report(frame(spark, [])).collect()
    assert len(report) == 9
    assert all(r.failures == 0 and r.rows_checked == 0 for r in report)


def test_null_timestamp_stops_or_is_reported(spark):
    df = keep_valid(frame(spark, [message("a"), message("b", when=None)]))
    with pytest.raises(ContractViolation) as stopped:
        enforce(df)
    assert stopped.value.violations == [Violation("timestamp", "not_null", 1)]
    same, found = enforce(df, "report")
    assert found == [Violation("timestamp", "not_null", 1)]
    assert bag(same) == bag(df)


def test_missing_column_and_wrong_type(spark):
    bad = spark.createDataFrame(
        [("A", "2030-05-01T08:00:00Z", "heavy", 10.0)],
        "crane_id string, timestamp string, hoist_load_kg string, vibration_mm_s double",
    )
    expected = [Violation("message_id", "present"), Violation("hoist_load_kg", "type double")]
    with pytest.raises(ContractViolation) as stopped:
        enforce(bad, "fail")
    assert stopped.value.violations == expected
    assert enforce(bad, "report")[1] == expected


def test_text_measure_is_read_where_possible(spark):
    """A batch whose load was inferred as text: unreadable values drop, no crash."""
    rows = [("a", "A", "t", "10.5", 1.0), ("b", "A", "t", "heavy", 1.0), ("c", "A", "t", "60000", 1.0)]
    df = spark.createDataFrame(
        rows, "message_id string, crane_id string, timestamp string, hoist_load_kg string, vibration_mm_s double"
    )
    assert [r.message_id for r in keep_valid(df).collect()] == ["a"]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        enforce(frame(spark, []), "warn")
