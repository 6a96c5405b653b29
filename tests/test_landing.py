"""Landing lines read through variants."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gantry.sources.landing import parse_lines, read_landing
from tests.helpers import land, message


def parsed(spark, *lines):
    rows = parse_lines(spark.createDataFrame([(line,) for line in lines], "value string")).collect()
    assert len(rows) == len(lines)
    return rows


@pytest.mark.parametrize(
    "text, load, kept",
    [
        ("25000", 25000.0, False),
        ("45.125", 45.125, False),
        ("-0.0", 0.0, False),
        ("1e3", 1000.0, False),
        ("12345678901234567890123456789012345678901234567890", 1.2345678901234567e49, False),
        ("null", None, False),
        ('"abc"', None, True),
        ('"45"', None, True),
        ("true", None, True),
        ("[1]", None, True),
        ("{}", None, True),
    ],
)
def test_measures(spark, text, load, kept):
    line = '{"message_id":"m","hoist_load_kg":' + text + ',"vibration_mm_s":2}'
    (row,) = parsed(spark, line)
    assert (row.message_id, row.hoist_load_kg, row.vibration_mm_s) == ("m", load, 2.0)
    assert row._corrupt_record == (line if kept else None)


def test_texts_take_any_value(spark):
    (row,) = parsed(spark, '{"message_id":7,"crane_id":true,"crane_model":{"a":[1]},"timestamp":null}')
    assert (row.message_id, row.crane_id, row.crane_model, row.timestamp) == ("7", "true", '{"a":[1]}', None)
    assert row._corrupt_record is None


@pytest.mark.parametrize("line", ["{bad json", "[1]", "5", '"text"', '{"message_id":"cut off'])
def test_what_is_no_object_is_kept_raw(spark, line):
    (row,) = parsed(spark, line)
    assert row._corrupt_record == line and row.message_id is None


def test_what_a_variant_refuses_is_read_leniently(spark):
    nan, twice = parsed(spark, '{"message_id":"n","hoist_load_kg":NaN,"x":1}', '{"crane_id":"a","crane_id":"b"}')
    assert nan.message_id == "n" and str(nan.hoist_load_kg) == "nan" and nan._extra_fields == '{"x":"1"}'
    assert twice.crane_id == "b"


@pytest.mark.parametrize(
    "line, extra",
    [
        ('{"message_id":"m","x":1}', {"x": "1"}),
        ('{"x" : 1, "message_id":"m"}', {"x": "1"}),
        ('{"x"\t:1,"message_id":"m"}', {"x": "1"}),
        ('{"message_id":"m","crane_id":null,"x":null}', {"x": None}),
        ('{"message_id":"a\\":b","x":"\\":"}', {"x": '":'}),
        ('{"message_id":"m","n":{"crane_id":[1,{"y":2}]}}', {"n": '{"crane_id":[1,{"y":2}]}'}),
        ('{"message_id":"m","crane_id":"c"}', None),
        ('{"message_id":"has \\" : in it"}', None),
        ("{}", None),
    ],
)
def test_unknown_fields(spark, line, extra):
    (row,) = parsed(spark, line)
    assert (row._extra_fields and json.loads(row._extra_fields)) == extra
    assert row._corrupt_record is None


def test_one_parse(spark):
    """Of the three ways to read a line only one is taken unless the line may hold unknown fields."""
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = parse_lines(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    guarded = plan[plan.index("CASE WHEN ((") :]
    assert plan.count("from_json") == 2 and guarded.count("from_json") == 2 and "parseJson" in guarded


def test_inferred_types_merge(spark, tmp_path):
    rows = [
        {"a": 1, "n": {"x": 1}, "mixed": 1, "list": [1]},
        {"a": 2.5, "n": {"y": "t"}, "mixed": "one", "list": [2.5], "late": True},
        {"n": None},
    ]
    folder = land(tmp_path / "in", rows, ["{bad", "[1, 2]", "  "])
    df = read_landing(spark, folder, infer=True)
    assert dict(df.dtypes) == {
        "a": "double",
        "late": "boolean",
        "list": "array<double>",
        "mixed": "string",
        "n": "struct<x:bigint,y:string>",
        "_corrupt_record": "string",
    }
    found = {json.dumps(r.asDict(True), sort_keys=True) for r in df.collect()}
    nothing = dict.fromkeys(df.columns)
    assert found == {
        json.dumps({**nothing, **expected}, sort_keys=True)
        for expected in (
            {"a": 1.0, "n": {"x": 1, "y": None}, "mixed": "1", "list": [1.0]},
            {"a": 2.5, "n": {"x": None, "y": "t"}, "mixed": "one", "list": [2.5], "late": True},
            {},
            {"_corrupt_record": "{bad"},
            {"_corrupt_record": "[1, 2]"},
        )
    }


def test_nothing_to_infer_from(spark, tmp_path):
    df = read_landing(spark, land(tmp_path / "in", [], ["{bad"]), infer=True)
    assert [tuple(r) for r in df.collect()] == [("{bad",)]


def test_inferred_telemetry_equals_fixed(spark, tmp_path):
    folder = land(tmp_path / "in", [message("m1"), message("m2", load=5.5)])
    fixed = read_landing(spark, folder).drop("_extra_fields")
    inferred = read_landing(spark, folder, infer=True).select(fixed.columns)
    assert fixed.exceptAll(inferred).isEmpty() and inferred.where(F.col("hoist_load_kg") == 5.5).count() == 1
