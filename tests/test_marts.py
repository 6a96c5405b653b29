from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gantry.functions.telemetry import parse_event_time
from gantry.operators.star import enrich_dim, granted_regions, star_join, visible_cranes, visible_facts
from gantry.plans import marts
from gantry.plans.stages import to_bronze, to_dim, to_dim_latest, to_fact, to_silver
from gantry.schema import TELEMETRY
from tests.helpers import FIVE, bag, message


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], TELEMETRY)


def test_event_time_forms(spark):
    expected = {
        "2030-05-01T08:00:00Z": "2030-05-01 08:00:00",
        "2030-05-01T10:00:00+02:00": "2030-05-01 08:00:00",
        "2030-05-01 08:00:00": "2030-05-01 08:00:00",
        "2030-05-01T08:00:00.123456Z": "2030-05-01 08:00:00.123456",
        "2030-05-01": "2030-05-01 00:00:00",
        "garbage": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in expected], "txt string")
    parsed = df.select("txt", parse_event_time("txt").cast("string").alias("t"))
    assert {r.txt: r.t for r in parsed.collect()} == expected


def test_thresholds_are_strict_and_either_counts(spark):
    rows = [
        message("edge", load=45000.0, vibration=45.0),
        message("load", load=45000.1),
        message("shake", vibration=45.1),
        message("both", load=46000.0, vibration=46.0),
    ]
    flags = {r.message_id: (r.is_vibration_critical, r.is_load_critical, r.is_critical)
             for r in marts.anomaly_flags(frame(spark, rows)).collect()}
    assert flags == {
        "edge": (False, False, False),
        "load": (False, True, True),
        "shake": (True, False, True),
        "both": (True, True, True),
    }
    totals = marts.anomaly_totals(frame(spark, rows)).collect()[0]
    assert (totals.vibration_anomalies, totals.load_anomalies, totals.total_critical_anomalies) == (2, 2, 3)


def test_mtbf(spark):
    rows = [message(str(i), "A", vibration=50.0 if i < 2 else 1.0) for i in range(24)]
    rows += [message("q", "B")]
    by_crane = {r.crane_id: r for r in marts.mtbf(frame(spark, rows)).collect()}
    assert by_crane["A"].operating_hours == 2.0
    assert by_crane["A"].mtbf_hours == 1.0
    assert by_crane["B"].mtbf_hours is None


def test_hourly(spark):
    rows = [
        message("a", when="2030-05-01T08:00:00Z", load=1.0, vibration=1.0),
        message("b", when="2030-05-01T08:59:59Z", load=2.0, vibration=2.0),
        message("c", when="2030-05-01T09:00:00Z", load=3.0, vibration=50.0),
        message("d", when="soon"),
    ]
    hourly = marts.crane_hourly(to_fact(frame(spark, rows)))
    got = {r.hour_start: (r.readings, r.max_load_kg, r.avg_vibration_mm_s, r.anomalies) for r in hourly.collect()}
    assert got == {datetime(2030, 5, 1, 8): (2, 2.0, 1.5, 0), datetime(2030, 5, 1, 9): (1, 3.0, 50.0, 1)}


def test_layer_counts_equal_counting_each_layer(spark):
    rows = [*FIVE, message("x", crane=None), message("y", "Z", model=None), message("z", "Z", model=None)]
    landing = frame(spark, rows)
    silver = to_silver(to_bronze(landing))
    expected = {
        "bronze": landing.count(),
        "silver": silver.count(),
        "fact": to_fact(silver).count(),
        "dim": to_dim(silver).count(),
    }
    layers = {"bronze": landing, "silver": silver, "fact": to_fact(silver), "dim": to_dim(silver)}
    assert dict(marts.layer_counts(layers).collect()) == expected
    nothing = dict(marts.layer_counts({name: df.limit(0) for name, df in layers.items()}).collect())
    assert nothing == dict.fromkeys(expected, 0)


def test_average_of_small_values(spark):
    rows = [message("a", vibration=4e-7), message("b", vibration=2e-7)]
    hourly = marts.crane_hourly(to_fact(frame(spark, rows))).collect()
    assert [r.avg_vibration_mm_s for r in hourly] == [pytest.approx(3e-7)]


def test_latest_attributes(spark):
    rows = [
        message("m1", "A", "2030-05-02T08:00:00Z", model="NEW", region=None),
        message("m0", "A", "2030-05-02T08:00:00Z", model="TIE"),
        message("m9", "A", "2030-05-01T08:00:00Z", model="OLD"),
        message("n1", "B", "soon", model="UNDATED"),
    ]
    assert bag(to_dim_latest(frame(spark, rows))) == Counter([("A", "NEW", None), ("B", "UNDATED", "R1")])


@pytest.fixture
def star(spark):
    rows = [message("m1", "A"), message("m2", "A"), message("m3", "B", region="R2"), message("m4", "N", region=None)]
    silver = frame(spark, rows)
    grants = spark.createDataFrame(
        [("ann", "R1"), ("ann", "R1"), ("bob", "R1"), ("bob", "R2"), ("eve", None)],
        "user_name string, operational_region string",
    )
    return to_fact(silver), to_dim(silver), grants


@pytest.mark.parametrize(
    ("user", "expected"), [("ann", {"m1", "m2"}), ("bob", {"m1", "m2", "m3"}), ("eve", set()), ("mallory", set())]
)
def test_row_security(star, user, expected):
    fact, dim, grants = star
    seen = visible_facts(fact, dim, grants, user)
    assert sorted(r.message_id for r in seen.collect()) == sorted(expected)
    assert seen.columns == fact.columns or set(seen.columns) == set(fact.columns)
    assert visible_cranes(dim, grants, user).count() == len({m for m in expected if m != "m2"})


def test_row_security_defaults_to_the_session_user(spark, star):
    fact, dim, grants = star
    me = spark.range(1).select(F.current_user().alias("user_name"), F.lit("R2").alias("operational_region"))
    assert [r.message_id for r in visible_facts(fact, dim, grants.unionByName(me)).collect()] == ["m3"]
    assert granted_regions(grants).isEmpty()


def test_star_join_and_enrichment(spark, star):
    fact, dim, _ = star
    joined = star_join(fact, dim)
    assert bag(joined, "message_id", "operational_region") == Counter(
        [("m1", "R1"), ("m2", "R1"), ("m3", "R2"), ("m4", None)]
    )
    master = spark.createDataFrame([("A", "Ann's yard"), ("X", "unused")], "crane_id string, site string")
    assert dict(enrich_dim(dim, master).select("crane_id", "site").collect()) == {
        "A": "Ann's yard", "B": None, "N": None,
    }
