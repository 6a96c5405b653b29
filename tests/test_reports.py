"""Episodes, cube, calendar, hierarchical grants, and the contract checked on the way."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gantry.operators.contract import ContractViolation, Watch, contract_report
from gantry.operators.merge import MergeSchemaError, merge_upsert
from gantry.operators.star import calendar, on_days, reachable, visible_cranes
from gantry.plans import marts
from gantry.plans.medallion import cleanse_silver
from gantry.plans.stages import to_bronze, to_dim_history, to_fact
from gantry.schema import TELEMETRY
from gantry.sources.scratch import stored
from gantry.sources.tables import publish, read_table, table_exists, upsert
from tests.helpers import FIVE, bag, message

START = datetime(2030, 5, 1)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], TELEMETRY)


# ---- episodes


def episodes(times, gap):
    found = []
    for t in sorted(times):
        if found and t - found[-1][1] <= gap:
            found[-1][1:] = [t, found[-1][2] + 1]
        else:
            found.append([t, t, 1])
    return Counter(map(tuple, found))


@pytest.mark.parametrize("unit", ["hour", "day", "month"])
def test_episodes(spark, unit):
    """Also where a gap is exactly as long as allowed, and at the ends of slices."""
    rng = random.Random(3)
    times = {c: [START + timedelta(hours=rng.randrange(24 * 20)) for _ in range(60)] for c in "AB"}
    rows = [message(f"{c}{i}", c, str(t), vibration=50.0) for c, ts in times.items() for i, t in enumerate(ts)]
    rows += [message("calm", "A", str(START), vibration=1.0), message("undated", "A", "soon", vibration=50.0)]
    gap = timedelta(hours=6)
    found = marts.alarm_episodes(to_fact(frame(spark, rows)), "6 hours", unit).collect()
    for crane in "AB":
        assert Counter((r.started, r.ended, r.readings) for r in found if r.crane_id == crane) == episodes(times[crane], gap)
    mtbf = {r.crane_id: r for r in marts.mtbf_by_episode(to_fact(frame(spark, rows)), "6 hours").collect()}
    assert mtbf["B"].episodes == len(episodes(times["B"], gap)) and mtbf["A"].readings == 62


def test_episodes_are_merged_within_slices_first(spark):
    plan = marts.alarm_episodes(to_fact(stored(frame(spark, FIVE))))._jdf.queryExecution().executedPlan().toString()
    deepest = plan.rindex("Exchange hashpartitioning")
    assert "slice" in plan[deepest : deepest + 80]


# ---- history


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_versions_of_a_crane(spark, unit):
    rows = [
        message("1", "A", "2030-05-01T08:00:00Z", model="X", region=None),
        message("2", "A", "2030-05-01T09:00:00Z", model="X", region=None),
        message("3", "A", "2030-05-02T08:00:00Z", model="X", region=None),  # the same on another day
        message("4", "A", "2030-05-02T09:00:00Z", model="Y", region=None),  # gone at once
        message("5", "A", "2030-05-02T09:00:00Z", model="X", region=None),
        message("6", "A", "2030-05-03T09:00:00Z", model="X", region="R"),
        message("7", "A", "2030-05-05T09:00:00Z", model="X", region=None),
        message("8", "B", "2030-05-05T09:00:00Z", model=None, region=None),
        message("9", "B", "soon", model="Z", region="Z"),
    ]
    found = to_dim_history(frame(spark, rows), unit)
    at = lambda d, h: datetime(2030, 5, d, h)
    assert Counter(map(tuple, found.collect())) == Counter(
        [
            ("A", "X", None, at(1, 8), at(3, 9)),
            ("A", "X", "R", at(3, 9), at(5, 9)),
            ("A", "X", None, at(5, 9), None),
            ("B", None, None, at(5, 9), None),
        ]
    )


# ---- cube, calendar


def test_cube_tells_sums_from_nulls(spark):
    fact = to_fact(frame(spark, [message("1", "A"), message("2", "A"), message("3", "B")]))
    dim = spark.createDataFrame([("A", "M", None), ("B", "M", "R")], "crane_id string, crane_model string, operational_region string")
    cube = marts.star_cube(fact, dim)
    found = {(r.operational_region, r.crane_model, r.crane_id, r.grouped_by): r.readings for r in cube.collect()}
    assert found[None, None, None, 7] == 3
    assert found[None, None, None, 3] == 2 and found["R", None, None, 3] == 1
    assert found[None, "M", "A", 0] == 2
    assert len(found) == 2 + 2 + 2 + 2 + 2 + 1 + 2 + 1


def test_cube_shuffles_once(spark):
    fact, dim = stored(to_fact(frame(spark, FIVE))), stored(spark.createDataFrame([("A", "M", "R")], "crane_id string, crane_model string, operational_region string"))
    plan = marts.star_cube(fact, dim)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1


def test_calendar_prunes_days(spark, tmp_path):
    rows = [(str(d), str(START + timedelta(days=d))) for d in range(14)]
    path = str(tmp_path / "t")
    upsert(spark.createDataFrame(rows, "k string, t string"), path, "k", F.to_date("t"))
    days = stored(calendar(spark, "2030-05-01", "2030-05-31")).where("iso_weekday >= 6")
    joined = on_days(read_table(spark, path, with_event_date=True), "_event_date", days)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert bag(joined, "k") == Counter([("3",), ("4",), ("10",), ("11",)])


# ---- grants


def test_reachable(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("a", "d"), ("x", "y"), (None, "a"), ("z", None), ("b", "a")]
    parents = spark.createDataFrame(edges, "child string, parent string")
    roots = lambda *names: spark.createDataFrame([(n,) for n in names], "operational_region string")
    assert bag(reachable(parents, roots("b"))) == Counter([("a",), ("b",), ("c",), ("d",)])
    assert bag(reachable(parents, roots("y", "y", None))) == Counter([("x",), ("y",)])
    assert reachable(parents, roots()).count() == 0
    dim = spark.createDataFrame([("1", "M", "d"), ("2", "M", "x"), ("3", "M", None)], "crane_id string, crane_model string, operational_region string")
    grants = spark.createDataFrame([("u", "c"), ("v", "x")], "user_name string, operational_region string")
    assert bag(visible_cranes(dim, grants, "u", parents), "crane_id") == Counter([("1",)])
    assert bag(visible_cranes(dim, grants, "u"), "crane_id") == Counter()
    assert bag(visible_cranes(dim, grants, "nobody", parents), "crane_id") == Counter()


# ---- contract


def test_watch_equals_report(spark):
    rows = frame(spark, [*FIVE, message("x", crane=None), message("y", when=None)])
    watch = Watch(rows, "report")
    stored(watch.rows)
    assert Counter(watch.report()) == bag(contract_report(rows))
    empty = Watch(rows.limit(0), "fail")
    stored(empty.rows)
    empty.accept()
    assert empty.findings() == []


def test_watch_refuses_types_without_a_job(spark):
    with pytest.raises(ContractViolation, match="crane_id: present"):
        Watch(frame(spark, FIVE).drop("crane_id"))


@pytest.mark.parametrize("second", [False, True])
def test_refused_batch_is_not_published(spark, tmp_path, second):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    if second:
        publish(to_bronze(frame(spark, FIVE)), bronze)
        cleanse_silver(spark, bronze, silver)
    publish(to_bronze(frame(spark, [*FIVE, message("m9", when=None)])), bronze)
    with pytest.raises(ContractViolation, match="timestamp: not_null .1."):
        cleanse_silver(spark, bronze, silver)
    assert table_exists(spark, silver) == second
    if second:
        assert read_table(spark, silver).count() == 3
    found = cleanse_silver(spark, bronze, silver, mode="report")
    assert [(v.column, v.check, v.failures) for v in found] == [("timestamp", "not_null", 1)]
    assert read_table(spark, silver).count() == 4


# ---- nested columns


def test_structs_merge_field_by_field(spark):
    target = spark.createDataFrame(
        [("a", (1, ("old", 5)), [(1,)]), ("b", (2, None), None), ("c", None, []), ("t", (4, ("kept", 8)), [(4,)])],
        "k string, s struct<x:int,n:struct<p:string,q:int>>, l array<struct<e:int>>",
    )
    source = spark.createDataFrame(
        [("a", (("new", True), 10), [(7, "f")]), ("b", None, None), ("c", ((None, False), 30), []), ("n", (("in", None), 40), None)],
        "k string, s struct<n:struct<p:string,r:boolean>,x:int>, l array<struct<e:int,f:string>>",
    )
    merged = merge_upsert(target, source, "k", schema_mode="evolve")
    assert merged.schema["s"].dataType.simpleString() == "struct<x:int,n:struct<p:string,q:int,r:boolean>>"
    assert {r.k: (r.s and (r.s.x, r.s.n and tuple(r.s.n)), r.l and [tuple(e) for e in r.l]) for r in merged.collect()} == {
        "a": ((10, ("new", 5, True)), [(7, "f")]),
        "b": (None, None),
        "c": ((30, (None, None, False)), []),
        "t": ((4, ("kept", 8, None)), [(4, None)]),
        "n": ((40, ("in", None, None)), None),
    }
    with pytest.raises(MergeSchemaError):
        merge_upsert(target, source, "k", schema_mode="strict")


def test_nested_types_must_fit(spark):
    target = spark.createDataFrame([], "k string, s struct<x:int>")
    with pytest.raises(MergeSchemaError, match="s.x"):
        merge_upsert(target, spark.createDataFrame([], "k string, s struct<x:string>"), "k", schema_mode="evolve")
    wider = merge_upsert(spark.createDataFrame([], "k string, s struct<x:bigint>"), target, "k", schema_mode="evolve")
    assert wider.schema["s"].dataType.simpleString() == "struct<x:bigint>"


def test_table_gains_a_nested_field(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark.createDataFrame([("a", (1,)), ("b", (2,))], "k string, s struct<x:int>"), path, "k")
    upsert(spark.createDataFrame([("b", (3, "y"))], "k string, s struct<x:int,z:string>"), path, "k", schema_mode="evolve")
    assert bag(read_table(spark, path).select("k", "s.x", "s.z")) == Counter([("a", 1, None), ("b", 3, "y")])
