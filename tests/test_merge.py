"""Merge semantics, by example and against a plain Python model."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gantry.operators.merge import (
    AmbiguousMergeError,
    MergeSchemaError,
    ambiguous_keys,
    checked_merge,
    latest_per_key,
    merge_upsert,
    split_hot,
)
from gantry.sources.scratch import stored
from tests.helpers import bag


def frame(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def model(target, source):
    """What the merge must give, row by row."""
    by_key = {k: (k, v) for k, v in source if k is not None}
    present = {k for k, _ in target}
    out = [by_key.get(k, (k, v)) if k is not None else (k, v) for k, v in target]
    out += [(k, v) for k, v in source if k is None or k not in present]
    return Counter(out)


def test_null_and_duplicate_keys(spark):
    target = frame(spark, [("a", 1), ("b", 2), ("b", 3), (None, 4), ("z", 5)])
    source = frame(spark, [("b", 20), ("n", 30), ("n", 31), (None, 40)])
    expected = [("a", 1), ("b", 20), ("b", 20), ("n", 30), ("n", 31), ("z", 5), (None, 4), (None, 40)]
    assert bag(merge_upsert(target, source, "k")) == Counter(expected)
    assert bag(checked_merge(target, source, "k")[0]) == Counter(expected)


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(request, spark):
    """Both ways Spark may join, whatever the size of the rows."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        for name in names:
            spark.conf.set(name, "-1")
    yield request.param
    for name in names:
        spark.conf.unset(name)


def outer_merge(target, source, key):
    return merge_upsert(target, source, key, unique_keys=True)


def only_rows(target, source, key):
    return checked_merge(target, source, key)[0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_against_model(spark, join_kind, data):
    key = st.one_of(st.none(), st.sampled_from("abcdefgh"))
    value = st.one_of(st.none(), st.integers(0, 9))
    target = data.draw(st.lists(st.tuples(key, value), max_size=12))
    raw = data.draw(st.lists(st.tuples(key, value), max_size=12))
    present = {k for k, _ in target}
    # Repeats stay where they are allowed: without a key, or matching nothing.
    seen, source = set(), []
    for k, v in raw:
        if k is None or k not in present or k not in seen:
            source.append((k, v))
        seen.add(k)
    for merge in (merge_upsert, outer_merge, only_rows):
        merged = merge(frame(spark, target), frame(spark, source), "k")
        assert bag(merged) == model(target, source)


def test_rerun_changes_nothing(spark):
    target = frame(spark, [("a", 1), ("b", 2)])
    source = frame(spark, [("b", 3), ("c", 4)])
    once = merge_upsert(target, source, "k")
    assert bag(merge_upsert(once, source, "k")) == bag(once)


def test_disjoint_batches_in_any_order(spark):
    target = frame(spark, [("a", 1), ("b", 2)])
    one, two = frame(spark, [("a", 9), ("c", 4)]), frame(spark, [("b", 8), ("d", 5)])
    there = merge_upsert(merge_upsert(target, one, "k"), two, "k")
    back = merge_upsert(merge_upsert(target, two, "k"), one, "k")
    assert bag(there) == bag(back)


def test_source_null_overwrites(spark):
    merged = merge_upsert(frame(spark, [("a", 1)]), frame(spark, [("a", None)]), "k")
    assert bag(merged) == Counter([("a", None)])


def test_single_clauses(spark):
    target, source = frame(spark, [("a", 1), ("b", 2)]), frame(spark, [("b", 3), ("c", 4)])
    assert bag(merge_upsert(target, source, "k", insert=False)) == Counter([("a", 1), ("b", 3)])
    assert bag(merge_upsert(target, source, "k", update=False)) == Counter([("a", 1), ("b", 2), ("c", 4)])


def test_strict_schema(spark):
    target = frame(spark, [("a", 1)])
    with pytest.raises(MergeSchemaError, match="v"):
        merge_upsert(target, frame(spark, [("a",)], "k string"), "k")
    wider = frame(spark, [("x", "b", 7)], "more string, k string, v int")
    merged = merge_upsert(target, wider, "k")
    assert merged.columns == ["k", "v"]
    assert bag(merged) == Counter([("a", 1), ("b", 7)])


def test_source_takes_target_types(spark):
    merged = merge_upsert(frame(spark, [("a", 1.5)], "k string, v double"), frame(spark, [("b", 2)]), "k")
    assert dict(merged.dtypes)["v"] == "double"


@pytest.mark.parametrize(("update", "unique"), [(True, False), (True, True), (False, False)])
def test_evolving_schema(spark, join_kind, update, unique):
    target = frame(spark, [("a", 1, "t"), ("b", 2, "t"), (None, 3, "t")], "k string, v int, old string")
    source = frame(spark, [("b", None, "s"), ("c", 4, "s")], "k string, v int, new string")
    merged = merge_upsert(target, source, "k", schema_mode="evolve", update=update, unique_keys=unique)
    assert merged.columns == ["k", "v", "old", "new"]
    b = ("b", None, "t", "s") if update else ("b", 2, "t", None)
    expected = [("a", 1, "t", None), b, (None, 3, "t", None), ("c", 4, None, "s")]
    assert bag(merged) == Counter(expected)


def test_ambiguous_source_is_refused(spark):
    target = frame(spark, [("a", 1), ("b", 2)])
    source = frame(spark, [("b", 3), ("b", 4), ("n", 5), ("n", 6)])
    assert bag(ambiguous_keys(target, source, "k")) == Counter([("b", 2)])
    with pytest.raises(AmbiguousMergeError, match=r"b \(2 rows\)"):
        checked_merge(target, source, "k")


def test_hot_keys_take_the_short_way(spark):
    """A key with a third of the batch, a key with a third of the table."""
    target = frame(spark, [("old", i) for i in range(300)] + [(f"t{i}", i) for i in range(600)])
    source = frame(
        spark,
        [("new", i) for i in range(300)] + [(f"t{i}", -i) for i in range(300, 900)] + [("old", -1)],
    )
    rest, hot = split_hot(source, "k")
    assert bag(hot, "k") == Counter({("new",): 300})
    assert rest.count() == 601
    expected = (
        Counter([("old", -1)] * 300)
        + Counter((f"t{i}", i) for i in range(300))
        + Counter((f"t{i}", -i) for i in range(300, 900))
        + Counter(("new", i) for i in range(300))
    )
    merged, unique = checked_merge(target, source, "k", target_unique=False)
    assert bag(merged) == expected
    assert not unique


def test_unique_keys_and_large_batch_take_one_join(spark, join_kind):
    target, source = frame(spark, [("a", 1), ("b", 2)]), stored(frame(spark, [("b", 3), ("c", 4)]))
    merged, unique = checked_merge(target, source, "k", target_unique=True)
    assert unique
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert ("FullOuter" in text) == (join_kind == "shuffle")
    assert bag(merged) == Counter([("a", 1), ("b", 3), ("c", 4)])
    merged, unique = checked_merge(target, source, "k")
    assert not unique
    assert "FullOuter" not in merged._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "w"), (None, 1, "p"), (None, 1, "p")]
    latest = latest_per_key(frame(spark, rows, "k string, t int, id string"), "k", "t", "id")
    expected = [("a", 3, "z"), ("b", None, "w"), (None, 1, "p"), (None, 1, "p")]
    assert bag(latest) == Counter(expected)
