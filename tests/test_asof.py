"""As-of join against a plain search."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from gantry.operators.asof import as_of

START = datetime(2030, 1, 1)
FACTS, HISTORY = "message_id string, `crane.id` string, at timestamp", "`crane.id` string, since timestamp, owner string, no int"


def expected(facts, history):
    out = Counter()
    for message, crane, at in facts:
        valid = [h[1:] for h in history if h[0] is not None and h[1] is not None and at is not None and h[0] == crane and h[1] <= at]
        out[message, crane, at, *(max(valid) if valid else (None, None, None))] += 1
    return out


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_against_a_search(spark, unit):
    rng = random.Random(unit)
    cranes = ["A", "B", "C", None]
    when = lambda: rng.choice([None] + [START + timedelta(minutes=30 * rng.randrange(300)) for _ in range(20)])
    # a third of all facts are of one crane
    facts = [(str(i), "hot" if i % 3 == 0 else rng.choice(cranes), when()) for i in range(400)]
    history = [(rng.choice([*cranes, "hot"]), when(), rng.choice("xyz"), rng.randrange(9)) for _ in range(60)]
    left = spark.createDataFrame(facts, FACTS).repartition(3)
    right = spark.createDataFrame(history, HISTORY).repartition(2)
    joined = as_of(left, right, "crane.id", "at", "since", unit)
    assert joined.columns == ["message_id", "crane.id", "at", "since", "owner", "no"]
    assert Counter(map(tuple, joined.collect())) == expected(facts, history)


def test_empty_sides(spark):
    facts, history = spark.createDataFrame([("1", "A", START)], FACTS), spark.createDataFrame([], HISTORY)
    assert [tuple(r) for r in as_of(facts, history, "crane.id", "at", "since").collect()] == [("1", "A", START, None, None, None)]
    assert as_of(facts.limit(0), history, "crane.id", "at", "since").collect() == []


def test_shared_names_are_refused(spark):
    facts = spark.createDataFrame([], "k string, at timestamp, Owner string")
    with pytest.raises(ValueError, match="owner"):
        as_of(facts, spark.createDataFrame([], "k string, since timestamp, owner string"), "k", "at", "since")
