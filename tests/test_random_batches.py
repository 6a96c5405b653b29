"""Runs of random batches against a plain Python model of the whole lake."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from gantry import LakePaths, read_table, run_pipeline
from tests.helpers import bag, land, message

COLUMNS = ["message_id", "crane_id", "timestamp", "hoist_load_kg"]


def random_batch(rng, size):
    """Unique ids, some without one, some invalid, some on another day than before."""
    ids = rng.sample([f"m{i}" for i in range(20)], size)
    rows = []
    for message_id in ids + [None]:
        crane = rng.choice("ABC")
        rows.append(
            message(
                message_id,
                crane,
                f"2030-05-0{rng.randint(1, 5)}T08:00:00Z",
                rng.choice([1.0, 2.0, 50000.0, 50001.0, None]),
                rng.choice([0.0, 1.0, 100.0, -1.0]),
                f"model {crane}",
                f"region {crane}",
            )
        )
    return rows


def merged(table, batch):
    """A table as a list of rows, after merging rows with unique ids."""
    fresh = {r["message_id"]: r for r in batch if r["message_id"]}
    old = {r["message_id"] for r in table if r["message_id"]}
    out = [fresh.get(r["message_id"], r) for r in table]
    return out + [r for r in batch if not r["message_id"] or r["message_id"] not in old]


def valid(row):
    load, vibration = row["hoist_load_kg"], row["vibration_mm_s"]
    return row["message_id"] is not None and load is not None and 0 <= load <= 50000 and 0 <= vibration <= 100


@pytest.mark.parametrize(("seed", "incremental"), [(1, True), (1, False), (2, True)])
def test_lake_equals_model(spark, tmp_path, seed, incremental):
    rng = random.Random(seed)
    paths = LakePaths(str(tmp_path / "lake"))
    bronze, silver = [], []
    for n in range(4):
        batch = random_batch(rng, rng.randint(3, 10))
        run_pipeline(spark, land(tmp_path / f"in{n}", batch), paths, incremental=incremental)
        bronze = merged(bronze, batch)
        silver = merged(silver, [r for r in bronze if valid(r)])
        for path, rows in ((paths.bronze, bronze), (paths.silver, silver)):
            expected = Counter(tuple(r[c] for c in COLUMNS) for r in rows)
            assert bag(read_table(spark, path), *COLUMNS) == expected
        expected = Counter((r["message_id"], r["timestamp"][:10]) for r in silver)
        fact = read_table(spark, paths.fact).selectExpr("message_id", "cast(to_date(event_time) as string) d")
        assert bag(fact) == expected
        # The dimension never forgets a crane, even if its only reading moved on.
        assert {r["crane_id"] for r in silver} <= {r.crane_id for r in read_table(spark, paths.dim).collect()}
