"""Bucketed tables: merges that leave the table where it is."""

from __future__ import annotations

import re
import uuid
from collections import Counter

import pytest

from gantry.operators.contract import ContractViolation
from gantry.operators.merge import AmbiguousMergeError
from gantry.sources.bucketed import bucket_count, create_bucketed, merged_bucketed, upsert_bucketed
from tests.helpers import bag


@pytest.fixture
def name(spark):
    wanted = f"t_{uuid.uuid4().hex}"
    yield wanted
    spark.sql(f"DROP TABLE IF EXISTS {wanted}")


def frame(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def shuffled_scans(plan: str) -> list[int]:
    """For every scan of the tree, the number of exchanges above it."""
    above, found = [], []
    for line in plan.splitlines():
        depth = len(re.match(r"[\s:]*(?:[+:]- )?", line).group())
        while above and above[-1][0] >= depth:
            above.pop()
        above.append((depth, "Exchange" in line))
        if "FileScan" in line and "Bucketed: true" in line:
            found.append(sum(e for _, e in above))
    return found


@pytest.mark.parametrize("unique", [True, False])
def test_no_exchange_above_the_table(spark, tmp_path, name, unique):
    create_bucketed(frame(spark, [(str(i), i) for i in range(500)]), name, str(tmp_path), "k", 16)
    batch = frame(spark, [(str(i), -i) for i in range(400, 900)])
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        merged = merged_bucketed(spark, name, batch, "k", unique=unique)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scans = shuffled_scans(plan)
    assert plan.count("Exchange hashpartitioning(k") - plan.count("ReusedExchange") == 1  # the batch, once
    assert scans and not any(scans)
    assert bag(merged) == Counter([(str(i), i) for i in range(400)] + [(str(i), -i) for i in range(400, 900)])


def test_create_merge_and_merge_again(spark, tmp_path, name):
    path = str(tmp_path)
    upsert_bucketed(frame(spark, [("a", 1), ("b", 2), ("b", 3), (None, 4)]), name, path, "k", 4)
    assert bucket_count(spark, name) == 4
    upsert_bucketed(frame(spark, [("b", 20), ("c", 30), ("c", 31), (None, 40)]), name, path, "k", 9)
    assert bucket_count(spark, name) == 4
    assert bag(spark.table(name)) == Counter([("a", 1), ("b", 20), ("b", 20), ("c", 30), ("c", 31), (None, 4), (None, 40)])
    with pytest.raises(AmbiguousMergeError):
        upsert_bucketed(frame(spark, [("a", 5), ("a", 6)]), name, path, "k", 4)
    assert spark.table(name).count() == 7


def test_new_columns(spark, tmp_path, name):
    upsert_bucketed(frame(spark, [("a", 1), ("b", 2)]), name, str(tmp_path), "k", 4)
    upsert_bucketed(frame(spark, [("b", "x"), ("c", "y")], "k string, w string"), name, str(tmp_path), "k", 4, "evolve")
    assert bag(spark.table(name), "k", "v", "w") == Counter([("a", 1, None), ("b", 2, "x"), ("c", None, "y")])


def test_refused_rows_change_nothing(spark, tmp_path, name):
    def refuse():
        raise ContractViolation([])

    with pytest.raises(ContractViolation):
        upsert_bucketed(frame(spark, [("a", 1)]), name, str(tmp_path), "k", 4, accept=refuse)
    assert not spark.catalog.tableExists(name)
    upsert_bucketed(frame(spark, [("a", 1)]), name, str(tmp_path), "k", 4)
    with pytest.raises(ContractViolation):
        upsert_bucketed(frame(spark, [("a", 9)]), name, str(tmp_path), "k", 4, accept=refuse)
    assert bag(spark.table(name)) == Counter([("a", 1)])
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]
    assert left == [name]
