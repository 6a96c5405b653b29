"""Independent lakes of one query are built at the same time."""

from __future__ import annotations

import datetime
import threading

import pytest

from gantry import catalog


def _events(spark, path) -> str:
    first = datetime.datetime(2024, 1, 5)
    rows = [
        (i, first + datetime.timedelta(hours=7 * i), i % 5, "view", float(i), '{"k": %d}' % (i % 40)) for i in range(80)
    ]
    rows += [(80, None, 1, "view", 3.0, '{"k": 2}')]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, kinds).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_two_batches_build_both_lakes_at_once(spark, tmp_path, monkeypatch):
    data = _events(spark, tmp_path / "in")
    both, run = threading.Barrier(2), catalog.run_pipeline

    def met(*args, **options):
        both.wait(60)  # broken if one lake waits for the other
        return run(*args, **options)

    monkeypatch.setattr(catalog, "run_pipeline", met)
    rows = [tuple(r) for r in catalog.medallion_two_batches(spark, data).collect()]
    incremental = sorted(r[:-1] for r in rows if r[-1])
    assert len(incremental) > 50 and len({r[0] for r in incremental}) == len(incremental)
    assert incremental == sorted(r[:-1] for r in rows if not r[-1])


def test_side_by_side_keeps_order_and_errors(spark):
    jobs = [lambda n=n: spark.range(n) for n in (3, 1, 2)]
    assert [df.count() for df in catalog._side_by_side(spark, *jobs)] == [3, 1, 2]

    def fails():
        raise ValueError("no lake")

    with pytest.raises(ValueError, match="no lake"):
        catalog._side_by_side(spark, jobs[0], fails)
