"""Streams with watermark: each message once, hours as they close."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest

from gantry.streaming.timed import stream_counts, stream_distinct, stream_hourly
from tests.helpers import bag, land, message


def at(day, hour=8, minute=0):
    return f"2030-05-{day:02}T{hour:02}:{minute:02}:00Z"


def run(spark, stream, tmp_path, delay="2 days"):
    query = stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), delay)
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out")), stream_counts(query)


def test_repeats_across_runs(spark, tmp_path):
    rows = [message("m1", when=at(10)), message("m1", when=at(10)), message("m2", when=at(11)), message(None, when=at(11))]
    land(tmp_path / "in", rows, ["{bad json", "{bad json"], name="a.json")
    found, counts = run(spark, stream_distinct, tmp_path)
    assert bag(found, "message_id") == Counter({("m1",): 1, ("m2",): 1, (None,): 3})
    assert (counts.rows, counts.late, counts.repeated) == (6, 0, 1)
    assert counts.watermark == "2030-05-09T08:00:00.000Z"

    # a restarted query knows what it has seen; nothing new changes nothing
    found, _ = run(spark, stream_distinct, tmp_path)
    assert found.count() == 5
    later = [message("m1", when=at(10)), message("m2", when=at(11), load=9.0), message("m3", when=at(9, 9)), message("old", when=at(9, 7))]
    land(tmp_path / "in", [*later, message("undated", when="soon"), message("undated", when="soon")], name="b.json")
    found, counts = run(spark, stream_distinct, tmp_path)
    expected = {("m1",): 1, ("m2",): 1, ("m3",): 1, ("undated",): 2, (None,): 3}
    assert bag(found, "message_id") == Counter(expected)
    assert bag(found.filter("message_id = 'm2'"), "hoist_load_kg") == Counter([(100.0,)])
    assert (counts.rows, counts.late, counts.repeated) == (6, 1, 2)


def test_state_is_dropped_behind_the_watermark(spark, tmp_path):
    land(tmp_path / "in", [message(f"m{i}", when=at(1)) for i in range(50)], name="a.json")
    _, counts = run(spark, stream_distinct, tmp_path)
    assert counts.in_state == 50
    land(tmp_path / "in", [message("z", when=at(20))], name="b.json")
    _, counts = run(spark, stream_distinct, tmp_path)
    assert counts.in_state == 1


def test_hours_close_behind_the_watermark(spark, tmp_path):
    land(tmp_path / "in", [message("a", when=at(10, 8, 5)), message("b", when=at(10, 8, 50), vibration=50.0)], name="a.json")
    found, _ = run(spark, stream_hourly, tmp_path, "3 hours")
    assert found.count() == 0  # still open
    # out of order but in time; the second of another crane; and one that closes the hours up to ten
    land(tmp_path / "in", [message("c", when=at(10, 8, 20), load=900.0), message("d", "B", at(10, 6, 0)), message("e", when=at(10, 13))], name="b.json")
    found, _ = run(spark, stream_hourly, tmp_path, "3 hours")
    rows = {(r.crane_id, r.hour_start): (r.readings, r.max_load_kg, r.anomalies) for r in found.collect()}
    assert rows == {("A", datetime(2030, 5, 10, 8)): (3, 900.0, 1), ("B", datetime(2030, 5, 10, 6)): (1, 100.0, 0)}
    land(tmp_path / "in", [message("late", when=at(10, 8, 30)), message("f", when=at(10, 10, 30))], name="c.json")
    found, counts = run(spark, stream_hourly, tmp_path, "3 hours")
    assert found.count() == 2 and counts.late == 1  # the hour from ten is open still


def test_continuous_query(spark, tmp_path):
    land(tmp_path / "in", [message("m1"), message("m1")], name="a.json")
    args = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), "1 day")
    query = stream_distinct(spark, *args, every="200 milliseconds")
    try:
        query.processAllAvailable()
        land(tmp_path / "in", [message("m1"), message("m2")], name="b.json")
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert bag(spark.read.parquet(args[1]), "message_id") == Counter([("m1",), ("m2",)])


def test_counts_are_refused_when_progress_is_lost(spark, tmp_path, monkeypatch):
    class Long:
        recentProgress = [None] * 100

    with pytest.raises(ValueError, match="last 100"):
        stream_counts(Long())
