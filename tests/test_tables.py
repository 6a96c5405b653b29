from __future__ import annotations

import shutil
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gantry.operators.merge import AmbiguousMergeError, MergeSchemaError
from gantry.sources.files import read_text, write_text_once
from gantry.sources.tables import latest_snapshot, publish, read_changes, read_table, table_exists, upsert
from tests.helpers import bag

def day():
    return F.to_date("t")


def frame(spark, rows, schema="k string, t string, v int"):
    return spark.createDataFrame(rows, schema)


def days(spark, path):
    """The folders of the newest version, by day."""
    return {f.split("_event_date=")[1]: f for f in latest_snapshot(spark, path).folders}


def test_missing_table(spark, tmp_path):
    assert not table_exists(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_create_keeps_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", "2030-01-01", 1), ("a", "2030-01-01", 2), (None, None, 3)]
    upsert(frame(spark, rows), path, "k", day())
    assert table_exists(spark, path)
    assert bag(read_table(spark, path)) == Counter(rows)
    assert read_table(spark, path).columns == ["k", "t", "v"]


def test_only_touched_days_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1), ("b", "2030-01-02", 2), ("c", "2030-01-03", 3)]), path, "k", day())
    before = days(spark, path)
    upsert(frame(spark, [("b", "2030-01-02", 20), ("d", "2030-01-04", 4)]), path, "k", day())
    after = days(spark, path)
    assert after["2030-01-01"] == before["2030-01-01"]
    assert after["2030-01-03"] == before["2030-01-03"]
    assert after["2030-01-02"] != before["2030-01-02"]
    expected = [("a", "2030-01-01", 1), ("b", "2030-01-02", 20), ("c", "2030-01-03", 3), ("d", "2030-01-04", 4)]
    assert bag(read_table(spark, path)) == Counter(expected)


def test_row_moves_to_another_day(spark, tmp_path):
    """A corrected timestamp leaves nothing behind on the old day, even an only row."""
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1), ("b", "2030-01-02", 2), ("c", "2030-01-02", 3)]), path, "k", day())
    upsert(frame(spark, [("a", "2030-01-05", 10), ("b", None, 20)]), path, "k", day())
    expected = [("a", "2030-01-05", 10), ("b", None, 20), ("c", "2030-01-02", 3)]
    assert bag(read_table(spark, path)) == Counter(expected)
    assert set(days(spark, path)) == {"2030-01-05", "2030-01-02", "__HIVE_DEFAULT_PARTITION__"}
    upsert(frame(spark, [("b", "2030-01-02", 21)]), path, "k", day())
    assert set(days(spark, path)) == {"2030-01-05", "2030-01-02"}


def test_null_keys_are_added_on_every_run(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = frame(spark, [("a", "2030-01-01", 1), (None, None, 2)])
    for _ in range(2):
        upsert(batch, path, "k", day())
    assert bag(read_table(spark, path)) == Counter([("a", "2030-01-01", 1), (None, None, 2), (None, None, 2)])


def test_refused_merge_publishes_nothing(spark, tmp_path):
    for split in (None, day()):
        path = str(tmp_path / f"t{split is None}")
        upsert(frame(spark, [("a", "2030-01-01", 1)]), path, "k", split)
        before = latest_snapshot(spark, path)
        # The two source rows name different days than the target row.
        batch = frame(spark, [("a", "2030-01-02", 2), ("a", "2030-01-03", 3)])
        with pytest.raises(AmbiguousMergeError):
            upsert(batch, path, "k", split)
        assert latest_snapshot(spark, path) == before


def test_table_may_feed_its_own_next_version(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(frame(spark, [("a", "2030-01-01", 1)]), path)
    publish(read_table(spark, path).withColumn("v", F.col("v") + 1), path)
    assert bag(read_table(spark, path)) == Counter([("a", "2030-01-01", 2)])


def test_unfinished_write_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1)]), path, "k", day())
    stray = Path(path) / "_snapshot=2" / "_event_date=2030-01-01"
    stray.mkdir(parents=True)
    (stray / "part-0.parquet").write_bytes(b"half a file")
    assert bag(read_table(spark, path)) == Counter([("a", "2030-01-01", 1)])
    upsert(frame(spark, [("a", "2030-01-01", 2)]), path, "k", day())
    assert bag(read_table(spark, path)) == Counter([("a", "2030-01-01", 2)])
    assert latest_snapshot(spark, path).number == 3


def test_version_file_is_never_replaced(spark, tmp_path):
    path = str(tmp_path / "1.json")
    write_text_once(spark, path, "first é")
    with pytest.raises(FileExistsError):
        write_text_once(spark, path, "second")
    assert read_text(spark, path) == "first é"
    assert [p.name for p in tmp_path.glob("*1.json*") if not p.name.endswith(".crc")] == ["1.json"]


def test_evolved_table_reads_old_days_with_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1), ("b", "2030-01-02", 2)]), path, "k", day())
    wider = frame(spark, [("b", "2030-01-02", 3, "x")], "k string, t string, v int, extra string")
    upsert(wider, path, "k", day(), schema_mode="evolve")
    assert bag(read_table(spark, path)) == Counter([("a", "2030-01-01", 1, None), ("b", "2030-01-02", 3, "x")])
    with pytest.raises(MergeSchemaError):
        upsert(frame(spark, [("c", "2030-01-02", 2)]), path, "k", day())


def test_changes_since(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1), ("b", "2030-01-02", 2)]), path, "k", day())
    first = latest_snapshot(spark, path).seen()
    assert read_changes(spark, path, first).isEmpty()
    upsert(frame(spark, [("c", "2030-01-02", 3)]), path, "k", day())
    assert bag(read_changes(spark, path, first), "k") == Counter([("b",), ("c",)])
    assert read_changes(spark, path, None).count() == 3
    assert read_changes(spark, path, [first[0], 99]).count() == 3


def test_changes_of_a_table_created_anew(spark, tmp_path):
    """Its versions are not those a reader remembers, though they have the same numbers."""
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1)]), path, "k", day())
    first = latest_snapshot(spark, path).seen()
    shutil.rmtree(path)
    upsert(frame(spark, [("x", "2030-01-01", 1), ("y", "2030-01-01", 2)]), path, "k", day())
    assert read_changes(spark, path, first).count() == 2


def test_values_are_not_cut(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark.createDataFrame([("a", 25000)], "k string, v long"), path, "k")
    with pytest.raises(MergeSchemaError, match="v: double does not fit bigint"):
        upsert(spark.createDataFrame([("b", 25000.9)], "k string, v double"), path, "k")
    path = str(tmp_path / "u")
    upsert(spark.createDataFrame([("a", 0.5)], "k string, v double"), path, "k")
    upsert(spark.createDataFrame([("b", 25000), ("c", None)], "k string, v long"), path, "k")
    assert bag(read_table(spark, path)) == Counter([("a", 0.5), ("b", 25000.0), ("c", None)])
    with pytest.raises(Exception, match="no double equals 9007199254740993"):
        upsert(spark.createDataFrame([("d", 2**53 + 1)], "k string, v long"), path, "k")


def test_split_must_stay_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1)]), path, "k", day())
    with pytest.raises(ValueError):
        upsert(frame(spark, [("a", "2030-01-01", 1)]), path, "k")


def test_filter_on_day_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, [("a", "2030-01-01", 1), ("b", "2030-01-02", 2)]), path, "k", day())
    one_day = read_table(spark, path, with_event_date=True).filter("_event_date = date'2030-01-02'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_event_date" in plan
    assert [r.k for r in one_day.collect()] == ["b"]


def test_known_unique_keys(spark, tmp_path):
    def known(path):
        return latest_snapshot(spark, path).unique_key

    path = str(tmp_path / "t")
    rows = [("a", "2030-01-01", 1), (None, None, 2), (None, None, 2)]
    upsert(frame(spark, rows), path, "k", day())
    assert known(path) == "k"
    upsert(frame(spark, [("a", "2030-01-02", 3), ("b", "2030-01-01", 4)]), path, "k", day())
    assert known(path) == "k"
    upsert(frame(spark, [("n", "2030-01-01", 5), ("n", "2030-01-02", 6)]), path, "k", day())
    assert known(path) is None
    upsert(frame(spark, [("n", "2030-01-03", 7)]), path, "k", day())
    assert known(path) is None
    expected = [("a", "2030-01-02", 3), ("b", "2030-01-01", 4), ("n", "2030-01-03", 7), ("n", "2030-01-03", 7)]
    assert bag(read_table(spark, path).filter("k is not null")) == Counter(expected)


def test_days_beyond_the_calendar(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", "0000-12-31", 1), ("b", "9999-12-31", 2), ("c", "+12030-01-01", 3), ("d", "-0044-03-15", 4)]
    upsert(frame(spark, rows), path, "k", day())
    upsert(frame(spark, [(k, t, v * 10) for k, t, v in rows]), path, "k", day())
    assert bag(read_table(spark, path)) == Counter((k, t, v * 10) for k, t, v in rows)


def test_odd_column_names(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, t string, `a.b` int, event_date string, snapshot string, `x``y` string"
    for value in (1, 2):
        upsert(frame(spark, [("a", "2030-01-01", value, "mine", "too", "z")], schema), path, "k", day())
    assert read_table(spark, path).collect()[0].asDict() == {
        "k": "a", "t": "2030-01-01", "a.b": 2, "event_date": "mine", "snapshot": "too", "x`y": "z",
    }


def test_rebalanced_writes(spark, tmp_path):
    """One file a day while days are small; a day too big for one task is split."""
    day_of = F.when(F.col("id") % 3 == 0, "2030-01-01").otherwise(F.concat(F.lit("2030-02-0"), F.col("id") % 9 + 1))
    rows = spark.range(60_000).select(F.col("id").cast("string").alias("k"), day_of.alias("t"), F.col("id").alias("v"))

    def files(path):
        upsert(rows, path, "k", day())
        assert read_table(spark, path).count() == 60_000
        return {d: len(list((Path(path) / f).glob("part-*"))) for d, f in days(spark, path).items()}

    assert set(files(str(tmp_path / "small")).values()) == {1}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        assert files(str(tmp_path / "big"))["2030-01-01"] > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def read_days(monkeypatch):
    """The days whose keys a merge reads to find moved rows."""
    from gantry.sources import tables

    seen, scan = [], tables._scan

    def spy(spark, path, snapshot, folders):
        seen.append(sorted(f.split("_event_date=")[1] for f in folders))
        return scan(spark, path, snapshot, folders)

    monkeypatch.setattr(tables, "_scan", spy)
    return seen


def test_moves_within_bounds_what_is_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = [(f"k{d}", f"2030-01-{d:02}", d) for d in range(1, 29)] + [("u", None, 0)]
    upsert(frame(spark, rows), path, "k", day())
    seen = read_days(monkeypatch)
    # one row moves by two days, one gets a date, one is new
    batch = [("k10", "2030-01-12", 100), ("u", "2030-01-11", 101), ("n", "2030-01-11", 102)]
    upsert(frame(spark, batch), path, "k", day(), moves_within=2)
    searched = seen[0]
    assert searched == [f"2030-01-{d:02}" for d in (9, 10, 13, 14)] + ["__HIVE_DEFAULT_PARTITION__"]
    kept = [r for r in rows if r[0] not in ("k10", "u")]
    assert bag(read_table(spark, path)) == Counter(kept + batch)


def test_moves_within_finds_all_that_moved_less(spark, tmp_path):
    bounded, whole = str(tmp_path / "bounded"), str(tmp_path / "whole")
    rows = [(f"k{i}", f"2030-03-{1 + i % 28:02}", i) for i in range(80)]
    batch = [(f"k{i}", f"2030-03-{1 + (i + 2) % 28:02}" if i % 28 < 26 else f"2030-03-{1 + i % 28:02}", -i) for i in range(0, 80, 3)]
    for path, bound in ((bounded, 2), (whole, None)):
        upsert(frame(spark, rows), path, "k", day())
        upsert(frame(spark, batch), path, "k", day(), moves_within=bound)
    assert bag(read_table(spark, bounded)) == bag(read_table(spark, whole))
    assert read_table(spark, bounded).count() == 80
