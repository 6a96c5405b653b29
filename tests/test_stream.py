from __future__ import annotations

import shutil
from collections import Counter

from gantry.sources.tables import read_table
from gantry.streaming.ingest import merge_appended, stream_ingest
from tests.helpers import bag, land, message


def run(spark, landing, tmp_path):
    query = stream_ingest(spark, landing, str(tmp_path / "appended"), str(tmp_path / "checkpoint"), 1)
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "appended"))


def test_every_file_is_taken_once(spark, tmp_path):
    landing = land(tmp_path / "in", [message("m1"), message("m2")], ["{bad json"], name="a.json")
    assert run(spark, landing, tmp_path).count() == 3
    assert run(spark, landing, tmp_path).count() == 3
    land(tmp_path / "in", [message("m2", load=7.0)], name="b.json")
    appended = run(spark, landing, tmp_path)
    assert bag(appended, "message_id") == Counter({("m1",): 1, ("m2",): 2, (None,): 1})
    assert appended.filter("_corrupt_record = '{bad json'").count() == 1



def merge(spark, tmp_path, checkpoint="merged"):
    args = (str(tmp_path / "appended"), str(tmp_path / "table"), str(tmp_path / checkpoint))
    merge_appended(spark, *args).awaitTermination()
    rows = read_table(spark, str(tmp_path / "table")).collect()
    return Counter((r.message_id, r.hoist_load_kg) for r in rows)


def test_appended_rows_are_merged_once(spark, tmp_path):
    rows = [message("m1"), message("m2"), message("m2", when="2030-05-01T09:00:00Z", load=5.0)]
    landing = land(tmp_path / "in", rows, ["{bad json"], name="a.json")
    run(spark, landing, tmp_path)
    expected = Counter([("m1", 100.0), ("m2", 5.0), (None, None)])
    assert merge(spark, tmp_path) == expected
    assert merge(spark, tmp_path) == expected

    land(tmp_path / "in", [message("m1", load=7.0), message("m3")], ["{bad json"], name="b.json")
    run(spark, landing, tmp_path)
    expected = Counter({("m1", 7.0): 1, ("m2", 5.0): 1, ("m3", 100.0): 1, (None, None): 2})
    assert merge(spark, tmp_path) == expected


def test_replayed_batch_is_not_merged_again(spark, tmp_path):
    """The batch was merged, but the crash came before the stream noted it."""
    run(spark, land(tmp_path / "in", [message("m1")], ["{bad json"]), tmp_path)
    before = merge(spark, tmp_path)
    for note in (tmp_path / "merged" / "commits").glob("*0*"):
        note.unlink()
    assert merge(spark, tmp_path) == before


def test_new_checkpoint_at_an_old_path(spark, tmp_path):
    """Its batches count from 0 again but are not those merged before."""
    landing = land(tmp_path / "in", [message("m1")], name="a.json")
    run(spark, landing, tmp_path)
    assert merge(spark, tmp_path) == Counter([("m1", 100.0)])
    shutil.rmtree(tmp_path / "merged")
    land(tmp_path / "in", [message("m2")], name="b.json")
    run(spark, landing, tmp_path)
    assert merge(spark, tmp_path) == Counter([("m1", 100.0), ("m2", 100.0)])


def test_rows_without_id_survive_a_replay_once(spark, tmp_path):
    """The same bad line twice in a file and again in a later one: three rows, however often merged."""
    landing = land(tmp_path / "in", [message("m1")], ["{bad json", "{bad json"], name="a.json")
    run(spark, landing, tmp_path)
    merge(spark, tmp_path)
    land(tmp_path / "in", [message("m2")], ["{bad json"], name="b.json")
    run(spark, landing, tmp_path)
    expected = Counter({("m1", 100.0): 1, ("m2", 100.0): 1, (None, None): 3})
    assert merge(spark, tmp_path) == expected
    shutil.rmtree(tmp_path / "merged")  # everything is taken once more
    assert merge(spark, tmp_path) == expected
