"""How many rows Python workers are sent at a time, and that tiles may be cut anywhere by that."""

import numpy as np
import pandas as pd

from gantry.llm import ngram_join
from gantry.llm.common import BATCH_ROWS, WordHashes, small_batches

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _lengths(batches):
    for frame in batches:
        yield pd.DataFrame({"rows": [len(frame)]})


def test_small_batches(spark):
    def longest() -> int:
        rows = spark.range(3 * BATCH_ROWS, numPartitions=1).mapInPandas(_lengths, "rows int")
        return max(r["rows"] for r in rows.collect())

    before = spark.conf.get(SETTING)
    try:
        for setting, most in (("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("7", 7)):
            spark.conf.set(SETTING, setting)
            with small_batches(spark):
                assert longest() == most
            assert spark.conf.get(SETTING) == setting
    finally:
        spark.conf.set(SETTING, before)


def test_near_duplicates_send_few_rows_at_a_time(spark, monkeypatch):
    """Batches of 10,000 whole texts or hash arrays took 700 MB of an executor."""
    sizes, staged = [], ngram_join.staged

    def watched(df, *rest):
        sizes.append(int(spark.conf.get(SETTING)))
        return staged(df, *rest)

    monkeypatch.setattr(ngram_join, "staged", watched)
    before = spark.conf.get(SETTING)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, "g h i j k l")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert sizes and all(0 < n <= BATCH_ROWS for n in sizes)
    assert spark.conf.get(SETTING) == before


def _rows(seed: int = 3) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    rows = []
    for key in range(12):
        base = [f"w{key}-{i}" for i in range(60)]
        for copy in range(int(rng.integers(1, 9))):
            words = [*base, *(f"x{key}-{copy}-{i}" for i in range(int(rng.integers(0, 20))))]
            (hashes,) = ngram_join.shingle_sets([" ".join(words).encode()], WordHashes())
            node = ngram_join._node(hashes)
            rows.append((f"{key}:0", len(hashes), node, node, ngram_join.bitmap(hashes), False, np.array([key])))
    frame = pd.DataFrame(rows, columns=["tile", "n", "node", "component", "bits", "visits", "used"])
    return frame.sort_values(["tile", "n", "node"], ignore_index=True)


def test_tiles_cut_anywhere():
    rows = _rows()
    for star, few in ((True, False), (False, True), (False, False)):
        run = ngram_join._tiles(star, few)

        def pairs(size: int) -> set:
            batches = [rows.iloc[i : i + size].reset_index(drop=True) for i in range(0, len(rows), size)]
            return {tuple(r) for frame in run(iter([*batches, rows.iloc[:0]])) for r in frame.itertuples(index=False)}

        whole = pairs(len(rows))
        assert whole
        for size in (1, 2, 3, 5, 7):
            assert pairs(size) == whole
