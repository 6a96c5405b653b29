"""That operators use all of their input, at sizes where a part would do for other tests."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd

from gantry.llm import lm, ngram_join, toxicity

from .cases import prose
from .test_brute_force import small_model


def test_language_model_learns_from_all_training_documents(spark, monkeypatch):
    docs = [(i, prose(1 + i % 70)) for i in range(60)]
    seen = {}

    def trained(windows, n_shards, model):
        seen["windows"] = [np.frombuffer(r.ids, lm._id_type(model)).tolist() for r in windows.collect()]
        return model

    monkeypatch.setattr(lm, "_trained", trained)
    lm.language_scores(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    encode, end = lm.encoder(lm.VOCABULARY).encode_ordinary, lm.Subwords(lm.VOCABULARY).end
    texts = [[*encode(" " + t), end] for i, t in docs if zlib.crc32(str(i).encode()) % 10]
    assert Counter(i for w in seen["windows"] for i in w[1:]) == Counter(i for t in texts for i in t)
    starts = [w for w in seen["windows"] if w[0] == end]
    assert Counter(tuple(w[1:]) for w in starts) == Counter(tuple(t[: lm.WINDOW]) for t in texts)


def test_shards_take_all_windows():
    model = small_model()
    end = len(model.row) - 1
    windows = [np.array([end if i % 2 else 7, *range(10 + i, 10 + i + n)], np.uint16) for i, n in enumerate((1, 5, lm.WINDOW))]
    rows, targets = lm._rows_and_targets([w.tobytes() for w in windows], model)
    for w, of_rows, of_targets in zip(windows, rows, targets):
        n = len(w) - 1
        assert of_rows[:n].tolist() == [0 if w[0] == end else model.row[w[0]], *model.row[w[1:-1]]]
        assert of_targets.tolist() == [*model.of_class[w[1:]], *[-1] * (lm.WINDOW - n)]
    frames = iter([pd.DataFrame({"ids": [w.tobytes()]}) for w in windows])
    (result,) = lm._train_shards(SimpleNamespace(value=model))(frames)
    want = lm.train_shard(model.weights, model.after, rows, targets)
    got = np.frombuffer(result["sums"][0]) / 3
    assert result["n"][0] == 3
    np.testing.assert_allclose(got, np.concatenate([v.ravel() for v in want.values()]), atol=1e-5)


def test_toxicity_prior_does_not_depend_on_the_sample(spark):
    rng = random.Random(8)
    docs = [(i, f"{prose(15, rng)} {'vile grot ' * (i % 10 == 0)}{prose(15, rng)}") for i in range(600)]
    docs.append((1000, None))
    found = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(600)], "doc_id long, toxic int")
    used = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 != 2]
    share = sum(i % 10 == 0 for i in used) / len(used)
    result = toxicity.toxicity_scores(spark.createDataFrame(docs, "doc_id long, text string"), found, sample=40).collect()
    (empty,) = [r for r in result if r.doc_id == 1000]
    assert abs(empty.score - share) < 1e-9
    assert empty.predicted == 0


def test_toxicity_calibration_follows_the_share():
    rng = random.Random(9)
    texts = [f"{prose(20, rng)} {'vile grot' * (i % 2)}".encode() for i in range(80)]
    toxic = np.arange(80) % 2
    same, rare = toxicity.train(texts, toxic), toxicity.train(texts, toxic, share=0.1)
    assert (same.prior, rare.prior) == (0.5, 0.1)
    assert abs(same.shift - rare.shift - np.log(9)) < 1e-6


def test_links_are_lost_with_a_negligible_probability():
    """Of sets of similarity 0.75 that drop hot keys, at the share of hot shingles where that begins."""
    assert (0.25 + 1 - ngram_join.COLD_SHARE) ** ngram_join.KEYS < 1e-10
    assert 0.25**ngram_join.KEYS < 1e-23
