"""Scores of test items do not depend on which items share a block."""

from __future__ import annotations

import random

from gantry.llm import decontaminate

from .cases import prose


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    rng = random.Random(11)
    items = [(i, f"the of and {prose(rng.randint(8, 90), rng)} in a to") for i in range(12)]
    docs = []
    for i, text in items:
        words = text.split()
        docs.append((i, f"{prose(40, rng)} {' '.join(words[3:-3])} {prose(40, rng)}"))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    found = []
    for size in (4096, 1, 5):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", size)
        rows = decontaminate.contamination_report(docs, items, answer_overlap=0.2).collect()
        found.append(sorted((r.doc_id, r.item_id, round(r.score, 5)) for r in rows))
    assert found[0]
    assert found[0] == found[1] == found[2]


def test_block_bounds_are_those_of_their_entries():
    rng = random.Random(12)
    index = decontaminate.Index([(prose(rng.randint(5, 60), rng).encode(), None) for _ in range(50)])
    for t in range(len(index.terms)):
        want: dict[int, float] = {}
        for k in range(index.starts[t], index.starts[t + 1]):
            block = index.parts[k] // decontaminate.BOUND_PARTS
            want[block] = max(want.get(block, 0.0), index.weights[k])
        assert index.block_bounds[t] == want
        assert index.list_bounds[t] == max(want.values())
