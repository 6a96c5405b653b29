"""Cases that once went wrong: odd white space, long lists of keys, ties, names, unknown licences."""

from __future__ import annotations

import random
import textwrap
import time
from collections import Counter

import duckdb
import numpy as np
import pytest

from gantry.llm import chat, licenses, lm, quality, secrets, suffix_dedup
from gantry.llm.common import lowest_by_hash
from gantry.llm.queries import ORACLES

from .cases import prose

# ---- language model

SPACES = [" ", "\u0085", " ", "　", " ", "\x1c", "\x1f"]


def test_words_of_other_white_space():
    encode = lm.encoder(lm.VOCABULARY).encode_ordinary
    rng = random.Random(2)
    pieces = [*SPACES, "a", "the", "'s", "12", "$", "漢", "é", "  ", "x ", "　y"]
    for _ in range(2000):
        words = ["".join(rng.choices(pieces, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 8))]
        ids, edges = lm.encoded_words(lm.VOCABULARY, [w.encode() for w in words])
        assert len(edges) == len(words) + 1
        if any(c in w for w in words for c in SPACES):
            assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [encode(" " + w) for w in words]


def test_scores_of_other_white_space(spark):
    texts = ["a      "] * 8 + [" ".join(p) for p in (SPACES, SPACES[::-1])] + [prose(9) for _ in range(28)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in lm.language_scores(df).collect()}
    assert len(found) == len(texts)
    assert found[0].n_tokens == 4 and found[8].n_tokens == len(SPACES) + 1
    assert all(r.score < 0 and np.isfinite(r.score) for r in found.values())


# ---- secrets


def test_many_keys_take_time_in_proportion():
    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    text = "\n".join(f"token={''.join(rng.choices(alphabet, k=30))} {''.join(rng.choices(alphabet, k=30))}" for _ in range(6000))
    encode = secrets.encoder(secrets.VOCABULARY).encode_ordinary
    secrets.scan(text[:1000], encode, secrets.MAX_CHARS_PER_TOKEN)
    # the comparison with spans found, without the encoding
    begin = time.perf_counter()
    base, spans = secrets.scan(text, lambda s: list(s), secrets.MAX_CHARS_PER_TOKEN)
    assert time.perf_counter() - begin < 2
    assert len(base) == 6000 and len(spans) == 12000


def test_random_parts_avoid_overlapping_spans():
    spans = [(0, "assign", 10), (4, "hex", 6), (20, "hex", 30), (25, "assign", 40)]
    assert secrets._merged(spans) == ([0, 20], [10, 40])


# ---- quality


def test_what_only_the_method_rejects(spark):
    rng = random.Random(8)
    filler = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    said_over = " ".join(w for w in filler(12) for _ in range(4))  # no window of five words twice
    passage = filler(31)
    long_passage = " ".join([*filler(300), *passage, *filler(300), *passage, *filler(300)])
    short_passage = " ".join([*filler(300), *passage[:30], *filler(300), *passage[:30], *filler(300)])
    clean = " ".join(filler(500))
    texts = [said_over, long_passage, short_passage, clean]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in quality.quality_report(df).collect()}
    assert not any(r.base_failed for r in found.values())
    assert [found[i].kept for i in range(4)] == [False, False, True, True]
    assert found[1].longest_repeat == 31 and found[0].covered_share == 1.0


# ---- licences


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    return licenses.train([prose(25, rng).encode().split() for _ in range(400)])


def families(model, text: str):
    ((_, rows),) = licenses.scan([text.encode()], model, licenses._Numbers(model.words))
    return [f for _, f, _ in rows]


FOREIGN = [
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at the web.",
    "Licensed under the EUPL, Version 1.2 or later; you may not use this work except in compliance with the Licence.",
]


@pytest.mark.parametrize("notice", FOREIGN)
@pytest.mark.parametrize("width", [1000, 50])
def test_notices_outside_training_are_unknown(model, notice, width):
    rng = random.Random(9)
    text = "\n".join([prose(30, rng), "", *textwrap.wrap(notice, width), "", prose(30, rng)])
    assert "unknown" in families(model, text) and set(families(model, text)) == {"unknown"}


def test_prose_is_not_unknown(model):
    rng = random.Random(10)
    text = "\n".join(prose(rng.randint(3, 30), rng) for _ in range(200))
    assert families(model, text) == []


def test_short_notices_end_a_line(model):
    assert "proprietary" in families(model, "Copyright 2020 Acme. All rights reserved.")
    assert "proprietary" in families(model, "Copyright 2020 Acme.\nAll rights reserved.\nMore text here.")
    assert "proprietary" not in families(model, "All rights reserved by the author.")


def test_sample_of_different_texts(spark):
    rows = [(i, "same text") for i in range(500)] + [(1000 + i, f"text {i}") for i in range(3000)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.sample_texts(df, "doc_id", "text")
    assert len(found) == len(set(found)) == licenses.SAMPLE_DOCS
    few = licenses.sample_texts(df.where("doc_id < 1010 or doc_id is null"), "doc_id", "text")
    assert sorted(few) == sorted([b"same text", b"", *(f"text {i}".encode() for i in range(10))])


def test_lowest_by_hash_sorts_a_bounded_part(spark):
    hashes = spark.range(20000).selectExpr("xxhash64(id) as h")
    wanted = sorted(r.h for r in hashes.collect())[:50]
    assert [r.h for r in lowest_by_hash(hashes, "h", 50).collect()] == wanted


# ---- suffix dedup


def test_keys_do_not_depend_on_the_chunk():
    """The same text in a small and in a large chunk, with grams that tie in their high bits."""
    rng = random.Random(12)
    text = prose(120, rng).encode()
    large = [bytes(rng.choices(b"abcdefgh ", k=300_000)), text]
    for length in (suffix_dedup.LENGTH, 400):
        alone = suffix_dedup.text_pieces([text], length)
        among = suffix_dedup.text_pieces(large, length)
        mine = among[1] == 1
        assert all((a == b[mine]).all() for k, (a, b) in enumerate(zip(alone, among)) if k != 1)


def test_clashing_names(spark):
    text = prose(100)
    rows = [(1, text, "x", "y", "z", "s", "c"), (2, text, "x", "y", "z", "s", "c"), (3, "short", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __t1 string, __x1 string, __x2 string, __spans string, __cut string")
    found = suffix_dedup.without_repeats(df)
    assert found.dtypes == df.dtypes
    assert {(r.doc_id, r.text, r["__x1"], r["__cut"]) for r in found.collect()} == {(1, "", "y", "c"), (2, "", "y", "c"), (3, "short", None, None)}


# ---- chats


def test_chats_equal_their_sql_on_awkward_rows(spark):
    rows = [
        (1, 0, "u", "a"), (1, 1, "b", "p"),
        (2, 0, "u", "a"), (2, 1, "b", "p"), (2, 1, "b", "q"),
        (3, 0, "u", "a"), (3, 1, "b", "q"), (3, 1, "b", "p"), (3, 2, None, ""), (3, 2, None, ""),
        (4, 0, "u", "a"), (4, None, "u", "z"), (4, None, None, None),
        (5, 0, "u", "a"), (5, None, None, None), (5, None, "u", "z"),
        (6, None, "u", "z"), (7, 0, "u", ""), (8, 0, "u", None), (8, 300, "u", "late"), (8, 301, "u", "later"),
        (None, 0, "u", "a"), (None, 0, "u", "a"), (None, 9, "u", "only here"),
        (9, 0, "u", "a"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    expected = Counter(con.execute(ORACLES["op10_chat_format"]).fetchall())
    found = Counter(map(tuple, chat.format_chats(df).collect()))
    assert found == expected
    assert {c for c, *_ in found} == {1, 3, 4, 6, 7, 8, None}


# ---- n-gram Jaccard join


def test_pairs_of_a_crowd_are_all_tried_or_linked(spark, monkeypatch):
    """Chains of sets near the limit, with tiny blocks, one candidate a round and many visits."""
    from gantry.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "NEAREST", 1)
    for visits in (0, 10**9):
        monkeypatch.setattr(ngram_join, "VISITS", visits)
        rng = random.Random(13)
        texts = []
        for _ in range(4):
            words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
            for _ in range(30):  # each differs from the one before by a few words, and from others by more
                for _ in range(rng.randint(1, 3)):
                    words[rng.randrange(60)] = f"w{rng.randrange(10**6)}"
                texts.append(" ".join(words))
        texts += texts[:9]
        rng.shuffle(texts)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
        found = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df).collect()}
        sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
        parent = list(range(len(texts)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(texts)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
        assert found == {i: root(i) for i in range(len(texts))}


def test_nearest_pairs_flag_what_they_leave_out():
    from gantry.llm.ngram_join import NEAREST, nearest

    rng = np.random.default_rng(4)
    one, other = np.triu_indices(12, 1)
    differ = rng.random(len(one))
    kept, more = nearest(one, other, differ, 12)
    for i, j, d, k in zip(one, other, differ, kept):
        ranks = [np.sum(differ[(one == s) | (other == s)] < d) for s in (i, j)]
        assert k == (min(ranks) < NEAREST)
        assert k or (more[i] and more[j])


def test_pairs_are_named_by_their_smallest_common_key():
    from gantry.llm.ngram_join import own_pairs

    rng = np.random.default_rng(6)
    used = [rng.choice(np.arange(-90, 90), rng.integers(1, 25), replace=False) for _ in range(30)]
    one, other = np.triu_indices(30, 1)
    for key in (-90, 0, 37, 89):
        held = [np.unique(np.r_[u, key]) for u in used]
        want = [min(set(held[i]) & set(held[j])) == key for i, j in zip(one, other)]
        assert own_pairs(key, held, one, other).tolist() == want


@pytest.mark.parametrize("partitions", ["2", "9"])
def test_crowded_segments_come_in_pieces(spark, monkeypatch, partitions):
    """A null conversation and one whose rows have no turn hold most rows."""
    monkeypatch.setattr(chat, "PIECE_ROWS", 50)
    rng = random.Random(14)
    rows = [(None, rng.randrange(300), rng.choice(["u", None]), f"t{i}") for i in range(400)]
    rows += [(1, None, rng.choice("ab"), rng.choice([None, f"t{i}"])) for i in range(220)]
    rows += [(i, t, "u", f"x{i}{t}") for i in range(2, 20) for t in range(5)] + [(30, 0, "u", f"y{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    expected = Counter(con.execute(ORACLES["op10_chat_format"].replace("4096", "50")).fetchall())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = Counter(map(tuple, chat.format_chats(df).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == expected
    assert max(r[2] for r in found) >= 4 and all(r[4].count("<|end|>") <= 50 for r in found)


# ---- benchmark decontamination


def test_answers(spark):
    from gantry.llm import decontaminate

    rng = random.Random(15)
    question = prose(20, rng)
    items = [(1, question, "forty two"), (2, question, ""), (3, question, None), (4, question, "not there at all")]
    bench = spark.createDataFrame(items, "item_id long, text string, answer string")
    docs = [(1, prose(30, rng) + " " + question + " forty two " + prose(30, rng)), (2, prose(30, rng) + " " + question), (3, prose(60, rng))]
    found = decontaminate.contamination_report(spark.createDataFrame(docs, "doc_id long, text string"), bench, answer_col="answer")
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)}


def test_documents_are_read_once_for_all_blocks(spark, monkeypatch):
    from gantry.llm import decontaminate

    rng = random.Random(16)
    texts = [prose(30, rng) for _ in range(24)]
    bench = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], "item_id long, text string, answer string")
    docs = spark.createDataFrame([(i, prose(10, rng) + " " + t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    whole = decontaminate.contamination_report(docs, bench).collect()
    blocks = []
    cut = decontaminate._blocks

    def counted(*args):
        for ids, block in cut(*args):
            blocks.append(len(block))
            yield ids, block

    monkeypatch.setattr(decontaminate, "_blocks", counted)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 900)
    in_blocks = decontaminate.contamination_report(docs, bench)
    assert sorted(map(tuple, in_blocks.collect())) == sorted(map(tuple, whole)) and len(whole) >= 24
    assert len(blocks) > 4 and sum(blocks) == 24
    plan = in_blocks._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("ArrowEvalPython") == 1
    with_answers = bench.withColumn("answer", decontaminate.F.repeat(decontaminate.F.lit("long "), 100))
    blocks.clear()
    decontaminate.contamination_report(docs, with_answers, answer_col="answer").collect()
    assert len(blocks) == 24  # answers count
