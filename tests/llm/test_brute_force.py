"""Operators without SQL counterpart against plain Python on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as driver
from gantry.llm import licenses, lm, ngram_join, quality, suffix, suffix_dedup, toxicity
from gantry.llm.common import WordHashes

from .cases import documents, prose, rows, words

SF_DIR = "/root/testdata/sf0.001"


def table(name: str) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts() -> dict[int, str]:
    return {r[0]: r[1] for r in table("documents")}


def result(spark, name: str) -> dict:
    return {r.doc_id: r for r in driver.queries()[name](spark, SF_DIR).collect()}


# ---- secrets


def secrets_of(text: str) -> list[tuple[int, str, int]]:
    assign = r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) > 5]
    spans += [(m.start(), "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) > 19]
    spans += [(m.start(), "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) > 23]
    return sorted(spans, key=lambda s: (s[0], "assign access hex".split().index(s[1])))


def check_secrets(text: str, row) -> None:
    base = secrets_of(text)
    kinds = Counter(kind for _, kind, _ in base)
    assert (row.n_assign, row.n_access, row.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
    listed = ",".join(f"{k}:{a}:{b}" for a, k, b in base)
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == [s for s in listed.split(",") if s]


def test_secrets(spark, texts):
    for doc_id, row in result(spark, "op1_secret_scan").items():
        check_secrets(texts[doc_id], row)


def test_random_strings():
    from gantry.llm import secrets

    encode = secrets.encoder(secrets.VOCABULARY).encode_ordinary
    rng = random.Random(1)
    kinds = lambda text: [k for _, k, _ in secrets.scan(text, encode, secrets.MAX_CHARS_PER_TOKEN)[1]]
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for _ in range(50):
        assert kinds("see " + "".join(rng.choices(alphabet, k=40)) + " now") == ["random"]
    for clean in (
        "internationalization_of_the_organization",
        "d41d8cd98f00b204e9800998ecf8427e"[::-1].upper(),
        "123e4567-e89b-12d3-a456-426614174000",
        "4111111111111111111111111111",
        "https://example.com/articles/understanding-large-documents",
    ):
        assert "random" not in kinds(f"a {clean} b")


# ---- language model


def test_language_base(spark, texts):
    train = {d: words(t.encode().lower().decode()) for d, t in texts.items() if zlib.crc32(str(d).encode()) % 10}
    counts = Counter(w for t in train.values() for w in t)
    total, distinct = sum(counts.values()) + len(train), len(counts) + 1
    whole = total + 0.1 * (distinct + 1)
    for doc_id, row in result(spark, "op2_lm_score").items():
        tokens = words(texts[doc_id].encode().lower().decode())
        base = sum(math.log10((counts[w] + 0.1) / whole) for w in tokens) + math.log10((len(train) + 0.1) / whole)
        assert row.held_out == (doc_id not in train)
        assert (row.n_tokens, row.n_known) == (len(tokens) + 1, sum(w in counts for w in tokens) + 1)
        assert row.train_tokens == total
        assert row.base_score == pytest.approx(base)
        assert row.score < 0


def small_model(seed: int = 0) -> lm.Model:
    begins, context = lm.vocabulary_facts(lm.VOCABULARY)
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, len(begins)).astype(float)
    of_class, row = lm.classes_of(counts, begins)
    n_classes = int(of_class.max()) + 1
    in_context = rng.integers(0, 3, (lm.CONTEXTS, len(begins))).astype(float)
    after = rng.integers(0, 9, (lm.INPUT_ROWS, n_classes)).astype(float)
    model = lm.new_model(counts, in_context, after, begins, context, of_class, row)
    model.weights["Wo"] = rng.standard_normal(model.weights["Wo"].shape).astype(np.float32)
    return model


def test_windows_score_each_subword_once():
    """Batched windows against one place at a time, with the context its window has."""
    model = small_model()
    scorer = lm.Scorer(model)
    found, ends, _ = lm.Subwords(lm.VOCABULARY).of([prose(n).encode().split() for n in (0, 1, 12, 60, 90)])
    got = scorer(found, ends)
    w = model.weights
    for begin, end in zip([0, *ends[:-1]], ends):
        inputs = [0, *model.row[found[begin : end - 1]]]
        for t in range(end - begin):
            start = 0 if t < lm.WINDOW else lm.STRIDE * -(-(t - lm.WINDOW + 1) // lm.STRIDE)
            x = w["E"][inputs[start : t + 1]].astype(float)
            scores = x @ w["Wk"] @ (x[-1] @ w["Wq"]) / math.sqrt(lm.KEY_WIDTH) + w["r"][np.arange(t - start, -1, -1)]
            share = np.exp(scores - scores.max())
            h = np.tanh(x[-1] + share @ (x @ w["Wv"]) / share.sum())
            logits = h @ w["Wo"] + model.after[inputs[t]]
            want = logits[model.of_class[found[begin + t]]] - np.log(np.exp(logits).sum())
            assert got[begin + t] == pytest.approx(want, abs=1e-3)


def test_words_have_the_same_subwords_anywhere():
    encode = lm.encoder(lm.VOCABULARY).encode_ordinary
    found = [w.encode() for w in "the don't 漢字 été 12ab $$$ a\u00a0b \u00a0x y\u2003 \x1c. caf\u00e9s <|endoftext|>".split(" ")]
    ids, edges = lm.encoded_words(lm.VOCABULARY, found)
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [encode(" " + w.decode()) for w in found]
    subwords = lm.Subwords(lm.VOCABULARY)
    for _ in range(2):
        ids, ends, _ = subwords.of([found, [], found[:2]])
        assert ids.tolist() == [i for t in (found, [], found[:2]) for i in [*(i for w in t for i in encode(" " + w.decode())), subwords.end]]
        assert len(ends) == 3 and ends[-1] == len(ids)


def test_model_is_a_distribution():
    model = small_model()
    for context in (0, 40, lm.CONTEXTS - 1):
        sums = np.bincount(model.of_class, 10.0 ** model.within[context].astype(float))
        assert sums == pytest.approx(np.ones(len(sums)), abs=1e-4)
    assert np.exp(model.after.astype(float)).sum(axis=1) == pytest.approx(np.ones(lm.INPUT_ROWS), abs=1e-4)


def test_gradients():
    rng = np.random.default_rng(2)
    model = small_model()
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs = rng.integers(0, 30, (3, lm.WINDOW))
    targets = rng.integers(-1, 5, (3, lm.WINDOW))
    _, grads = lm.step(w, model.after, inputs, targets)
    for name, value in w.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        losses = []
        for shift in (1e-5, -1e-5):
            value[at] += shift
            losses.append(lm.step(w, model.after, inputs, targets)[0])
            value[at] -= shift
        assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-6)


# ---- quality


def repeats(found: list[bytes], size: int) -> set[int]:
    places = defaultdict(list)
    for i in range(len(found) - size + 1):
        places[tuple(found[i : i + size])].append(i)
    return {i + k for p in places.values() if len(p) > 1 for i in p for k in range(size)}


def check_quality(text: str | None, row) -> None:
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    n_repeat = len(repeats(found, 5))
    assert row.n_words == len(found)
    assert row.word_chars == sum(len(w.decode()) for w in found)
    assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
    assert row.n_dup_lines == len(lines) - len(set(lines))
    assert row.n_repeat_words == n_repeat
    assert row.base_failed == (len(found) < 10 or 100 * n_repeat > 20 * len(found))
    longest = 0
    while len(found) < 2000 and repeats(found, longest + 1):
        longest += 1
    if len(found) < 2000:
        assert row.longest_repeat == longest
    covered = sum(len(found[i].decode()) for i in repeats(found, quality.MIN_REPEAT)) / max(1, row.word_chars)
    assert row.covered_share == pytest.approx(covered)
    assert row.kept == (not row.base_failed and covered <= quality.MAX_COVERED and row.longest_repeat <= quality.MAX_LONGEST)


def test_quality(spark, texts):
    for doc_id, row in result(spark, "op3_quality_rules").items():
        check_quality(texts[doc_id], row)


def test_quality_of_awkward_rows(spark):
    by_id = {r[0]: r[1] for r in rows() if r[0] not in (None, 3)}
    for row in quality.quality_report(documents(spark)).collect():
        if row.doc_id in by_id:
            check_quality(by_id[row.doc_id], row)


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for size, letters in ((1, 1), (2, 1), (60, 1), (300, 2), (500, 5)):
        symbols = np.r_[rng.integers(0, letters, size), letters]
        tails = [tuple(symbols[i:]) for i in range(len(symbols))]
        order, levels = suffix.suffix_ranks(symbols)
        assert [tails[i] for i in order] == sorted(tails)
        assert suffix.suffix_order(symbols).tolist() == order.tolist()
        lcp = suffix.common_prefixes(order, levels)
        for k in range(1, len(order)):
            a, b = tails[order[k - 1]], tails[order[k]]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == same
        for length in (1, 3, 20):
            want = [tails.index(t) for t in tails if sum(o[:length] == t[:length] and len(o) >= length for o in tails) > 1 and len(t) >= length]
            assert np.flatnonzero(suffix_dedup.repeated_starts(symbols, length)).tolist() == sorted(want)


# ---- licences


def test_licences(spark):
    rng = random.Random(4)
    notes = [(family, text) for family, found in licenses.NOTICES.items() for text in found]
    docs = [(i, f"{prose(40, rng)}\n{text}\n{prose(30, rng)}") for i, (_, text) in enumerate(notes)]
    docs += [(1000 + i, "\n".join(prose(25, rng) for _ in range(8))) for i in range(200)]
    found = {r.doc_id: r for r in licenses.license_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    right = sum(found[i].families == family for i, (family, _) in enumerate(notes))
    assert right >= 0.9 * len(notes)
    assert sum(found[1000 + i].findings != "" for i in range(200)) <= 2
    assert {r.n_paragraphs for r in found.values()} == {3, 8}


# ---- contamination


def test_leaks(spark, texts):
    want = {(d, i) for d, t in texts.items() for i, item in table("benchmark") if " ".join(item.split()) in " ".join(t.split())}
    rows = driver.queries()["op5_benchmark_leaks"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.item_id) for r in rows} >= want
    assert all(r.question_overlap > 0.9 for r in rows)


def test_wand_finds_all_above_threshold():
    from gantry.llm.decontaminate import Index

    rng = random.Random(5)
    index = Index([(prose(rng.randint(5, 60), rng).encode(), None) for _ in range(300)])
    for _ in range(40):
        asked = sorted({index.terms.get(w, -1) for w in prose(100, rng).encode().split()} - {-1})
        scores = defaultdict(float)
        for t in asked:
            for k in range(index.starts[t], index.starts[t + 1]):
                scores[index.parts[k]] += index.weights[k]
        for threshold in (0.05, 0.2, 0.5):
            found = dict(index.search(asked, threshold))
            assert set(found) == {p for p, s in scores.items() if s >= threshold}
            assert all(found[p] == pytest.approx(scores[p]) for p in found)


# ---- similar documents


def components(sets: dict) -> dict:
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def shingles(text: str | None) -> frozenset:
    found = words((text or "").encode().lower().decode())
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def test_jaccard(spark, texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    want = components(sets)
    for doc_id, row in result(spark, "op6_ngram_jaccard").items():
        assert (row.n_shingles, row.component_id) == (len(sets[doc_id]), want[doc_id])


def varied(n: int) -> list[tuple[int, str]]:
    """Copies of one text, each changed in a few places, so that links are near the bound."""
    rng = random.Random(8)
    base = prose(100, rng).split()
    found = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(100)] = f"w{rng.randrange(10**6)}"
        found.append((i, " ".join(copy)))
    return found


@pytest.mark.parametrize(("hot", "block"), [(1000, 2048), (20, 16)])
def test_group_of_near_copies(spark, monkeypatch, hot, block):
    """With small bounds: hot keys, and tiles of several blocks."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = varied(70)
    want = components({i: shingles(t) for i, t in docs})
    got = ngram_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_bitmaps_rule_out_no_link():
    rng = random.Random(9)
    sets = list(ngram_join.shingle_sets([t.encode() for _, t in varied(60)] + [prose(rng.randint(3, 90), rng).encode() for _ in range(30)], WordHashes()))
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    each = np.arange(len(sets))
    found = set(ngram_join.tile_pairs(n, [ngram_join.bitmap(s) for s in sets], each, np.zeros(len(sets)), star=False))
    for j in range(len(sets)):
        for i in range(j):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (n[i] + n[j] - both):
                assert (i, j) in found


def test_one_of_each(spark):
    docs = spark.createDataFrame([*varied(20), (0, varied(1)[0][1]), (99, None), (98, None)], "doc_id long, text string")
    kept = sorted(r.doc_id for r in ngram_join.one_of_each(docs).collect())
    want = components({i: shingles(t) for i, t in varied(20)})
    assert kept == sorted({*want.values(), 98, 99})


# ---- toxicity


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(10)
    bad = ["vilebad", "nastyword", "awfulone"]
    docs, labels = [], []
    for i in range(700):
        found = prose(rng.randint(20, 150), rng).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                found[rng.randrange(len(found))] = rng.choice(bad)
        docs.append((i, " ".join(found)))
        labels.append((i, int(toxic)))
    found = toxicity.toxicity_scores(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    ).collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)


def test_network_gradients():
    rng = np.random.default_rng(1)
    texts = [prose(30).encode() + (b" vile" if i % 2 else b"") for i in range(40)]
    net = toxicity.train(texts, np.arange(40) % 2)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    gates = tuple(rng.standard_normal((20, 3 * toxicity.HIDDEN)) for _ in range(2))
    ids = rng.integers(0, 20, (6, toxicity.WINDOW))
    labels = np.array([0, 1, 0, 1, 1, 0.0])

    def loss() -> float:
        logits = net.forward(gates, ids)[0].astype(float)
        return float(np.mean(np.log1p(np.exp(logits)) - labels * logits))

    logits, run = net.forward(gates, ids, keep=True)
    grads, d_gates = net.gradients(ids, labels, logits, run)
    for name in ("Uf", "Ub", "v", "w"):
        value = net.weights[name]
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        losses = []
        for shift in (1e-2, -1e-2):
            value[at] += shift
            losses.append(loss())
            value[at] -= shift
        assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-2, rel=0.05, abs=1e-4)
    by_row = np.zeros((20, 6 * toxicity.HIDDEN))
    np.add.at(by_row, ids.ravel(), d_gates.reshape(-1, 6 * toxicity.HIDDEN))
    at = np.unravel_index(np.abs(by_row).argmax(), by_row.shape)
    side, column = divmod(at[1], 3 * toxicity.HIDDEN)
    losses = []
    for shift in (1e-2, -1e-2):
        gates[side][at[0], column] += shift
        losses.append(loss())
        gates[side][at[0], column] -= shift
    assert by_row[at] == pytest.approx((losses[0] - losses[1]) / 2e-2, rel=0.05, abs=1e-4)


def test_windows_cover_the_text():
    for n in (0, 1, 47, 48, 49, 84, 85, 500):
        starts = toxicity.window_starts(n)
        assert {s + k for s in starts for k in range(toxicity.WINDOW) if s + k < n} == set(range(n))


# ---- repeated strings


def check_removed(docs: list[bytes], found: list[tuple]) -> None:
    size = suffix_dedup.LENGTH
    counts = Counter(d[i : i + size] for d in docs for i in range(len(d) - size + 1))
    for data, (n_bytes, n_removed, n_spans, digest) in zip(docs, found):
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - size + 1):
            if counts[data[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int((gone[1:] < gone[:-1]).sum())
        assert (n_bytes, n_removed, n_spans) == (len(data), int(gone.sum()), runs)
        assert digest == hashlib.sha256(kept).hexdigest()


def test_suffix_dedup(spark, texts):
    found = result(spark, "op9_suffix_dedup")
    ids = sorted(texts)
    rows = [(found[i].n_bytes, found[i].n_removed, found[i].n_spans, found[i].kept_sha256) for i in ids]
    check_removed([texts[i].encode() for i in ids], rows)


@pytest.mark.parametrize(("group", "array"), [(4096, 1 << 19), (3, 2000)])
def test_suffix_dedup_of_mixed_repeats(spark, monkeypatch, group, array):
    """Passages in different surroundings, periodic texts, copies; with small bounds too."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", array)
    rng = random.Random(6)
    passages = [prose(rng.randint(30, 90), rng) for _ in range(6)]
    docs = []
    for _ in range(40):
        parts = [prose(rng.randint(0, 60), rng), rng.choice(passages), prose(rng.randint(0, 30), rng), rng.choice(passages)]
        docs.append(" ".join(parts)[rng.randint(0, 40) :])
    docs += ["ab" * 500, "x" * 450, "abc" * 90, docs[0], docs[1][5:], "", "short", passages[0][:199], passages[1][:200], "ü" * 300]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)
    found = sorted(suffix_dedup.removal_report(frame).collect())
    check_removed([d.encode() for d in docs], [tuple(r[1:]) for r in found])


# ---- mixing


def test_mix_reruns_agree(spark):
    first, second = (driver.queries()["op7_source_mix"](spark, SF_DIR).collect() for _ in range(2))
    assert first == second


def test_mix_takes_its_targets(spark, texts):
    rows = result(spark, "op7_source_mix").values()
    taken, targets = defaultdict(int), {}
    for source, ids in duckdb.sql(f"SELECT source, list(doc_id) FROM '{SF_DIR}/documents.parquet' GROUP BY 1").fetchall():
        for r in rows:
            if r.doc_id in set(ids):
                assert 0 <= r.taken <= 2 * r.size == 2 * len(words(texts[r.doc_id]))
                taken[source] += r.taken
                targets[source] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in targets.items())
