"""Exact duplicates against a plain grouping, with heavy and light groups."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from gantry.llm import exact_dedup

from .cases import documents, no_documents, rows


def lowered(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(table):
    groups = defaultdict(list)
    for doc_id, text in table:
        groups[lowered(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = False
        for i in sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True):
            out[i, keep, len(ids), not stays, digest] += 1
            stays = True
    return out


def report(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.copies_report(df).collect())


def test_awkward_rows(spark):
    assert report(documents(spark)) == expected([r[:2] for r in rows()])
    assert exact_dedup.copies_report(no_documents(spark)).collect() == []


def test_only_ascii_letters_are_lowered(spark):
    table = [(1, "ÀB"), (2, "àb"), (3, "Àb"), (4, "K"), (5, "K")]  # the last is the Kelvin sign
    assert report(spark.createDataFrame(table, "doc_id long, text string")) == expected(table)


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows share one text, another tenth has no id, many texts are there twice."""
    rng = random.Random(11)
    table = [(i, "Hot TEXT" if i % 3 == 0 else f"text {rng.randrange(2500)}") for i in range(6000)]
    table += [(None, "no id") for _ in range(700)] + [(7, "same id") for _ in range(40)]
    table += [(10_000 + i, t) for i in range(60) for t in ("fifty one", "FIFTY one")]
    rng.shuffle(table)
    return table


def test_heavy_and_light_groups(spark, skewed):
    df = spark.createDataFrame(skewed, "doc_id long, text string").repartition(7)
    assert report(df) == expected(skewed)


def test_every_heavy_digest_is_found(spark, skewed, monkeypatch):
    """With few counters, those that are looked at still hold all heavy digests."""
    monkeypatch.setattr(exact_dedup, "TRACKED", 512)
    monkeypatch.setattr(exact_dedup, "CANDIDATES", 200)
    monkeypatch.setattr(exact_dedup, "SHARE", 60)
    df = spark.createDataFrame(skewed, "doc_id long, text string").repartition(5)
    digests = exact_dedup._digests(df, "doc_id", "text", exact_dedup.F.lit(0))
    found = {bytes(r.digest).hex(): r.group_size for r in exact_dedup.heavy_groups(digests).collect()}
    sizes = Counter(hashlib.sha256(lowered(t).encode()).hexdigest() for _, t in skewed)
    assert found == {d: n for d, n in sizes.items() if n * 60 > len(skewed)}
    assert len(found) < 60
    assert report(df) == expected(skewed)


def test_filter_keeps_columns_and_one_row_of_each(spark):
    table = [(1, "a", "x", 1), (2, "A", "y", 2), (2, "a", "y", 2), (None, None, "z", 3), (None, "", "z", 4), (3, "b", None, 5)]
    df = spark.createDataFrame(table, "doc_id long, text string, digest string, row_number long")
    kept = exact_dedup.without_copies(df)
    assert kept.dtypes == df.dtypes
    found = kept.collect()
    assert Counter(r.doc_id for r in found) == Counter([2, None, 3])
    assert all(tuple(r) in {tuple(t) for t in table} for r in found)


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.copies_report(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
