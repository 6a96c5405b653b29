"""Whitening against plain integer statistics and its own definition."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gantry.llm import whitening


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n long, component string").repartition(3)


def vectors(count=700, dims=6, seed=2):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims))
    return (rng.normal(size=(count, dims)) @ mix).astype(np.float32)


def integers(v) -> list[int]:
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


def check(found, x):
    """Rows of the report against the integer vectors ``x`` (a list of lists), by id."""
    n, dims = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(dims)]
    deviation = [sum((n * row[d] - sums[d]) ** 2 for d in range(dims)) for row in x]
    centred = np.array([[(n * row[d] - sums[d]) / n for d in range(dims)] for row in x])
    covariance = centred.T @ centred / n
    values = np.sort(np.linalg.eigvalsh(covariance))[::-1]
    size = max(r.component for r in found)
    assert len(found) == n * size
    white = np.zeros((n, size))
    for r in found:
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / covariance.trace(), rel=1e-9)
        assert r.identity_error <= 1e-4
        white[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(white.T @ white / n - np.eye(size)).max() <= 1e-9
    # every component is an eigenvector: the whitened values give it back
    directions = centred.T @ white / n
    for k in range(size):
        v = directions[:, k] / np.linalg.norm(directions[:, k])
        assert np.abs(covariance @ v - values[k] * v).max() <= 1e-9 * values[0]


def test_against_integers(spark):
    rows = vectors()
    df = table(spark, [(i, v.tolist(), 1, "x") for i, v in enumerate(rows)])
    check(whitening.whitened_vectors(df).collect(), [integers(v) for v in rows])


def test_at_most_so_many_components(spark):
    rows = vectors(300, 40)
    df = table(spark, [(i, v.tolist(), 1, "x") for i, v in enumerate(rows)])
    found = whitening.whitened_vectors(df).collect()
    assert {r.component for r in found} == set(range(1, 33))
    check(found, [integers(v) for v in rows])


def test_wide_ranges_need_more_than_64_bits(spark):
    rng = random.Random(4)
    rows = [[rng.choice([1e9, -3e7, 0.25, 1.0]) * rng.random() for _ in range(3)] for _ in range(200)]
    df = table(spark, [(i, v, 1, "x") for i, v in enumerate(rows)], "double")
    found = whitening.whitened_vectors(df).collect()
    x = [integers(v) for v in rows]
    sums = [sum(r[d] for r in x) for d in range(3)]
    exact = [sum((200 * r[d] - sums[d]) ** 2 for d in range(3)) for r in x]
    assert any(e >= 1 << 63 for e in exact)
    for r in found:
        assert r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 1 << 63 else None)
        assert r.identity_error <= 1e-4


def test_products_of_planes_are_exact():
    rng = np.random.default_rng(9)
    x = rng.integers(-5000, 90_000, (777, 5))
    low = x.min(axis=0)
    bits = [int(b).bit_length() for b in x.max(axis=0) - low]
    counts = np.zeros((5, 5, 2 * max(bits) - 1), np.int64)
    whitening.shared_bits(whitening.bit_planes(x, low, bits), bits, counts)
    shifted = (x - low).astype(object)
    for i in range(5):
        for j in range(i, 5):
            assert sum(int(c) << s for s, c in enumerate(counts[i, j])) == (shifted[:, i] * shifted[:, j]).sum()


def test_unusable_vectors_are_dropped(spark):
    good = vectors(60, 3)
    rows = [(i, v.tolist(), 1, "x") for i, v in enumerate(good)]
    bad = [None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("inf"), 0.0], [0.0, 0.0, float("-inf")]]
    df = table(spark, rows + [(1000 + i, v, None, None) for i, v in enumerate(bad)])
    check(whitening.whitened_vectors(df).collect(), [integers(v) for v in good])


def test_short_vectors_count_as_zero(spark):
    rows = [v.tolist() for v in vectors(80, 3)]
    rows[5], rows[6], rows[7] = rows[5][:2], rows[6][:1], []
    df = table(spark, [(i, v, 1, "x") for i, v in enumerate(rows)])
    check(whitening.whitened_vectors(df).collect(), [integers(v + [0.0] * (3 - len(v))) for v in rows])


def test_nothing_varies(spark):
    df = table(spark, [(i, [0.5, 0.25], 1, "x") for i in range(5)])
    for rows in (df, df.limit(1), df.limit(0), df.withColumn("embedding", F.lit(None).cast("array<float>"))):
        result = whitening.whitened_vectors(rows)
        assert result.columns[:2] == ["vec_id", "component"] and result.collect() == []


def test_constant_dimensions_and_repeated_rows(spark):
    rows = [[float(i % 4), 7.0, float(i % 3)] for i in range(24)]
    df = table(spark, [(i, v, 1, "x") for i, v in enumerate(rows)])
    found = whitening.whitened_vectors(df).collect()
    assert {r.component for r in found} == {1, 2}
    check(found, [integers(v) for v in rows])
    null_ids = whitening.whitened_vectors(df.withColumn("vec_id", F.lit(None).cast("long")))
    assert null_ids.count() == 48
