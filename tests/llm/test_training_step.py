"""Training of the language model: against plain formulas, and its work for rows a shard has not."""

from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pytest

from gantry.llm import lm

from .test_brute_force import small_model


def plain_loss(w: dict, after: np.ndarray, rows: np.ndarray, targets: np.ndarray) -> float:
    """Mean log loss, one place at a time."""
    losses = []
    for of_rows, of_targets in zip(rows, targets):
        for t in np.flatnonzero(of_targets >= 0):
            x = w["E"][of_rows[: t + 1]]
            s = x @ w["Wk"] @ (x[-1] @ w["Wq"]) / math.sqrt(lm.KEY_WIDTH) + w["r"][np.arange(t, -1, -1)]
            a = np.exp(s - s.max())
            logits = np.tanh(x[-1] + (a / a.sum()) @ x @ w["Wv"]) @ w["Wo"] + after[of_rows[t]]
            losses.append(logits.max() + math.log(np.exp(logits - logits.max()).sum()) - logits[of_targets[t]])
    return float(np.mean(losses))


def shard(n: int, n_rows: int, n_classes: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, n_rows, (n, lm.WINDOW)), rng.integers(-1, n_classes, (n, lm.WINDOW))


@pytest.mark.parametrize("large", [{}, {"Wq": 60, "Wk": 60}, {"Wo": 6}])
def test_losses_of_small_and_very_large_scores(large):
    model = small_model()
    w = {k: v.astype(np.float64) * large.get(k, 1) for k, v in model.weights.items()}
    w["r"] = np.linspace(-1, 1, lm.WINDOW)
    rows, targets = shard(3, 40, w["Wo"].shape[1])
    got, grads = lm.step(w, model.after, rows, targets)
    assert got == pytest.approx(plain_loss(w, model.after, rows, targets), rel=1e-4)
    assert all(np.isfinite(g).all() for g in grads.values())


def test_shard_is_a_pass_of_adam(monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 4)
    model = small_model()
    rows, targets = shard(10, 40, model.weights["Wo"].shape[1])
    w = {k: v.copy() for k, v in model.weights.items()}
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    for t in (1, 2, 3):
        part = slice(4 * (t - 1), 4 * t)
        _, grads = lm.step(w, model.after, rows[part], targets[part])
        rate = lm.RATE * (1 - 0.9 * (t - 1) / 3) * math.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        for k in w:
            mean[k] = 0.9 * mean[k] + 0.1 * grads[k]
            square[k] = 0.99 * square[k] + 0.01 * grads[k] ** 2
            w[k] = w[k] - (rate * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
    got = lm.train_shard(model.weights, model.after, rows, targets)
    assert list(got) == list(w)
    for k, v in w.items():
        assert got[k].shape == v.shape and got[k].dtype == np.float32
        np.testing.assert_allclose(got[k], v, atol=2e-4)
    np.testing.assert_array_equal(got["E"][40:], model.weights["E"][40:])


def test_work_does_not_grow_with_rows_a_shard_has_not():
    """A step went through the weights, gradients and moments of all input rows."""
    model = small_model()
    many = 400_000
    weights = {**model.weights, "E": np.ones((many, lm.WIDTH), np.float32)}
    after = np.zeros((many, model.weights["Wo"].shape[1]), np.float32)
    rows, targets = shard(3, 40, after.shape[1])
    tracemalloc.start()
    try:
        lm.train_shard(weights, after, rows, targets)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * weights["E"].nbytes
