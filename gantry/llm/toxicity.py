"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of an embedding of the whole word, if the training sample holds
it often enough, and of its character 3- and 5-grams (of bytes, with marks for the ends).
Two gated recurrent layers read a window of words from both sides, attention pools their
states, and a logistic unit scores the window. Every document is cut into overlapping
windows that cover its whole text; its score is that of its highest window, calibrated.

The network is trained in numpy, in one task, on a bounded sample of labelled documents:
``SAMPLE`` of either class, the first by a hash, each of at most ``SAMPLE_BYTES`` bytes.
Labels are per document, so training picks windows: first those with the words most
typical of the label (by log-odds in the sample), later those the network scores highest.
The prior is the share of toxic ones among all usable labelled documents, and the
calibration is shifted by the difference in log-odds between that share and the sample's.

Cases: null, empty and wordless texts have no window and get the score of the prior;
rows of ``labels`` with nulls are ignored, of several labels the highest counts; without
labels of both classes all scores are the prior; repeated rows get equal scores; an empty
table gives an empty result. Scores depend on the text alone.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import chunks, lowest_by_hash, text_or_empty

SAMPLE = 1200
SAMPLE_BYTES = 1 << 16
WINDOW, STRIDE = 48, 36
INPUTS, HIDDEN = 12, 8
GRAM_ROWS = 1 << 16
MIN_WORD_DOCS, MIN_GRAM_DOCS = 5, 8
#: Passes over the sample, and steps at least, however small it is.
EPOCHS, STEPS, BATCH, RATE = 6, 160, 256, 0.004
#: Fixed by the contract: a document is predicted toxic from this score on.
CUT = 0.3
#: Windows scored at a time, and words whose inputs are kept while a task runs.
SCORED, REMEMBERED = 2048, 250_000

_EDGES = bytes(set(range(0x21, 0x7F)) - set(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))


def plain_words(text: bytes) -> list[bytes]:
    """Lower-case words without punctuation around them."""
    return [word.strip(_EDGES) or word for word in text.lower().split()]


def gram_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the character grams of all words, and where each word's begin (and end)."""
    marked = [b"\x02" + w + b"\x03\x03" for w in words]
    raw = np.frombuffer(b"".join(marked) + bytes(4), np.uint8).astype(np.uint64)
    sizes = np.array([len(m) for m in marked], np.int64)
    places = np.arange(int(sizes.sum()))
    left = np.repeat(np.cumsum(sizes), sizes) - places
    value = raw[: len(places)].copy()
    rows, owners = [], []
    owner = np.repeat(np.arange(len(words)), sizes)
    for k in range(1, 5):
        value = value * np.uint64(257) + raw[k : k + len(places)]
        if k in (2, 4):
            spread = (value + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
            fits = left > k
            rows.append((spread[fits] >> np.uint64(48)).astype(np.int64) % GRAM_ROWS)
            owners.append(owner[fits])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(rows)[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(share: float) -> float:
    return float(np.log(share / (1 - share)))


def window_starts(n_words: int) -> list[int]:
    """First words of the overlapping windows of a text; the last one ends with the text."""
    if not n_words:
        return []
    last = max(0, n_words - WINDOW)
    return [*range(0, last, STRIDE), last]


#: Projected inputs of words, for the forward and the backward layer.
Gates = tuple[np.ndarray, np.ndarray]


def _sum_by(places: np.ndarray, values: np.ndarray, into: np.ndarray) -> None:
    """Add rows of ``values`` to the rows of ``into`` that ``places`` names."""
    if len(places):
        order = np.argsort(places, kind="stable")
        ordered = places[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        into[ordered[first]] += np.add.reduceat(values[order], first, axis=0)


@dataclass
class Network:
    """Parameters. Gates stand in the order update, reset, candidate; first forward, then backward."""

    words: dict[bytes, int]
    table: np.ndarray  # rows of words, then of grams
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    prior: float = 0.0

    def inputs(self, words: list[bytes]) -> np.ndarray:
        rows, edges = gram_rows(words)
        # every word has grams, so no range is empty
        grams = np.add.reduceat(self.table[len(self.words) + 1 + rows], edges[:-1], axis=0)
        grams /= np.sqrt(edges[1:] - edges[:-1]).astype(np.float32)[:, None]
        own = np.array([self.words.get(w, len(self.words)) for w in words])
        return grams + self.table[own]

    def projected(self, inputs: np.ndarray) -> Gates:
        """What the inputs add to the gates of the forward and of the backward layer."""
        w, b, half = self.weights["W"], self.weights["b"], 3 * HIDDEN
        return inputs @ w[:, :half] + b[:half], inputs @ w[:, half:] + b[half:]

    def scores(self, gates: Gates, ids: np.ndarray) -> np.ndarray:
        """Logits of windows of rows of ``gates`` (projected inputs); row 0 stands for no word."""
        return self.forward(gates, ids)[0]

    def forward(self, gates: Gates, ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        h_size = HIDDEN
        n, steps = ids.shape
        w = self.weights
        u = np.zeros((2 * h_size, 6 * h_size), np.float32)
        # one product for both directions; columns: z forward, z backward, r, r, n, n
        for d, name in enumerate(("Uf", "Ub")):
            for g in range(3):
                at = (2 * g + d) * h_size
                u[d * h_size : (d + 1) * h_size, at : at + h_size] = w[name][:, g * h_size : (g + 1) * h_size]
        h = np.zeros((n, 2 * h_size), np.float32)
        states = np.empty((n, steps, 2 * h_size), np.float32)
        saved = []
        x = np.empty((n, 6 * h_size), np.float32)
        by_side = x.reshape(n, 3, 2, h_size)
        columns = np.ascontiguousarray(ids.T)
        k = 2 * h_size
        for t in range(steps):
            by_side[:, :, 0] = np.take(gates[0], columns[t], axis=0).reshape(n, 3, h_size)
            by_side[:, :, 1] = np.take(gates[1], columns[steps - 1 - t], axis=0).reshape(n, 3, h_size)
            hu = h @ u
            zr = x[:, : 2 * k] + hu[:, : 2 * k]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :k], zr[:, k:]
            c = np.tanh(x[:, 2 * k :] + r * hu[:, 2 * k :])
            if keep:
                saved.append((h, z, r, c, hu[:, 2 * k :]))
            h = c + z * (h - c)
            states[:, t, :h_size] = h[:, :h_size]
            states[:, steps - 1 - t, h_size:] = h[:, h_size:]
        attention = states @ w["v"]
        attention = np.where(ids > 0, attention, -1e9)
        attention = np.exp(attention - attention.max(axis=1, keepdims=True))
        attention /= attention.sum(axis=1, keepdims=True)
        pooled = np.matmul(attention[:, None, :], states)[:, 0]
        logits = pooled @ w["w"] + w["c"]
        return logits, {"saved": saved, "states": states, "attention": attention, "pooled": pooled, "u": u}

    def gradients(self, ids: np.ndarray, labels: np.ndarray, logits: np.ndarray, run: dict) -> tuple[dict, np.ndarray]:
        """Gradients of the mean log loss: of the weights, and of the gates of each window and step."""
        h_size, k = HIDDEN, 2 * HIDDEN
        n, steps = ids.shape
        w, u = self.weights, run["u"]
        states, attention, pooled = run["states"], run["attention"], run["pooled"]
        d_logit = ((_sigmoid(logits) - labels) / n).astype(np.float32)
        grads = {"w": pooled.T @ d_logit, "c": d_logit.sum()}
        d_pooled = d_logit[:, None] * w["w"]
        d_att = np.einsum("nth,nh->nt", states, d_pooled)
        d_score = attention * (d_att - (attention * d_att).sum(axis=1, keepdims=True))
        grads["v"] = np.einsum("nth,nt->h", states, d_score)
        d_states = attention[:, :, None] * d_pooled[:, None, :] + d_score[:, :, None] * w["v"]
        du = np.zeros_like(u)
        d_gates = np.zeros((n, steps, 6 * h_size), np.float32)
        dh = np.zeros((n, k), np.float32)
        for t in range(steps - 1, -1, -1):
            back = steps - 1 - t
            h, z, r, c, hu_c = run["saved"][t]
            dh = dh + np.concatenate([d_states[:, t, :h_size], d_states[:, back, h_size:]], axis=1)
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * hu_c * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], axis=1)
            dhu = np.concatenate([dz, dr, dc * r], axis=1)
            du += h.T @ dhu
            dh = dh * z + dhu @ u.T
            for g in range(3):
                d_gates[:, t, g * h_size : (g + 1) * h_size] = dx[:, 2 * g * h_size : (2 * g + 1) * h_size]
                d_gates[:, back, (3 + g) * h_size : (4 + g) * h_size] = dx[:, (2 * g + 1) * h_size : (2 * g + 2) * h_size]
        for d, name in enumerate(("Uf", "Ub")):
            rows = slice(d * h_size, (d + 1) * h_size)
            grads[name] = np.concatenate(
                [du[rows, (2 * g + d) * h_size : (2 * g + d + 1) * h_size] for g in range(3)], axis=1
            )
        return grads, d_gates

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * logit + self.shift)


# ---- training ------------------------------------------------------------


def _log_odds(holders: np.ndarray, toxic: np.ndarray, owners: np.ndarray, size: int, least: int) -> np.ndarray:
    """Smoothed log-odds of the label for each row, 0 where fewer than ``least`` documents have it."""
    with_label = toxic[owners]
    yes = np.bincount(holders, with_label, minlength=size)
    all_ = np.bincount(holders, minlength=size)
    rate = toxic.mean()
    odds = np.log((yes + 2 * rate) / (all_ - yes + 2 * (1 - rate))) - np.log(rate / (1 - rate))
    return np.where(all_ >= least, odds, 0.0)


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.state = rate, 0, {}

    def update(self, name: str, value: np.ndarray, grad: np.ndarray) -> None:
        mean, square = self.state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        mean += 0.1 * (grad - mean)
        square += 0.001 * (grad * grad - square)
        rate = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        value -= rate * mean / (np.sqrt(square) + 1e-8)


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 7, share: float | None = None) -> Network:
    """A network from whole texts and their labels (0 or 1, both present).

    ``share`` is that of the toxic ones where the texts were drawn from, if not theirs.
    """
    rng = np.random.default_rng(seed)
    toxic = toxic.astype(np.float64)
    docs = [plain_words(t) for t in texts]
    vocabulary = list(dict.fromkeys(w for d in docs for w in d))
    number = {w: i for i, w in enumerate(vocabulary)}
    doc_ids = [np.array([number[w] for w in d], np.int64) for d in docs]
    distinct = [np.unique(d) for d in doc_ids]
    owners = np.repeat(np.arange(len(docs)), [len(d) for d in distinct])
    holders = np.concatenate(distinct) if distinct else np.zeros(0, np.int64)
    word_odds = _log_odds(holders, toxic, owners, len(vocabulary), MIN_WORD_DOCS)
    often = np.flatnonzero(np.bincount(holders, minlength=len(vocabulary)) >= MIN_WORD_DOCS)
    kept = {vocabulary[i]: row for row, i in enumerate(often)}

    rows, edges = gram_rows(vocabulary)
    sizes = edges[1:] - edges[:-1]
    gram_docs = [np.unique(np.concatenate([rows[edges[i] : edges[i + 1]] for i in d])) if len(d) else d for d in distinct]
    gram_owners = np.repeat(np.arange(len(docs)), [len(d) for d in gram_docs])
    gram_holders = np.concatenate(gram_docs)
    gram_odds = _log_odds(gram_holders, toxic, gram_owners, GRAM_ROWS, MIN_GRAM_DOCS)

    table = (rng.standard_normal((len(kept) + 1 + GRAM_ROWS, INPUTS)) * 0.05).astype(np.float32)
    table[len(kept)] = 0
    table[: len(kept), 0] = word_odds[often]
    grams_known = np.bincount(gram_holders, minlength=GRAM_ROWS) >= MIN_GRAM_DOCS
    table[len(kept) + 1 :][~grams_known] = 0
    table[len(kept) + 1 :, 0] = 0.3 * gram_odds
    fixed = np.r_[np.zeros(len(kept), bool), True, ~grams_known]

    h = HIDDEN
    start = lambda *shape: (rng.standard_normal(shape) * 0.25).astype(np.float32)
    net = Network(kept, table)
    net.weights = {
        "W": start(INPUTS, 6 * h),
        "b": np.zeros(6 * h, np.float32),
        "Uf": start(h, 3 * h),
        "Ub": start(h, 3 * h),
        "v": start(2 * h),
        "w": start(2 * h),
        "c": np.zeros((), np.float32),
    }
    net.weights["W"][0] = np.abs(net.weights["W"][0])

    # windows as numbers of the vocabulary plus one; 0 is no word
    windows, of_doc = [], []
    for i, d in enumerate(doc_ids):
        for s in window_starts(len(d)):
            window = np.zeros(WINDOW, np.int64)
            window[: len(d[s : s + WINDOW])] = d[s : s + WINDOW] + 1
            windows.append(window)
            of_doc.append(i)
    windows, of_doc = np.array(windows).reshape(-1, WINDOW), np.array(of_doc, np.int64)
    held = rng.random(len(docs)) < 0.2
    word_row = np.array([kept.get(w, len(kept)) for w in vocabulary])
    adam = _Adam(RATE)

    def gates_of_all() -> Gates:
        return net.projected(np.concatenate([np.zeros((1, INPUTS), np.float32), net.inputs(vocabulary)]))

    def pick(score: np.ndarray, best: int) -> np.ndarray:
        """The best windows of each document, and for clean ones another at random."""
        order = np.lexsort((-score, of_doc))
        rank = np.arange(len(order)) - np.searchsorted(of_doc[order], of_doc[order])
        chosen = order[(rank < best) & ~held[of_doc[order]]]
        clean = np.flatnonzero((toxic[of_doc] == 0) & ~held[of_doc])
        return np.concatenate([chosen, rng.choice(clean, min(len(clean), len(docs)), replace=False)])

    odds = np.r_[0.0, word_odds + 0.3 * np.add.reduceat(gram_odds[rows], edges[:-1]) / np.sqrt(sizes)]
    score = odds[windows].max(axis=1)
    epoch = 0
    while epoch < EPOCHS or adam.step < STEPS:
        if epoch >= 2:
            gates = gates_of_all()
            score = np.concatenate([net.scores(gates, windows[i : i + SCORED]) for i in range(0, len(windows), SCORED)])
        chosen = rng.permutation(pick(score, 1))
        for at in range(0, len(chosen), BATCH):
            part = chosen[at : at + BATCH]
            used, ids = np.unique(windows[part], return_inverse=True)
            ids = ids.reshape(len(part), WINDOW) + (used[0] != 0)
            used = used[used > 0] - 1
            x = np.concatenate([np.zeros((1, INPUTS), np.float32), net.inputs([vocabulary[i] for i in used])])
            logits, run = net.forward(net.projected(x), ids, keep=True)
            grads, d_gates = net.gradients(ids, toxic[of_doc[part]], logits, run)
            flat = d_gates.reshape(-1, 6 * h)
            by_word = np.zeros((len(x), 6 * h), np.float32)
            _sum_by(ids.ravel(), flat, by_word)
            grads["W"], grads["b"] = x.T @ by_word, flat.sum(axis=0)
            dx = (by_word @ net.weights["W"].T)[1:]
            d_table = np.zeros_like(net.table)
            _sum_by(word_row[used], dx, d_table)
            count = sizes[used]
            ranges = np.repeat(edges[used] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            spread = np.repeat(dx / np.sqrt(count).astype(np.float32)[:, None], count, axis=0)
            _sum_by(len(kept) + 1 + rows[ranges], spread, d_table)
            d_table[fixed] = 0
            adam.step += 1
            adam.update("table", net.table, d_table)
            for name, value in net.weights.items():
                adam.update(name, value, grads[name])
        epoch += 1
    _calibrate(net, gates_of_all(), windows, of_doc, held, toxic)
    if share is not None:
        net.shift += _logit(share) - _logit(net.prior)
        net.prior = share
    return net


def _calibrate(net: Network, gates: Gates, windows: np.ndarray, of_doc: np.ndarray, held: np.ndarray, toxic: np.ndarray) -> None:
    """Fit scale and shift of the highest logit on the documents left out of training."""
    top = np.full(len(toxic), -np.inf)
    for i in range(0, len(windows), SCORED):
        np.maximum.at(top, of_doc[i : i + SCORED], net.scores(gates, windows[i : i + SCORED]))
    use = np.isfinite(top) & held
    x, y = top[use], toxic[use]
    net.prior = float(toxic.mean())
    if len(set(y.tolist())) < 2:
        return
    scale, shift = 1.0, 0.0
    for _ in range(500):
        error = _sigmoid(scale * x + shift) - y
        scale -= 0.05 * ((error * x).mean() + 1e-3 * (scale - 1))
        shift -= 0.05 * (error.mean() + 1e-3 * shift)
    net.scale, net.shift = float(max(scale, 0.1)), float(shift)


# ---- scoring -------------------------------------------------------------


class Scorer:
    """Scores texts with a network; keeps the projected inputs of words it has met."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.gates = self.net.projected(np.zeros((1, INPUTS), np.float32))

    def numbers(self, words: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.clear()
        new = list(dict.fromkeys(w for of_text in words for w in of_text if w not in self.known))
        if new:
            self.known.update(zip(new, range(len(self.known) + 1, len(self.known) + 1 + len(new))))
            plain = [w.strip(_EDGES) or w for w in new]
            more = self.net.projected(self.net.inputs(plain))
            self.gates = tuple(np.concatenate(pair) for pair in zip(self.gates, more))
        return [np.fromiter(map(self.known.__getitem__, w), np.int64, len(w)) for w in words]

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        top = np.full(len(texts), -np.inf)
        for a, b in chunks(texts):
            words = self.numbers([t.lower().split() for t in texts[a:b]])
            flat = np.concatenate([*words, np.zeros(WINDOW, np.int64)])
            begins = np.cumsum([0, *map(len, words)])
            starts = [window_starts(len(w)) for w in words]
            owner = np.repeat(np.arange(len(words)), [len(s) for s in starts])
            first = np.array([s for of_text in starts for s in of_text], np.int64)
            for i in range(0, len(owner), SCORED):
                own = owner[i : i + SCORED]
                place = first[i : i + SCORED, None] + np.arange(WINDOW)
                inside = place < (begins[own + 1] - begins[own])[:, None]
                ids = np.where(inside, flat[begins[own][:, None] + np.where(inside, place, 0)], 0)
                np.maximum.at(top, a + own, self.net.scores(self.gates, ids))
        return np.where(np.isfinite(top), self.net.probability(np.where(np.isfinite(top), top, 0.0)), self.net.prior)


def held_out(id_col: str) -> Column:
    """Whether a row is left out of training; rows without id are."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def usable_labels(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Texts that may be trained on, and the distinct ones with a label, without the text."""
    marked = (
        labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col(id_col).alias("labelled"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    usable = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).where(
        ~held_out("id") & (F.octet_length("text") <= SAMPLE_BYTES)
    )
    usable = usable.withColumn("hash", F.xxhash64("text"))
    # texts stay out of the join with the labels
    rows = usable.select("id", "hash").distinct().join(marked, F.col("id") == F.col("labelled"))
    return usable, rows.select(F.xxhash64("id", "hash").alias("place"), "id", "hash", "toxic")


def labelled_sample(usable: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """At most ``size`` texts of either label, the first by a hash of id and text.

    Only rows below a cut are sorted, so no task gets ``size`` rows from every partition.
    """
    first = [lowest_by_hash(rows.where(F.col("toxic") == label), "place", size) for label in (1, 0)]
    # at most twice ``size`` rows are fetched
    chosen = F.broadcast(first[0].union(first[1]))
    return usable.join(chosen, ["id", "hash"]).groupBy("id", "hash", "place", "toxic").agg(
        F.first("text").cast("binary").alias("text")
    )


def _fitted(prior: float):
    """The network from the whole sample; ``prior`` is the share of toxic documents in all rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(row for frame in batches for row in zip(frame["place"], frame["text"], frame["toxic"]))
        toxic = np.array([label for _, _, label in rows])
        both = len(set(toxic.tolist())) == 2
        net = train([text for _, text, _ in rows], toxic, share=prior) if both else None
        yield pd.DataFrame([(pickle.dumps(net),)], columns=["net"])

    return run


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` from 0 to 1 and ``predicted``."""
    usable, rows = usable_labels(docs, labels, id_col, text_col)
    prior = rows.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
    chosen = labelled_sample(usable, rows, sample).coalesce(1)
    fitted = chosen.mapInPandas(_fitted(prior), "net binary").first()
    shared = docs.sparkSession.sparkContext.broadcast(bytes(fitted.net) if fitted else pickle.dumps(None))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = pickle.loads(shared.value)
        scorer = Scorer(net) if net else None
        for series in batches:
            yield pd.Series(scorer(list(series)) if scorer else np.full(len(series), prior))

    scored = docs.select(
        F.col(id_col), held_out(id_col).alias("held_out"), score(text_or_empty(text_col).cast("binary")).alias("score")
    )
    return scored.select("*", (F.col("score") >= CUT).cast("int").alias("predicted"))
