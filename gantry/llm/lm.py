"""Language-model scores: a word unigram baseline and a causal self-attention model.

Both learn from all documents but the held-out ones. The baseline counts words. The model
reads subword ids of a public vocabulary. Its output is a class of subwords (of about
equal frequency, the frequent ones alone in theirs; those that begin a word apart from
those that go on), predicted by one layer of causal self-attention with a learned bias for
distance, on top of the class frequencies after the last subword. Within its class a
subword has its frequency, after the last letter if it goes on a word. Classes and
frequencies are counted over all training text. The weights of the attention are trained
in numpy on windows that hold every subword of every training document: shards of windows
are trained side by side from common weights, and the results are averaged, ``ROUNDS`` times.

Texts are scored in windows of ``WINDOW`` inputs that overlap by ``WINDOW - STRIDE``;
each subword is scored once, in the first window that holds it.

Words that make up more than 1 / ``FREQUENT`` of the training tokens, fewer than
``FREQUENT`` by that definition, are broadcast. All others are looked up by a join.

Cases: a null text is empty and consists of its end; a null id counts as held out; equal
rows get equal scores; without training text every count is 0 and the model is untrained;
an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import base64
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache
from itertools import islice, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import chunks, text_or_empty
from gantry.sources.scratch import staged, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokenisation of that vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# ---- fixed values of the contract ----
HELD_OUT_MODULUS = 10
SMOOTHING = 0.1
# --------------------------------------

FREQUENT = 1 << 17
CLASSES = 64
#: Weight, in occurrences, of the general frequencies against those in a context.
BACKOFF = 10.0
#: Rows of the input embedding: the most frequent subwords; rarer ones share them by number.
INPUT_ROWS = 4096
WIDTH, KEY_WIDTH = 16, 8
WINDOW, STRIDE = 48, 32
SHARD_WINDOWS = 6000
ROUNDS, BATCH, RATE = 2, 64, 0.01
#: Windows scored and bytes of text prepared at a time; words and counts held while a task runs.
SCORED, CHUNK, REMEMBERED, COUNTED = 512, 1 << 20, 200_000, 300_000

# ---- subwords ------------------------------------------------------------

_encoders: dict = {}


def encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


#: White space other than the plain space. The pre-tokeniser takes a run of it and of spaces together.
_OTHER_SPACE = re.compile(r"[^\S ]")


def encoded_words(path: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The subwords of all words, and where each word begins and the last one ends.

    A space stands before every word, so a word has the same subwords wherever it stands, and
    the subwords with a space tell the words apart. Words with white space of another kind,
    such as no-break spaces, would run together and are encoded one by one.
    """
    text = (b" " + b" ".join(words)).decode(errors="replace") if words else ""
    if _OTHER_SPACE.search(text):
        return _encoded_apart(path, [w.decode(errors="replace") for w in words])
    ids = encoder(path).encode_to_numpy(text, disallowed_special=()).astype(np.int32)
    begins, _ = vocabulary_facts(path)
    edges = np.r_[np.flatnonzero(begins[ids]), len(ids)]
    assert len(edges) == len(words) + 1
    return ids, edges


def _encoded_apart(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`encoded_words` where some words hold other white space."""
    odd = np.array([_OTHER_SPACE.search(w) is not None for w in words])
    alone = [encoder(path).encode_ordinary(" " + words[i]) for i in np.flatnonzero(odd)]
    ids, edges = encoded_words(path, [words[i].encode() for i in np.flatnonzero(~odd)])
    sizes = np.zeros(len(words), np.int64)
    sizes[odd], sizes[~odd] = [len(a) for a in alone], np.diff(edges)
    of_odd = np.repeat(odd, sizes)
    out = np.empty(len(of_odd), np.int32)
    out[of_odd], out[~of_odd] = np.concatenate([np.array(a, np.int32) for a in alone]), ids
    return out, np.r_[0, np.cumsum(sizes)]


class _Numbers(dict):
    """Numbers of words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Subwords:
    """Subwords of texts; those of words met before are kept while a task runs.

    ``logs`` has a value for some words; :meth:`of` gives those too (NaN: none).
    """

    def __init__(self, path: str, logs: dict[bytes, float] | None = None):
        self.path = path
        self.logs = logs or {}
        #: The free id after the vocabulary stands for the end of a text.
        self.end = encoder(path).max_token_value + 1
        self.empty()

    def empty(self) -> None:
        self.known = _Numbers()
        self.flat, self.edges, self.values = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0)

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The subwords of all texts, each with its end, where the texts end, and the words' logs."""
        if len(self.known) > REMEMBERED:
            self.empty()
        words = [w for of_text in texts for w in of_text]
        n_known = len(self.known)
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > n_known:
            new = list(islice(self.known, n_known, None))
            ids, edges = encoded_words(self.path, new)
            self.edges = np.r_[self.edges, edges[1:] + len(self.flat)]
            self.flat = np.r_[self.flat, ids]
            found = np.fromiter(map(self.logs.get, new, repeat(math.nan)), np.float64, len(new))
            self.values = np.r_[self.values, found]
        sizes = (self.edges[1:] - self.edges[:-1])[numbers]
        word_ends = np.r_[0, np.cumsum(sizes)]
        within = np.arange(word_ends[-1]) - np.repeat(word_ends[:-1], sizes)
        ids = self.flat[np.repeat(self.edges[numbers], sizes) + within].astype(np.int64)
        text_ends = word_ends[np.cumsum([len(t) for t in texts], dtype=np.int64)]
        ids = np.insert(ids, text_ends, self.end)
        return ids, text_ends + np.arange(1, len(texts) + 1), self.values[numbers]


@cache
def vocabulary_facts(path: str) -> tuple[np.ndarray, np.ndarray]:
    """For each subword and the end of a text: whether it begins a word, and the context it leaves.

    The context is the last letter, or the last byte of a longer code point, or another byte.
    """
    source = encoder(path)
    pieces = [source.decode_single_token_bytes(i) for i in range(source.max_token_value + 1)]
    begins = np.array([*(p[:1] == b" " for p in pieces), True])
    last = np.array([*(p[-1] for p in pieces), 0])
    context = np.where((last >= 97) & (last <= 122), last - 97, np.where((last & 0xC0) == 0x80, 26 + (last & 63), 90))
    return begins, context


#: Contexts of :func:`vocabulary_facts`, and one for subwords that begin a word.
CONTEXTS = 92


# ---- the model -----------------------------------------------------------


@dataclass
class Model:
    row: np.ndarray  # input row of each subword; row 0 stands for the start of a text
    of_class: np.ndarray  # class of each subword
    begins: np.ndarray  # whether it begins a word
    context: np.ndarray  # the context it leaves for the next
    within: np.ndarray | None  # by context and subword, log10 of its probability within its class
    after: np.ndarray  # by input row and class, log of the class frequency after that row
    weights: dict[str, np.ndarray]

    def inputs(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """What the model reads at each place: the subword before, or the start of the text."""
        rows = np.r_[0, self.row[ids[:-1]]]
        rows[ends[:-1]] = 0
        return rows

    def within_class(self, ids: np.ndarray) -> np.ndarray:
        context = np.where(self.begins[ids], CONTEXTS - 1, np.r_[0, self.context[ids[:-1]]])
        return self.within[context, ids]


def classes_of(counts: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and input row of each subword, from its count."""
    of_class = np.empty(len(counts), np.int64)
    used = 0
    for kind in (True, False):
        members = np.flatnonzero(begins == kind)
        by_count = members[np.argsort(-counts[members], kind="stable")]
        smoothed = counts[by_count] + 0.5
        reached = (np.cumsum(smoothed) - smoothed / 2) / smoothed.sum()
        # equal shares, renumbered because a frequent subword can fill several
        numbers = np.unique((reached * (CLASSES // 2)).astype(np.int64), return_inverse=True)[1]
        of_class[by_count] = used + numbers
        used += numbers.max() + 1
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return of_class, 1 + np.where(rank < INPUT_ROWS - 1, rank, rank % (INPUT_ROWS - 1))


def new_model(counts, in_context, after, begins, context, of_class, row, seed: int = 11) -> Model:
    """An untrained model from the counts of subwords, by context, and of classes after rows."""
    rng = np.random.default_rng(seed)
    n_classes = int(of_class.max()) + 1
    mass = np.bincount(of_class, counts + 0.5)
    general = (counts + 0.5) / mass[of_class]
    in_context = in_context + BACKOFF * general
    by_class = np.zeros((CONTEXTS, n_classes))
    for c in range(CONTEXTS):
        by_class[c] = np.bincount(of_class, in_context[c], minlength=n_classes)
    within = np.log10(in_context / by_class[:, of_class]).astype(np.float32)
    after = after + BACKOFF * mass / mass.sum()
    after = np.log(after / after.sum(axis=1, keepdims=True)).astype(np.float32)
    start = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    weights = {
        "E": start(0.3, INPUT_ROWS, WIDTH),
        "Wq": start(0.2, WIDTH, KEY_WIDTH),
        "Wk": start(0.2, WIDTH, KEY_WIDTH),
        "Wv": start(0.2, WIDTH, WIDTH),
        "r": np.zeros(WINDOW, np.float32),
        "Wo": np.zeros((WIDTH, n_classes), np.float32),
    }
    return Model(row, of_class, begins, context, within, after, weights)


_DISTANCE = np.arange(WINDOW)[:, None] - np.arange(WINDOW)


def _bias(weights: dict) -> np.ndarray:
    return np.where(_DISTANCE >= 0, weights["r"][np.maximum(_DISTANCE, 0)], np.float32(-1e9)).astype(np.float32)


#: Classes are filled up to a multiple of this with classes that never occur; products are much faster so.
LANES = 16
#: Scores up to here have exponentials that neither overflow nor vanish, nor do sums of them.
SAFE = 60.0


def _filled_up(values: np.ndarray, fill: float) -> np.ndarray:
    """The columns of classes, and columns of ``fill`` up to a multiple of ``LANES``."""
    out = np.full((len(values), -(-values.shape[1] // LANES) * LANES), fill, values.dtype)
    out[:, : values.shape[1]] = values
    return out


class Parameters:
    """Weights, or something for each of them, as one array ``flat`` with views of its parts.

    Queries, keys and values are columns of one matrix; classes are filled up.
    """

    def __init__(self, weights: dict):
        projections = np.concatenate([weights[name] for name in ("Wq", "Wk", "Wv")], axis=1)
        parts = [weights["E"], projections, weights["r"], _filled_up(weights["Wo"], 0)]
        self.shapes, self.n_classes = [p.shape for p in parts], weights["Wo"].shape[1]
        self._view(np.concatenate([p.ravel() for p in parts]))

    def _view(self, flat: np.ndarray) -> None:
        self.flat = flat
        edges = np.cumsum([0, *(math.prod(shape) for shape in self.shapes)]).tolist()
        parts = [flat[a:b].reshape(shape) for shape, a, b in zip(self.shapes, edges, edges[1:])]
        self.rows, self.projections, self.bias, self.out = parts

    def zeros(self) -> Parameters:
        other = object.__new__(Parameters)
        other.shapes, other.n_classes = self.shapes, self.n_classes
        other._view(np.zeros_like(self.flat))
        return other

    def weights(self) -> dict:
        q, k, v = np.split(self.projections, [KEY_WIDTH, 2 * KEY_WIDTH], axis=1)
        return {"E": self.rows, "Wq": q, "Wk": k, "Wv": v, "r": self.bias, "Wo": self.out[:, : self.n_classes]}


_PROJECTED = 2 * KEY_WIDTH + WIDTH
_SCALE = np.repeat(np.float32([1 / math.sqrt(KEY_WIDTH), 1]), [KEY_WIDTH, KEY_WIDTH + WIDTH])
_AT_DISTANCE = np.maximum(_DISTANCE, 0).ravel()


def _joined(y: np.ndarray) -> np.ndarray:
    """The windows of a batch one below the other."""
    return y.reshape(-1, y.shape[-1])


class Batch:
    """Log loss of batches of ``n`` windows and its gradients, in arrays that are made once.

    Softmaxes stay unnormalised: a column of ones gives their sums, by which the narrow
    sides of products are divided. ``after`` has as many columns as classes filled up.
    """

    def __init__(self, n: int, n_classes: int, kind: np.dtype):
        new = lambda *shape: np.empty((n, WINDOW, *shape), kind)
        self.x, self.pooled, self.h, self.dx, self.wide = (new(WIDTH) for _ in range(5))
        self.projected, self.d_projected = np.ones((n, WINDOW, _PROJECTED + 8), kind), new(_PROJECTED)
        self.s, self.ds, self.sums, self.dz = new(WINDOW), new(WINDOW), new(WIDTH + 1), new(WIDTH + 1)
        self.after, self.p = (np.empty((n * WINDOW, n_classes), kind) for _ in range(2))
        self.ones = np.ones(n_classes, kind)

    def gradients(
        self, w: Parameters, after: np.ndarray, rows: np.ndarray, targets: np.ndarray, into: Parameters
    ) -> tuple[np.ndarray, np.ndarray]:
        """Puts the gradients into zeros or earlier ones. Gives the places with a target and the
        probability of each target."""
        x, h, s, p = self.x, self.h, self.s, self.p
        np.take(w.rows, rows, axis=0, out=x, mode="clip")
        scale = _SCALE.astype(x.dtype)
        projections = w.projections * scale
        np.matmul(_joined(x), projections, out=_joined(self.projected)[:, :_PROJECTED])
        q, k = self.projected[:, :, :KEY_WIDTH], self.projected[:, :, KEY_WIDTH : 2 * KEY_WIDTH]
        v_and_one = self.projected[:, :, 2 * KEY_WIDTH : _PROJECTED + 1]

        np.matmul(q, k.transpose(0, 2, 1), out=s)
        largest = max(s.max(), -s.min()) + np.abs(w.bias).max()
        s += _bias({"r": w.bias}).astype(x.dtype, copy=False)
        if not largest < SAFE:
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        np.matmul(s, v_and_one, out=self.sums)
        inverse = 1 / self.sums[:, :, WIDTH:]
        np.multiply(self.sums[:, :, :WIDTH], inverse, out=self.pooled)
        np.tanh(np.add(x, self.pooled, out=h), out=h)

        places, targets = rows.ravel(), targets.ravel()
        of_h, dx, wide = _joined(h), _joined(self.dx), _joined(self.wide)
        np.matmul(of_h, w.out, out=p)
        used = targets >= 0
        targets = np.where(used, targets, 0)
        p += np.take(after, places, axis=0, out=self.after, mode="clip")
        # tanh is below 1, which bounds what the attention adds
        if not np.abs(w.out).sum(axis=0).max() < SAFE:
            p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        total = p @ self.ones
        at = np.arange(0, p.size, p.shape[1]) + targets
        right = p.ravel()[at]
        p.ravel()[at] = right - total
        weight = (used / (total * max(1, int(used.sum())))).astype(x.dtype)[:, None]
        np.matmul(np.multiply(of_h, weight, out=wide).T, p, out=into.out)
        np.matmul(p, w.out.T, out=dx)
        dx *= weight
        np.multiply(h, h, out=h)
        np.subtract(1, h, out=h)
        dx *= of_h

        dz, ds, d = self.dz, self.ds, self.d_projected
        np.multiply(self.dx, inverse, out=dz[:, :, :WIDTH])
        np.einsum("ijk,ijk->ij", dz[:, :, :WIDTH], self.pooled, out=dz[:, :, WIDTH])
        np.negative(dz[:, :, WIDTH], out=dz[:, :, WIDTH])
        np.matmul(dz, v_and_one.transpose(0, 2, 1), out=ds)
        ds *= s
        np.matmul(ds, k, out=d[:, :, :KEY_WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, KEY_WIDTH : 2 * KEY_WIDTH])
        np.matmul(s.transpose(0, 2, 1), dz[:, :, :WIDTH], out=d[:, :, 2 * KEY_WIDTH :])
        into.bias[:] = np.bincount(_AT_DISTANCE, ds.sum(axis=0).ravel(), minlength=WINDOW)
        np.matmul(_joined(x).T, _joined(d), out=into.projections)
        into.projections *= scale
        dx += np.matmul(_joined(d), projections.T, out=wide)

        order = np.argsort(places, kind="stable")
        ordered = places[order]
        first = np.concatenate([[0], 1 + np.flatnonzero(ordered[1:] != ordered[:-1])])
        into.rows[:] = 0
        into.rows[ordered[first]] = np.add.reduceat(np.take(dx, order, axis=0, out=wide, mode="clip"), first, axis=0)
        return used, right / total


def step(weights: dict, after: np.ndarray, rows: np.ndarray, targets: np.ndarray) -> tuple[float, dict]:
    """Mean log loss of the target classes (-1: none) of a batch of windows, and its gradients."""
    w = Parameters(weights)
    grads = w.zeros()
    batch = Batch(len(rows), w.out.shape[1], w.flat.dtype)
    after = _filled_up(after, -1e9).astype(w.flat.dtype, copy=False)
    used, p = batch.gradients(w, after, rows, targets, grads)
    return float(-np.log(p[used] + 1e-30).sum() / max(1, int(used.sum()))), grads.weights()


def train_shard(weights: dict, after: np.ndarray, rows: np.ndarray, targets: np.ndarray) -> dict:
    """Weights after one pass of Adam over the windows of a shard.

    Input rows that the shard has not keep their weights, so only the others are worked on.
    """
    met = np.unique(rows)
    # numbers of two bytes are sorted by radix
    number = np.zeros(len(weights["E"]), np.min_scalar_type(len(met)))
    number[met] = np.arange(len(met))
    rows, after = number[rows], _filled_up(after[met], -1e9)
    w = Parameters({**weights, "E": weights["E"][met]})
    grads, mean, square, change = w.zeros(), np.zeros_like(w.flat), np.zeros_like(w.flat), np.empty_like(w.flat)
    n_steps = -(-len(rows) // BATCH)
    batch = None
    for t in range(1, n_steps + 1):
        part = slice((t - 1) * BATCH, t * BATCH)
        if batch is None or len(rows[part]) < BATCH:
            batch = Batch(len(rows[part]), w.out.shape[1], w.flat.dtype)
        batch.gradients(w, after, rows[part], targets[part], grads)
        rate = RATE * (1 - 0.9 * (t - 1) / n_steps) * math.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        np.subtract(grads.flat, mean, out=change)
        change *= 0.1
        mean += change
        np.multiply(grads.flat, grads.flat, out=change)
        change -= square
        change *= 0.01
        square += change
        np.sqrt(square, out=change)
        change += 1e-8
        np.divide(mean, change, out=change)
        change *= rate
        w.flat -= change
    every = weights["E"].copy()
    every[met] = w.rows
    return {**w.weights(), "E": every}


class Scorer:
    """log10 probabilities of texts. Queries, keys and values are tables by input row."""

    def __init__(self, model: Model):
        self.model, w = model, model.weights
        scale = np.float32(1 / math.sqrt(KEY_WIDTH))
        self.query, self.key, self.value = w["E"] @ w["Wq"] * scale, w["E"] @ w["Wk"], w["E"] @ w["Wv"]
        self.bias = _bias(w)
        norm = lambda t: float(np.sqrt((t * t).sum(axis=1)).max())
        bound = norm(self.query) * norm(self.key) + float(np.abs(w["r"]).max())
        self.safe = bound < 60  # the exponential of a score cannot overflow

    def windows(self, rows: np.ndarray, classes: np.ndarray, first: int) -> np.ndarray:
        """Natural logs of the target classes at the places from ``first`` on, for windows of input rows."""
        w = self.model.weights
        asked = rows[:, first:]
        s = np.matmul(np.take(self.query, asked, axis=0), np.take(self.key, rows, axis=0).transpose(0, 2, 1))
        s += self.bias[first:]
        if not self.safe:
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        pooled = np.matmul(s, np.take(self.value, rows, axis=0))
        pooled /= s.sum(axis=2, keepdims=True)
        pooled += np.take(w["E"], asked, axis=0)
        np.tanh(pooled, out=pooled)
        logits = pooled.reshape(-1, WIDTH) @ w["Wo"]
        logits += np.take(self.model.after, asked.ravel(), axis=0)
        target = logits[np.arange(len(logits)), classes[:, first:].ravel()]
        # |pooled| < 1, so logits are bounded by the weights
        np.exp(logits, out=logits)
        return (target - np.log(logits.sum(axis=1))).reshape(len(rows), -1)

    def __call__(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        model = self.model
        begins = np.r_[0, ends[:-1]]
        sizes = ends - begins
        inputs = np.r_[model.inputs(ids, ends), np.zeros(WINDOW, np.int64)]
        classes = np.r_[model.of_class[ids], np.zeros(WINDOW, np.int64)]
        logs = np.zeros(len(inputs))
        later = -(-np.maximum(sizes - WINDOW, 0) // STRIDE)
        starts = np.repeat(begins, later) + STRIDE * (
            1 + np.arange(int(later.sum())) - np.repeat(np.cumsum(later) - later, later)
        )
        for of_kind, stops, first in ((begins, ends, 0), (starts, np.repeat(ends, later), WINDOW - STRIDE)):
            for i in range(0, len(of_kind), SCORED):
                place = of_kind[i : i + SCORED, None] + np.arange(WINDOW)
                found = self.windows(inputs[place], classes[place], first)
                place = place[:, first:]
                own = place < stops[i : i + SCORED, None]
                logs[place[own]] = found[own]
        return logs


def text_scores(scorer: Scorer, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log10 probability of each text."""
    total = np.r_[0, np.cumsum(scorer(ids, ends)[: len(ids)] / math.log(10) + scorer.model.within_class(ids))]
    return total[ends] - total[np.r_[0, ends[:-1]]]


# ---- passes over the corpus ----------------------------------------------


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT_MODULUS == 0, F.lit(True))


def _split(texts: list[bytes]) -> list[list[bytes]]:
    return [t.lower().split() for t in texts]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for frame in batches:
        texts = frame["text"].tolist()
        for a, b in chunks(texts):
            for words in _split(texts[a:b]):
                counts.update(words)
            if len(counts) > COUNTED:
                yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                counts.clear()
    if counts:
        yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})


def _encoded(vocabulary: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            ids, edges = encoded_words(vocabulary, frame["word"].tolist())
            cut = [ids[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            yield pd.DataFrame({"n": frame["n"], "ids": cut})

    return run


def _flat(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subwords of encoded words, each with its word's count, and which are the first of their word."""
    sizes = frame["ids"].map(len).to_numpy(np.int64) // 4
    ids = np.frombuffer(b"".join(frame["ids"]), np.int32).astype(np.int64)
    first = np.zeros(len(ids), bool)
    first[np.cumsum(sizes) - sizes] = True
    return ids, np.repeat(frame["n"].to_numpy(np.float64), sizes), first


def _tally(keys_of, size: int):
    """Sums of counts by the keys that ``keys_of`` finds in a frame of encoded words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for frame in batches:
            keys, counts = keys_of(frame)
            np.add.at(total, keys, counts)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"key": used, "n": total[used].astype(np.int64)})

    return run


def _tallied(words: DataFrame, keys_of, size: int) -> np.ndarray:
    """The sums over all words, as an array of ``size``, which bounds what the driver gets."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            pair = (frame["key"].to_numpy(np.int64).tobytes(), frame["n"].to_numpy(np.int64).tobytes())
            yield pd.DataFrame([pair], columns=["keys", "counts"])

    total = np.zeros(size)
    sums = words.mapInPandas(_tally(keys_of, size), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    for r in sums.mapInPandas(packed, "keys binary, counts binary").collect():
        total[np.frombuffer(r.keys, np.int64)] = np.frombuffer(r.counts, np.int64)
    return total


def counted_model(words: DataFrame, n_texts: int, vocabulary: str) -> Model:
    """The untrained model, from encoded words (``n``, ``ids``) and the number of texts."""
    begins, context = vocabulary_facts(vocabulary)
    size = len(begins)
    counts = _tallied(words, lambda frame: _flat(frame)[:2], size)
    counts[-1] = n_texts
    of_class, row = classes_of(counts, begins)
    n_classes = int(of_class.max()) + 1

    def contexts(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        ids, n, first = _flat(frame)
        return np.where(first, CONTEXTS - 1, np.r_[0, context[ids[:-1]]]) * size + ids, n

    def successors(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        ids, n, first = _flat(frame)
        # what follows in the word; after its last subword, some beginning (counted as one class more)
        last = np.r_[first[1:], True]
        following = np.where(last, n_classes, np.r_[of_class[ids[1:]], 0])
        return row[ids] * (n_classes + 1) + following, n

    in_context = _tallied(words, contexts, CONTEXTS * size).reshape(CONTEXTS, size)
    in_context[-1, -1] = n_texts
    found = _tallied(words, successors, (INPUT_ROWS + 1) * (n_classes + 1)).reshape(-1, n_classes + 1)[:INPUT_ROWS]
    beginnings = np.bincount(of_class, (counts + 1e-6) * begins, minlength=n_classes)
    beginnings /= beginnings.sum()
    after = found[:, :n_classes] + found[:, n_classes:] * beginnings
    after[0] += n_texts * beginnings
    return new_model(counts, in_context, after, begins, context, of_class, row)


def _id_type(model: Model) -> type:
    """Of the subword ids of stored windows."""
    return np.uint16 if len(model.row) <= 1 << 16 else np.int32


def _light(model: Model) -> Model:
    """Without the largest table, which training does not need; workers keep all they are sent."""
    return replace(model, within=None)


def _training_windows(vocabulary: str, shared):
    """Windows one after another through each text: the subword before (the end, at a text's
    start) and the subwords to predict."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind = _id_type(shared.value)
        subwords = Subwords(vocabulary)
        for frame in batches:
            texts = frame["text"].tolist()
            for a, b in chunks(texts, CHUNK):
                ids, ends, _ = subwords.of(_split(texts[a:b]))
                # every text ends with the end, so that stands before the next one too
                ids = np.r_[subwords.end, ids].astype(kind)
                begins = np.r_[0, ends[:-1]]
                found = [
                    ids[i : min(i + WINDOW, end) + 1].tobytes()
                    for begin, end in zip(begins.tolist(), ends.tolist())
                    for i in range(begin, end, WINDOW)
                ]
                yield pd.DataFrame({"ids": found})

    return run


def _rows_and_targets(windows: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Input rows and target classes (-1: none) of stored windows."""
    kind = _id_type(model)
    sizes = np.array([len(w) for w in windows]) // np.dtype(kind).itemsize
    ids = np.zeros((len(windows), WINDOW + 1), np.int64)
    place = np.arange(WINDOW + 1)
    ids[place < sizes[:, None]] = np.frombuffer(b"".join(windows), kind)
    used = place[1:] < sizes[:, None]
    rows = np.where(used, model.row[ids[:, :-1]], 0)
    rows[ids[:, 0] == len(model.row) - 1, 0] = 0
    return rows, np.where(used, model.of_class[ids[:, 1:]], -1)


def _train_shards(shared):
    """Sums of the weights that shards of at most ``SHARD_WINDOWS`` windows end with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        total, sums = 0, {name: np.zeros(value.shape) for name, value in model.weights.items()}
        waiting: list[bytes] = []

        def train(windows: list[bytes]) -> None:
            for name, value in train_shard(model.weights, model.after, *_rows_and_targets(windows, model)).items():
                sums[name] += len(windows) * value.astype(np.float64)

        for frame in batches:
            waiting += frame["ids"].tolist()
            while len(waiting) >= SHARD_WINDOWS:
                train(waiting[:SHARD_WINDOWS])
                total += SHARD_WINDOWS
                waiting = waiting[SHARD_WINDOWS:]
        if waiting:
            train(waiting)
            total += len(waiting)
        if total:
            yield pd.DataFrame([(total, np.concatenate([v.ravel() for v in sums.values()]).tobytes())], columns=["n", "sums"])

    return run


def _trained(windows: DataFrame, n_shards: int, model: Model) -> Model:
    """Rounds of training on shards and averaging, weighted by the windows of a shard."""
    context = windows.sparkSession.sparkContext
    within, model = model.within, _light(model)
    # equal windows fall in one partition only by chance, so many copies do not fill one
    dealt = F.xxhash64("ids", "nth")
    sharded = windows.withColumn("nth", F.monotonically_increasing_id()).repartition(n_shards, dealt)
    with staged(sharded.sortWithinPartitions(dealt).select("ids")) as sharded:
        for _ in range(ROUNDS):
            found = sharded.mapInPandas(_train_shards(context.broadcast(model)), "n long, sums binary").rdd
            sums = found.map(lambda r: (r.n, np.frombuffer(r.sums)))
            total, flat = sums.treeReduce(lambda x, y: (x[0] + y[0], x[1] + y[1]))
            edges = np.cumsum([0, *(value.size for value in model.weights.values())])
            weights = {
                name: (flat[a:b] / total).astype(np.float32).reshape(value.shape)
                for (name, value), a, b in zip(model.weights.items(), edges, edges[1:])
            }
            model = replace(model, weights=weights)
    return replace(model, within=within)


_SCORED = """id {id}, held_out boolean, n_tokens long, n_frequent long, base_frequent double,
             score double, rare array<struct<word: binary, n: int>>"""


def _score(vocabulary: str, shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, logs, end_log, end_known = shared.value
        scorer = Scorer(model)
        subwords = Subwords(vocabulary, logs)
        for frame in batches:
            texts = frame.pop("text").tolist()
            for a, b in chunks(texts, CHUNK):
                rows = []
                words = _split(texts[a:b])
                ids, ends, found = subwords.of(words)
                scores = text_scores(scorer, ids, ends).tolist()
                flat = [w for of_text in words for w in of_text]
                known = ~np.isnan(found)
                edges = np.cumsum([0, *map(len, words)])
                sums = np.r_[0, np.cumsum(np.where(known, found, 0))]
                counts = np.r_[0, np.cumsum(known)]
                unknown = np.flatnonzero(~known)
                places = np.searchsorted(unknown, edges)
                for i, score in enumerate(scores):
                    begin, end = edges[i], edges[i + 1]
                    rare = Counter(flat[j] for j in unknown[places[i] : places[i + 1]])
                    base = float(sums[end] - sums[begin]) + end_log
                    rows.append((end - begin + 1, int(counts[end] - counts[begin]) + end_known, base, score, list(rare.items())))
                names = ["n_tokens", "n_frequent", "base_frequent", "score", "rare"]
                part = frame.iloc[a:b]
                yield pd.concat([part, pd.DataFrame(rows, columns=names, index=part.index)], axis=1)

    return run


def language_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10 probabilities of the text)."""
    spark = docs.sparkSession
    context = spark.sparkContext
    texts = docs.select(
        F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).cast("binary").alias("text")
    )
    training = texts.where(~F.col("held_out"))
    counts = stored(
        training.select("text").mapInPandas(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    )
    n_ends = training.count()
    n_words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    train_tokens, vocabulary_size = n_words + n_ends, distinct + (n_ends > 0)
    whole = train_tokens + SMOOTHING * (vocabulary_size + 1)

    def log_of(n: float) -> float:
        return math.log10((n + SMOOTHING) / whole)

    frequent = F.col("n") > train_tokens / FREQUENT
    logs = {bytes(r.word): log_of(r.n) for r in counts.where(frequent).collect()}

    words = stored(counts.mapInPandas(_encoded(vocabulary), "n long, ids binary"))
    model = counted_model(words, n_ends, vocabulary)
    if n_ends:
        windows = training.select("text").mapInPandas(_training_windows(vocabulary, context.broadcast(_light(model))), "ids binary")
        # as many as whole windows would fill; the last one of each text may be shorter
        n_subwords = words.agg(F.coalesce(F.sum(F.col("n") * F.octet_length("ids") / 4), F.lit(0.0))).first()[0]
        model = _trained(windows, max(1, round((n_subwords / WINDOW + n_ends) / SHARD_WINDOWS)), model)

    shared = context.broadcast((model, logs, log_of(n_ends), int(n_ends > 0)))
    schema = _SCORED.format(id=texts.schema["id"].dataType.simpleString())
    scored = stored(texts.mapInPandas(_score(vocabulary, shared), schema).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rare").alias("token")).select("row", F.col("token.word").alias("word"), F.col("token.n").alias("times"))
    looked_up = rare.join(counts.where(~frequent), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    of_rare = looked_up.groupBy(F.col("row").alias("of_row")).agg(
        F.sum(F.col("times") * F.log10((F.col("n") + SMOOTHING) / whole)).alias("base_rare"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
    )
    joined = scored.drop("rare").join(of_rare, F.col("row") == F.col("of_row"), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_frequent") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"),
        "score",
    )
