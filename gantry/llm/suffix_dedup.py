"""Removal of long repeated byte strings, anywhere in the corpus.

Every ``length``-byte window of a text belongs to the smallest hash of a short gram in
it. Equal windows have equal smallest hashes, so the windows split into groups that can
be searched one by one; a run of neighbouring windows of one group is cut out as a piece
of the text. Equal pieces are counted, not compared: a key with one piece only is unique
(unless the text of the piece is periodic), and all windows of a piece that occurs twice
are repeated.

Pieces that share a key without being equal hold the ends of repeated passages. They are
written one after another, each closed by a symbol of its own, and a suffix array and its
Burrows-Wheeler transform are built. Starting from the interval of all suffixes, breadth
first backward extension finds the boundaries between suffixes in the order of their
common prefix: all boundaries of 0, of 1, and so on, stopping at ``length``. Boundaries
not reached by then separate suffixes that share ``length`` bytes or more.

A key with more than ``GROUP`` different pieces (the end of a passage quoted by very many
documents) is not searched in one task: its windows are counted one by one instead.

Cases: a null text is empty; texts shorter than ``length`` are kept whole; equal texts of
at least ``length`` bytes remove each other whole, whatever their ids; matches do not
cross documents; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import chunks, free_name, mixed, text_or_empty
from gantry.llm.suffix import covered, suffix_order
from gantry.sources.scratch import staged, stored

LENGTH = 200
GRAM = 32
#: Most windows in a piece; only periodic text has longer runs.
MAX_RUN = 256
GROUP = 4096
#: Bytes of text cut into pieces at a time, and of pieces in one suffix array (more if a
#: single text or key has more).
CUT_BYTES, ARRAY_BYTES = 1 << 18, 1 << 19

#: Low bits of a hash that give way to a place in the chunk; no text has more than 2 ** 31 bytes.
PLACE_BITS = np.uint64(32)

# ---- pieces --------------------------------------------------------------


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` = 32 bytes at each place; the last 31 places have none."""
    values = raw.astype(np.uint64)
    for step in (1, 2, 4):
        values = values[:-step] | (values[step:] << np.uint64(8 * step))
    for step in (8, 16):
        values = mixed(values)
        values = values[:-step] * np.uint64(0x9E3779B97F4A7C15) + values[step:]
    return mixed(values)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def text_pieces(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Key, text number, first byte and number of bytes of each piece, hash of its bytes,
    and whether its key is the hash of more than one gram of the piece."""
    raw = b"".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.sum():
        return (np.zeros(0, np.int64),) * 6
    grams = gram_hashes(np.frombuffer(raw, np.uint8))
    width = length - GRAM + 1
    # a place in the low bits makes the least value name the first, or the last, smallest gram;
    # ties in the bits that remain are settled by the place, alike in equal windows, whatever
    # the chunk they are in: the number of bits is the same for all chunks
    bits = PLACE_BITS
    high = (grams >> bits) << bits
    numbers = np.arange(len(grams), dtype=np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    leftmost = (sliding_minimum(high | numbers, width) & low).astype(np.int64)
    rightmost = low - (sliding_minimum(high | (low - numbers), width) & low)
    owner = np.repeat(np.arange(len(texts)), windows)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    key = grams[leftmost[begins[owner] + nth]]
    starts_run = np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]
    run_start = np.maximum.accumulate(np.where(starts_run, np.arange(len(key)), 0))
    cut = np.flatnonzero((np.arange(len(key)) - run_start) % MAX_RUN == 0)
    count = np.diff(np.r_[cut, len(key)]) + length - 1
    owner, nth = owner[cut], nth[cut]
    place = begins[owner] + nth
    twice = leftmost[place] != rightmost[place + count - length].astype(np.int64)
    at = place.tolist()
    view = memoryview(raw)
    hashes = [xxhash.xxh3_64_intdigest(view[a : a + c]) for a, c in zip(at, count.tolist())]
    return key[cut].view(np.int64), owner, nth, count, np.array(hashes, np.uint64).view(np.int64), twice


def _cut_pieces(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            texts = frame["text"].tolist()
            t1, t2 = frame["t1"].to_numpy(), frame["t2"].to_numpy()
            for a, b in chunks(texts, CUT_BYTES):
                key, owner, start, size, digest, twice = text_pieces(texts[a:b], length)
                columns = {"key": key, "digest": digest, "t1": t1[a + owner], "t2": t2[a + owner]}
                yield pd.DataFrame(columns | {"start": start, "size": size, "twice": twice.astype(bool)})

    return run


# ---- the search in a suffix array ----------------------------------------


def repeated_starts(symbols: np.ndarray, length: int) -> np.ndarray:
    """Which positions start a string of ``length`` symbols that also starts elsewhere.

    ``symbols`` ends in a symbol that occurs once.
    """
    n = len(symbols)
    symbols = symbols.astype(np.int32)
    order = suffix_order(symbols)
    transform = symbols[order - 1]
    back = np.empty(n, np.int32)  # rank of the suffix one symbol longer to the left
    back[np.argsort(transform, kind="stable")] = np.arange(n, dtype=np.int32)
    first_symbol = symbols[order]
    table, marked = np.empty(n, np.int32), np.zeros(n, bool)
    found = np.zeros(n + 1, bool)  # boundary before a rank: its common prefix is known
    found[[0, n]] = True
    lower, upper = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(lower):
            break
        sizes = upper - lower
        interval = np.repeat(np.arange(len(lower), dtype=np.int32), sizes)
        ranks = np.arange(len(interval)) + np.repeat(lower - (np.cumsum(sizes) - sizes), sizes)
        to = back[ranks]
        # by rank; many are sorted by marking them in a table of all ranks
        if 50 * len(to) > n:
            table[to] = interval
            marked[to] = True
            to = np.flatnonzero(marked)
            interval = table[to]
            marked[to] = False
        else:
            by_rank = np.argsort(to, kind="stable")
            to, interval = to[by_rank], interval[by_rank]
        symbol = first_symbol[to]
        first = np.flatnonzero(np.r_[True, (interval[1:] != interval[:-1]) | (symbol[1:] != symbol[:-1])])
        lower = to[first]
        upper = to[np.r_[first[1:], len(to)] - 1] + 1
        # an interval goes on only if its upper boundary is new
        new = ~found[upper] | (upper == n) & (lower == 0)
        found[upper] = True
        lower, upper = lower[new], upper[new]
    alike = ~found[:n]
    repeated = np.zeros(n, bool)
    repeated[order[alike]] = True
    repeated[order[np.flatnonzero(alike) - 1]] = True
    return repeated


def promising(raw: bytes, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of the stretches of joined pieces that can hold repeated strings.

    All grams of a repeated string occur twice, so a piece is cut at grams that do not.
    """
    places = np.arange(len(raw))
    ends = np.repeat(np.cumsum(sizes), sizes)
    valid = places + GRAM <= ends
    grams = gram_hashes(np.frombuffer(raw, np.uint8))[valid[: len(raw) - GRAM + 1]]
    places, ends = places[valid], ends[valid]
    order = np.argsort(grams)
    alike = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(grams), bool)
    twice[order[1:]] |= alike
    twice[order[:-1]] |= alike
    places, ends = places[twice], ends[twice]
    first = np.flatnonzero(np.r_[True, (places[1:] != places[:-1] + 1) | (ends[1:] != ends[:-1])][: len(places)])
    last = np.r_[first[1:], len(places)] - 1
    begin, stop = places[first], places[last] + GRAM
    long = stop - begin >= length
    return begin[long], stop[long]


def search_pieces(pieces: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """Piece number and range of bytes of each maximal stretch covered by repeated strings."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    raw = b"".join(pieces)
    begin, stop = promising(raw, sizes, length)
    if not len(begin):
        return
    # the stretches one after another, each closed by a symbol of its own
    extents = stop - begin
    ends = np.cumsum(extents + 1) - 1
    symbols = np.empty(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    within = np.arange(int(extents.sum())) - np.repeat(np.cumsum(extents) - extents, extents)
    symbols[inside] = np.frombuffer(raw, np.uint8)[np.repeat(begin, extents) + within]
    symbols[ends] = 256 + np.arange(len(ends))
    starts = np.flatnonzero(repeated_starts(symbols, length))
    marked = covered(starts, starts + length, len(symbols)).astype(np.int8)
    change = np.diff(np.r_[0, marked, 0])
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    stretch = np.searchsorted(ends, first)
    to_raw = begin[stretch] - (ends - extents)[stretch]
    piece_ends = np.cumsum(sizes)
    piece = np.searchsorted(piece_ends, begin[stretch], side="right")
    to_piece = to_raw - (piece_ends - sizes)[piece]
    yield from zip(piece.tolist(), (first + to_piece).tolist(), (last + to_piece).tolist())


def _search(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def spans(frame: pd.DataFrame) -> pd.DataFrame:
            alone = frame["n"].to_numpy() == 1
            t1, t2, start = frame["t1"].to_numpy(), frame["t2"].to_numpy(), frame["start"].to_numpy()
            # pieces that occur more often are known to repeat; here they only match others
            rows = [
                (t1[p], t2[p], start[p] + a, start[p] + b)
                for p, a, b in search_pieces(frame["bytes"].tolist(), length)
                if alone[p]
            ]
            return pd.DataFrame(rows, columns=["t1", "t2", "start", "stop"], dtype=np.int64)

        held: list[pd.DataFrame] = []
        size = 0
        for frame in batches:
            if not len(frame):
                continue
            held.append(frame)
            size += int(frame["bytes"].map(len).sum())
            if size < ARRAY_BYTES:
                continue
            whole = pd.concat(held, ignore_index=True)
            key = whole["key"].to_numpy()
            sums = whole["bytes"].map(len).cumsum().to_numpy()
            at = 0
            while True:
                # as many whole keys as fit, at least one; the last may go on in the next batch
                goal = (sums[at - 1] if at else 0) + ARRAY_BYTES
                last = int(np.searchsorted(sums, goal))
                if last >= len(key):
                    break
                cut = int(np.searchsorted(key[at:], key[last], side="left")) + at
                if cut == at:
                    cut = int(np.searchsorted(key[at:], key[last], side="right")) + at
                if cut >= len(key):
                    break
                yield spans(whole.iloc[at:cut])
                at = cut
            held = [whole.iloc[at:]]
            size = int(sums[-1] - (sums[at - 1] if at else 0))
        if held:
            yield spans(pd.concat(held, ignore_index=True))

    return run


def _windows(length: int):
    """The windows of pieces of crowded keys, by a hash of 128 bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for piece, n, t1, t2, start in zip(*(frame[c].tolist() for c in ("bytes", "n", "t1", "t2", "start"))):
                view = memoryview(piece)
                for at in range(len(piece) - length + 1):
                    rows.append((xxhash.xxh3_128_digest(view[at : at + length]), n, t1, t2, start + at))
            yield pd.DataFrame(rows, columns=["window", "n", "t1", "t2", "start"])

    return run


def _with_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        rows = []
        for text, t1, t2, *pieces in zip(*(frame[c] for c in ("text", "t1", "t2", "key", "n", "pieces", "start", "size"))):
            for key, n, count, a, size in zip(*pieces):
                rows.append((key, n, count, t1, t2, a, text[a : a + size]))
        yield pd.DataFrame(rows, columns=["key", "n", "pieces", "t1", "t2", "start", "bytes"])


# ---- the operator --------------------------------------------------------


def _named(docs: DataFrame, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        F.xxhash64(text, F.lit(1)).alias("t1"), F.xxhash64(text, F.lit(2)).alias("t2"), text.cast("binary").alias("text")
    )


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``t1``, ``t2`` (hashes that stand for a text), ``start``, ``stop``: byte ranges that repeat."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    texts = _named(docs, text_col)
    cut_up = texts.where(F.length("text") >= length).mapInPandas(
        _cut_pieces(length), "key long, digest long, t1 long, t2 long, start long, size long, twice boolean"
    )
    # most pieces are unique; their table goes as soon as the others are found
    with staged(cut_up) as pieces:
        keys = (
            pieces.groupBy("key")
            .agg(
                F.count("*").alias("rows"),
                F.min("digest").alias("x"),
                F.max("digest").alias("y"),
                F.max("twice").alias("twice"),
            )
            .where((F.col("rows") > 1) | F.col("twice"))
            # a piece can repeat a window of its own only where its key occurs twice in it
            .select("key", ((F.col("x") != F.col("y")) | F.col("twice")).alias("mixed"))
        )
        found = stored(pieces.drop("twice").join(keys, "key"))
    strings = stored(
        found.groupBy("key", "digest", "mixed").agg(
            F.count("*").alias("n"), F.min(F.struct("t1", "t2", "start", "size")).alias("one")
        )
    )
    again = strings.where("n > 1").select("key", "digest")
    whole = found.join(again, ["key", "digest"], "left_semi").select(
        "t1", "t2", "start", (F.col("start") + F.col("size")).alias("stop")
    )
    searched = strings.where("mixed")
    per_key = searched.groupBy("key").agg(F.count("*").alias("pieces"))
    wanted = (
        searched.join(per_key, "key")
        .groupBy("one.t1", "one.t2")
        .agg(F.collect_list(F.struct("key", "n", "pieces", "one.start", "one.size")).alias("wanted"))
    )
    copies = texts.join(wanted.select("t1", "t2"), ["t1", "t2"], "left_semi")
    copies = copies.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    cut = stored(
        copies.join(wanted, ["t1", "t2"])
        .select("text", "t1", "t2", *[f"wanted.{c}" for c in ("key", "n", "pieces", "start", "size")])
        .mapInPandas(
            _with_bytes, "key long, n long, pieces long, t1 long, t2 long, start long, bytes binary"
        )
    )
    usual, crowded = cut.where(F.col("pieces") <= GROUP), cut.where(F.col("pieces") > GROUP)
    ends = (
        usual.repartition("key")
        .sortWithinPartitions("key")
        .mapInPandas(_search(length), "t1 long, t2 long, start long, stop long")
    )
    windows = stored(
        crowded.mapInPandas(_windows(length), "window binary, n long, t1 long, t2 long, start long")
    )
    common = windows.groupBy("window").agg(F.sum("n").alias("all")).where("all > 1").select("window")
    many = windows.join(common, "window", "left_semi").select(
        "t1", "t2", "start", (F.col("start") + length).alias("stop")
    )
    return whole.union(ends).union(many).distinct()


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


@dataclass(frozen=True)
class _Names:
    """Columns added to a table, under names that it does not have."""

    x1: str
    x2: str
    t1: str
    t2: str
    spans: str
    cut: str


def _cut_out(text: Column, starts: Column, stops: Column, give_text: bool) -> Column:
    @F.pandas_udf(_RESULT)
    def removed(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, all_starts, all_stops in batches:
            rows = []
            for data, begins, ends in zip(texts, all_starts, all_stops):
                kept, at, removed, runs = [], 0, 0, 0
                if begins is not None and len(begins):
                    merged: list[list[int]] = []
                    for begin, stop in sorted(zip(begins.tolist(), ends.tolist())):
                        if merged and begin <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], stop)
                        else:
                            merged.append([begin, stop])
                    for begin, stop in merged:
                        kept.append(data[at:begin])
                        at = stop
                        removed += stop - begin
                    runs = len(merged)
                rest = b"".join([*kept, data[at:]])
                text = rest.decode(errors="replace") if give_text else None
                rows.append((len(data), removed, runs, hashlib.sha256(rest).hexdigest(), text))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return removed(text.cast("binary"), starts, stops)


def _judged(docs: DataFrame, text_col: str, length: int, give_text: bool) -> tuple[DataFrame, str]:
    """``docs`` with a column of results, and that column's name."""
    text = text_or_empty(text_col)
    names = _Names(*(free_name(docs, f"__{n}") for n in ("x1", "x2", "t1", "t2", "spans", "cut")))
    spans = (
        repeated_spans(docs, text_col, length)
        .groupBy(F.col("t1").alias(names.t1), F.col("t2").alias(names.t2))
        .agg(F.collect_list(F.struct("start", "stop")).alias(names.spans))
    )
    keyed = docs.withColumn(names.x1, F.xxhash64(text, F.lit(1))).withColumn(names.x2, F.xxhash64(text, F.lit(2)))
    same = (F.col(names.x1) == F.col(names.t1)) & (F.col(names.x2) == F.col(names.t2))
    found = F.col(names.spans)
    return keyed.join(spans, same, "left").withColumn(names.cut, _cut_out(text, found["start"], found["stop"], give_text)), names.cut


def removal_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per document: bytes, bytes and runs removed, and the SHA-256 of what remains."""
    judged, cut = _judged(docs.select(id_col, text_col), text_col, length, give_text=False)
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return judged.select(id_col, *[F.col(cut)[n].alias(n) for n in names])


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """All rows and columns, the text without the repeated strings.

    A cut inside a code point leaves a replacement character. A text without repeats,
    null included, stays as it is.
    """
    judged, cut = _judged(docs, text_col, length, give_text=True)
    text = F.when(F.col(cut)["n_removed"] > 0, F.col(cut)["kept"]).otherwise(F.col(text_col))
    return judged.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
