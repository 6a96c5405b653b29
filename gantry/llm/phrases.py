"""Phrase collocations: frequent word sequences whose parts rarely occur apart.

1. Texts become chunks of one language: the distinct words once, and the sequence of their
   numbers, with a mark between pieces. Chunks go to a scratch table.
2. Prefix polynomials over the 64-bit hashes of a chunk's words give every sequence of one to
   four words its Rabin-Karp fingerprint by one subtraction and one multiplication. A chunk
   sends each fingerprint once, with its count, to one of many shards: sorted 32-bit values
   in one binary block for each shard, so a fingerprint costs four bytes.
3. A shard adds the counts and answers every block with one bit for each fingerprint: whether
   it reached the minimum. Its place in the block is the pointer back to the occurrences.
4. A chunk takes its answers and materialises the sequences marked frequent, and only those.
   Occurrences of one fingerprint are compared word by word first. The texts are counted again
   over all chunks, so a clash of fingerprints can let a rare sequence through up to here, but
   never changes a count.
5. Scores, containment and the best phrases of a language are joins and aggregates of the
   frequent phrases, in exact integers.

Every group is bounded: a chunk by its number of words, a shard by the number of shards, which
grows with the corpus. Neither a frequent word nor a common language gathers in one task.

Cases: a null text is empty; a null language is ``und``; texts without words count nothing;
bytes that belong to no separator are part of a word; very long texts are cut into chunks that
overlap by three words, so no sequence is lost; repeated rows count each time; ties of score
and count go by the phrase's bytes; an empty table gives an empty result; other columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.llm.common import mixed, text_or_empty
from gantry.sources.scratch import staged, stored

# ---- fixed values of the contract ----
LONGEST = 4
LEAST = 30
SCALE = 2_000_000
CONTAINED_PERCENT = 80
PHRASES = 2000
NO_LANGUAGE = "und"
# --------------------------------------

#: Places (words and piece marks) of a chunk, and sequences that a shard is to answer for.
CHUNK_PLACES = 1 << 18
SHARD_GRAMS = 4_000_000
#: Parts of a language that are ranked by themselves before all of it is.
RANKED_PARTS = 64

_BREAK = b"."
_PIECES = bytes.maketrans(b",;:!?\n\v\f\r", _BREAK * 9)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

# ---- chunks --------------------------------------------------------------


def tokens(text: bytes) -> list[bytes]:
    """The lower-case words of a text, with a full stop wherever a piece ends."""
    return text.lower().translate(_PIECES).replace(_BREAK, b" . ").split()


class _Numbers(dict):
    """Numbers words from 1 on; the break between pieces is 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _chunk(lang: str, taken: list[bytes], own: int) -> tuple:
    """A chunk whose sequences begin at the first ``own`` places; the rest is context."""
    numbers = _Numbers()
    places = np.fromiter(map(numbers.__getitem__, taken), np.int32, len(taken))
    words = list(numbers)[1:]
    return lang, own, int(np.count_nonzero(places[:own])), b" ".join(words), places.tobytes()


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["lang", "own", "n_words", "words", "places"]
    for frame in batches:
        for lang, texts in frame.groupby("lang", sort=True)["text"]:
            waiting: list[bytes] = []
            for text in texts:
                waiting += tokens(text)
                waiting.append(_BREAK)
                done = 0
                while len(waiting) - done > CHUNK_PLACES:
                    taken = waiting[done : done + CHUNK_PLACES + LONGEST - 1]
                    yield pd.DataFrame([_chunk(lang, taken, CHUNK_PLACES)], columns=names)
                    done += CHUNK_PLACES
                del waiting[:done]
            if any(t != _BREAK for t in waiting):
                yield pd.DataFrame([_chunk(lang, waiting, len(waiting))], columns=names)


# ---- fingerprints --------------------------------------------------------


def prefix_polynomials(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of hash * base ** place before each place, and the powers base ** -place."""
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(hashes), _BASE)], dtype=np.uint64)
    undo = np.cumprod(np.r_[np.uint64(1), np.full(len(hashes), _INVERSE)], dtype=np.uint64)
    return np.r_[np.uint64(0), np.cumsum(hashes * powers[:-1], dtype=np.uint64)], undo


class Grams:
    """The sequences of a chunk: for each length where they begin, and their fingerprints."""

    def __init__(self, lang: str, own: int, words: bytes, places: bytes):
        self.words = words.split(b" ")
        self.places = np.frombuffer(places, np.int32)
        of_words = [xxhash.xxh64_intdigest(w) for w in self.words]
        self.hashes = np.array([0, *of_words], np.uint64)[self.places]
        self.sums, self.undo = prefix_polynomials(self.hashes)
        self.own, self.seed = own, np.uint64(xxhash.xxh64_intdigest(lang))

    def of_length(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places at which a sequence of ``n`` words begins, and its fingerprints."""
        last = len(self.places) - n + 1
        if last <= 0:
            return np.zeros(0, np.int32), np.zeros(0, np.uint64)
        whole = np.ones(last, bool)
        for k in range(n):
            whole &= self.places[k : k + last] > 0
        begin = np.flatnonzero(whole[: self.own]).astype(np.int32)
        polynomial = (self.sums[begin + n] - self.sums[begin]) * self.undo[begin]
        return begin, mixed(polynomial ^ (self.seed + np.uint64(n)))

    def all_lengths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, lengths and fingerprints of all sequences."""
        found = [self.of_length(n) for n in range(1, LONGEST + 1)]
        lengths = np.repeat(np.arange(1, LONGEST + 1, dtype=np.int8), [len(b) for b, _ in found])
        return np.concatenate([b for b, _ in found]), lengths, np.concatenate([f for _, f in found])


def _sharded(prints: np.ndarray, shards: int) -> np.ndarray:
    """The shard and value of each fingerprint as one number."""
    # the shard comes from the lower half, the value that stands for the fingerprint is the upper
    return ((prints & np.uint64(0xFFFFFFFF)) % np.uint64(shards)) << np.uint64(32) | prints >> np.uint64(32)


def _shard_bounds(distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shards that occur, and where each begins (and the end)."""
    shard = (distinct >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, np.int64)
    return shard[starts], np.r_[starts, len(shard)]


def _blocks(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples():
                _, _, prints = Grams(row.lang, row.own, row.words, row.places).all_lengths()
                distinct, counts = np.unique(_sharded(prints, shards), return_counts=True)
                del prints
                names, ends = _shard_bounds(distinct)
                values = (distinct & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rows = []
                for shard, a, b in zip(names, ends[:-1], ends[1:]):
                    more = np.flatnonzero(counts[a:b] > 1).astype(np.uint32)
                    extra = np.concatenate([more, counts[a:b][more].astype(np.uint32)])
                    rows.append((int(shard), row.chunk, values[a:b].tobytes(), extra.tobytes()))
                yield pd.DataFrame(rows, columns=["shard", "chunk", "values", "extra"])

    return run


def _answers(least: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        blocks = [np.frombuffer(v, np.uint32) for v in frame["values"]]
        counts = []
        for block, extra in zip(blocks, frame["extra"]):
            of_block = np.ones(len(block), np.int64)
            more = np.frombuffer(extra, np.uint32).reshape(2, -1)
            of_block[more[0]] = more[1]
            counts.append(of_block)
        _, which = np.unique(np.concatenate(blocks), return_inverse=True)
        often = (np.bincount(which, np.concatenate(counts)) >= least)[which]
        parts = np.split(often, np.cumsum([len(b) for b in blocks])[:-1])
        bits = [np.packbits(p).tobytes() if p.any() else None for p in parts]
        out = pd.DataFrame({"chunk": frame["chunk"], "shard": frame["shard"], "bits": bits})
        return out.dropna()

    return run


# ---- phrases -------------------------------------------------------------


def _same_words(places: np.ndarray, begin: np.ndarray, n: int, first: np.ndarray) -> bool:
    """Whether the sequences at ``begin`` are, word by word, those at ``first``."""
    return all(bool((places[begin + k] == places[first + k]).all()) for k in range(n))


def _materialised(shards: int):
    def run(key: tuple, chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["lang", "n_words", "phrase", "f"]
        rows: list[tuple] = []
        for row in chunk.itertuples():  # one
            grams = Grams(row.lang, row.own, row.words, row.places)
            begin, lengths, prints = grams.all_lengths()
            distinct, which = np.unique(_sharded(prints, shards), return_inverse=True)
            often = np.zeros(len(distinct), bool)
            found, ends = _shard_bounds(distinct)
            at = {int(s): (a, b) for s, a, b in zip(found, ends[:-1], ends[1:])}
            for shard, bits in zip(answers["shard"], answers["bits"]):
                a, b = at[shard]
                often[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
            chosen = often[which]
            for n in range(1, LONGEST + 1):
                here = chosen & (lengths == n)
                starts = begin[here]
                _, first, same, counts = np.unique(prints[here], return_index=True, return_inverse=True, return_counts=True)
                if not _same_words(grams.places, starts, n, starts[first][same]):
                    sequences = np.stack([grams.places[starts + k] for k in range(n)], axis=1)
                    _, first, counts = np.unique(sequences, axis=0, return_index=True, return_counts=True)
                for s, count in zip(starts[first].tolist(), counts.tolist()):
                    text = b" ".join([grams.words[p - 1] for p in grams.places[s : s + n].tolist()])
                    rows.append((row.lang, n, text, count))
        return pd.DataFrame(rows, columns=names)

    return run


def frequent_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``n_words``, ``phrase``, ``f`` of sequences that occur ``least`` times or more,
    and ``lang``, ``n``, all words of each language."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    cut = rows.mapInPandas(_chunks, "lang string, own long, n_words long, words binary, places binary")
    with staged(cut.select(F.monotonically_increasing_id().alias("chunk"), "*")) as chunks:
        words = stored(chunks.groupBy("lang").agg(F.sum("n_words").alias("n")))
        total = words.agg(F.sum("n")).first()[0] or 0
        shards = 1 + total * LONGEST // SHARD_GRAMS
        blocks = chunks.mapInPandas(_blocks(shards), "shard int, chunk long, values binary, extra binary")
        answers = blocks.groupBy("shard").applyInPandas(_answers(least), "chunk long, shard int, bits binary")
        found = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
            _materialised(shards), "lang string, n_words int, phrase binary, f long"
        )
        counted = found.groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        return stored(counted.withColumn("phrase", F.col("phrase").cast("string"))), words


def cut_scores(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more with ``a``, and ``l``, ``r`` and ``score`` of their worst cut."""
    words = F.split("phrase", " ", -1)
    after = F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    cuts = phrases.where("n_words > 1").select("lang", "n_words", "phrase", F.col("f").alias("a"), after)
    cuts = cuts.withColumns(
        {
            "left": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
            "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("n_words") - F.col("k")), " "),
        }
    )
    parts = phrases.where(F.col("n_words") < LONGEST)
    lefts = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # every part is as frequent as the phrase at least, so it is there
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).withColumn(
        "score", F.expr(f"cast(a as decimal(19, 0)) * {SCALE} div (cast(l as decimal(19, 0)) + r)")
    )
    worst = F.min(F.struct("score", "k", "l", "r")).alias("worst")
    return scored.groupBy("lang", "n_words", "phrase", "a").agg(worst).select(
        "lang", "n_words", "phrase", "a", "worst.l", "worst.r", "worst.score"
    )


def contained_phrases(phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``within``: the count of the most frequent longer phrase around it."""
    words = F.split("phrase", " ", -1)
    longer = phrases.where("n_words > 2").select("lang", "n_words", "f", words.alias("w"))
    shorter = F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size")
    sized = longer.select("*", shorter)
    begin = F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("begin")
    inside = sized.select("*", begin).select("lang", "f", F.array_join(F.slice("w", F.col("begin"), F.col("size")), " ").alias("phrase"))
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("within"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, best: int = PHRASES
) -> DataFrame:
    """The ``best`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    phrases, words = frequent_phrases(docs, text_col, lang_col, least)
    scored = cut_scores(phrases).join(contained_phrases(phrases), ["lang", "phrase"], "left")
    free = F.col("within").isNull() | (
        F.col("within").cast("decimal(19, 0)") * 100 < F.col("a").cast("decimal(19, 0)") * CONTAINED_PERCENT
    )
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # a language may hold most phrases, so the best of each part of it come first
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS))
    first = Window.partitionBy("lang", "part").orderBy(*order)
    ranked = scored.where(free).withColumn("part", part).withColumn("rank", F.row_number().over(first))
    ranked = ranked.where(F.col("rank") <= best)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
