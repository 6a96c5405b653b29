"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Every passage of every training document is a query. Passages are pairs of neighbouring
cells of words, so any stretch of up to a cell's length lies whole in one of them. A
score is stated as a share of the score the item's own text would get, so one threshold
fits all items. Upper bounds (of the posting lists, then of blocks of items) rule out
nearly all passages before a posting is read; for the rest the WAND loop moves cursors
over the lists. Items retrieved for a document are then verified: enough of the
question's three-word shingles and of the answer's words must occur in it.

The index is built for a block of items at a time, at most ``BLOCK_ITEMS`` items or
``BLOCK_BYTES`` of question and answer, and each block is a broadcast of its own. Documents are
read once: a task takes each batch of them through the blocks, one at a time in memory.
Document frequencies, the number of parts and their mean length are those of all items,
counted once in Spark, so scores do not depend on which items share a block.

Cases: null and empty texts have no words and match nothing; items of fewer than
``MIN_ITEM_WORDS`` words are too short to be recognised and match nothing; equal items
are all reported; repeated documents give repeated rows; an empty table on either side
gives no match; words are compared in lower case (A-Z) without punctuation around them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantry.llm.common import chunks, free_name, text_or_empty
from gantry.sources.scratch import stored

THRESHOLD = 0.7
QUESTION_OVERLAP = 0.5
ANSWER_OVERLAP = 0.5
MIN_ITEM_WORDS = 5
#: Words of a cell; longer items are indexed in parts of this length.
CELL = 64
BLOCK_ITEMS = 4096
BLOCK_BYTES = 4 << 20
K1, LENGTH_WEIGHT = 1.2, 0.75
#: Parts of items that share one upper bound.
BOUND_PARTS = 4

_EDGES = bytes(set(range(0x21, 0x7F)) - set(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))


def normal_words(text: bytes) -> list[bytes]:
    return [word.strip(_EDGES) or word for word in text.lower().split()]


def shingles(words: list[bytes], size: int = 3) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@dataclass
class Item:
    """A test item: its number in the block and what verification asks for."""

    question: set[tuple[bytes, ...]]
    answer: set[bytes]


@dataclass
class Statistics:
    """Of the parts of all items: their number, their mean length, and how many hold a word."""

    parts: int
    mean_length: float
    holders: dict[bytes, int]


def item_words(text: bytes, answer_text: bytes | None) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """All words of an item, those of its question and those of its answer."""
    words = normal_words(text)
    if answer_text is None:
        cut = len(words) - max(3, len(words) // 4)
        return words, words[: max(cut, 0)] or words, words[max(cut, 0) :]
    answer = normal_words(answer_text)
    return words + answer, words, answer


def parts_of(words: list[bytes]) -> list[list[bytes]]:
    if len(words) < MIN_ITEM_WORDS:
        return []
    return [words[at : at + CELL] for at in range(0, len(words), CELL)]


class Index:
    """Postings of one block of items. A part is an item or, of a long one, a stretch.

    Without ``statistics`` those of the block are used.
    """

    def __init__(self, items: list[tuple[bytes, bytes | None]], statistics: Statistics | None = None):
        self.items: list[Item] = []
        self.part_item: list[int] = []
        parts: list[list[bytes]] = []
        for number, (text, answer_text) in enumerate(items):
            words, question, answer = item_words(text, answer_text)
            self.items.append(Item(shingles(question), set(answer)))
            own = parts_of(words)
            parts += own
            self.part_item += [number] * len(own)
        self.terms: dict[bytes, int] = {}
        triples: dict[tuple[int, int], int] = {}
        for part, words in enumerate(parts):
            for word in words:
                key = (self.terms.setdefault(word, len(self.terms)), part)
                triples[key] = triples.get(key, 0) + 1
        n, n_terms = len(parts), len(self.terms)
        term, part, count = (np.array(x, np.int64) for x in zip(*((t, p, c) for (t, p), c in sorted(triples.items())))) if triples else (np.zeros(0, np.int64),) * 3
        length = np.array([len(p) for p in parts], np.float64)
        if statistics:
            holders = np.array([statistics.holders[t] for t in self.terms], np.int64)
            n_parts, mean = statistics.parts, statistics.mean_length
        else:
            holders = np.bincount(term, minlength=n_terms)
            n_parts, mean = n, length.mean() if n else 1.0
        idf = np.log1p((n_parts - holders + 0.5) / (holders + 0.5))
        norm = K1 * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * length / max(mean, 1.0))
        weight = idf[term] * count * (K1 + 1) / (count + norm[part])
        own = np.bincount(part, weight, minlength=n)
        self.weight = (weight / own[part]).astype(np.float32) if n else weight.astype(np.float32)
        self.part = part
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        self.n_bounds = -(-n // BOUND_PARTS)
        # one bound for each block of parts that a list has entries in, by block
        blocks, place = np.unique(part // BOUND_PARTS * max(n_terms, 1) + term, return_inverse=True)
        self.bound_block, self.bound_term = np.divmod(blocks, max(n_terms, 1))
        self.bound = np.zeros(len(blocks), np.float32)
        np.maximum.at(self.bound, place, self.weight)
        self.list_bound = np.zeros(n_terms, np.float32)
        np.maximum.at(self.list_bound, term, self.weight)
        # for the cursors, which go entry by entry
        self.parts, self.weights, self.starts = part.tolist(), self.weight.tolist(), self.start.tolist()
        self.list_bounds = self.list_bound.tolist()
        self.block_bounds: list[dict[int, float]] = [{} for _ in range(n_terms)]
        for t, block, bound in zip(self.bound_term.tolist(), self.bound_block.tolist(), self.bound.tolist()):
            self.block_bounds[t][block] = bound

    def search(self, terms: list[int], threshold: float) -> Iterator[tuple[int, float]]:
        """Block-max WAND: parts that score at least ``threshold`` for a set of terms."""
        parts, starts, list_bounds = self.parts, self.starts, self.list_bounds
        cursors = [[parts[starts[t]], starts[t], starts[t + 1], t] for t in terms]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, cursor in enumerate(cursors):
                bound += list_bounds[cursor[3]]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                return
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            group = at // BOUND_PARTS
            if sum(self.block_bounds[c[3]].get(group, 0.0) for c in cursors[: pivot + 1]) < threshold:
                # nothing in this block of parts before the next list joins in
                to = (group + 1) * BOUND_PARTS
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                moved = cursors[: pivot + 1]
            elif cursors[0][0] == at:
                moved = [c for c in cursors if c[0] == at]
                score = sum(self.weights[c[1]] for c in moved)
                if score >= threshold:
                    yield at, score
                to = at + 1
            else:
                to = at
                moved = [c for c in cursors if c[0] < at]
            for cursor in moved:
                place = bisect_left(parts, to, cursor[1], cursor[2])
                cursor[1] = place
                cursor[0] = parts[place] if place < cursor[2] else -1
            cursors = [c for c in cursors if c[0] >= 0]

    def candidates(self, words_of: list[np.ndarray], threshold: float) -> dict[int, dict[int, float]]:
        """For each text of a chunk the items retrieved by any passage, with the best score.

        ``words_of`` has the term of each word of each text, -1 for words of no item.
        """
        found: dict[int, dict[int, float]] = {}
        lengths = np.array([len(w) for w in words_of], np.int64)
        cells_of = -(-lengths // CELL)
        if not self.n_bounds or not cells_of.sum():
            return found
        first_cell = np.r_[0, np.cumsum(cells_of)]
        begins = np.r_[0, np.cumsum(lengths)]
        terms = np.concatenate(words_of)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        cell = first_cell[owner] + (np.arange(len(terms)) - begins[owner]) // CELL
        known = terms >= 0
        # distinct terms of each cell, by cell
        pairs = np.unique(cell[known] * len(self.terms) + terms[known])
        cell, terms = np.divmod(pairs, len(self.terms))
        edges = np.searchsorted(cell, np.arange(first_cell[-1] + 1))
        text_of = np.repeat(np.arange(len(lengths)), cells_of)
        has_next = np.r_[text_of[1:] == text_of[:-1], False]
        alone = cells_of[text_of] == 1

        def per_passage(of_cell: np.ndarray) -> np.ndarray:
            following = np.roll(of_cell, -1, axis=0)
            joined = np.where(has_next.reshape(-1, *[1] * (of_cell.ndim - 1)), of_cell + following, 0)
            return np.where(alone.reshape(-1, *[1] * (of_cell.ndim - 1)), of_cell, joined)

        totals = np.r_[0, np.cumsum(self.list_bound[terms], dtype=np.float64)]
        slack = threshold * (1 - 1e-5)
        open_passages = per_passage(totals[edges[1:]] - totals[edges[:-1]]) >= slack
        for at in range(0, self.n_bounds, 16):
            width = min(16, self.n_bounds - at)
            a, b = np.searchsorted(self.bound_block, (at, at + width))
            bounds = np.zeros((len(self.terms), width), np.float32)
            bounds[self.bound_term[a:b], self.bound_block[a:b] - at] = self.bound[a:b]
            totals = np.zeros((len(terms) + 1, width))
            np.cumsum(bounds[terms], axis=0, out=totals[1:])
            by_block = per_passage(totals[edges[1:]] - totals[edges[:-1]])
            hits = (by_block >= slack) & open_passages[:, None]
            if at == 0:
                worth = hits.any(axis=1)
            else:
                worth |= hits.any(axis=1)
        for passage in np.flatnonzero(worth):
            last = passage + 1 if alone[passage] else passage + 2
            asked = set(terms[edges[passage] : edges[last]].tolist())
            best = found.setdefault(int(text_of[passage]), {})
            for part, score in self.search(sorted(asked), threshold):
                item = self.part_item[part]
                best[item] = max(best.get(item, 0.0), score)
        return found


class _Terms(dict):
    """Term numbers of words as they stand in a text, kept while a task runs."""

    def __init__(self, index: Index):
        self.known = index.terms

    def __missing__(self, word: bytes) -> int:
        term = self[word] = self.known.get(word.strip(_EDGES) or word, -1)
        return term


def find_items(texts: list[bytes], index: Index, lookup: _Terms, limits: tuple[float, float, float]) -> list[list[tuple]]:
    """For each text the verified items: number, score, overlap of question and of answer."""
    threshold, question_overlap, answer_overlap = limits
    found: list[list[tuple]] = [[] for _ in texts]
    for a, b in chunks(texts):
        if len(lookup) > 500_000:
            lookup.clear()
        words_of = []
        for text in texts[a:b]:
            words = text.lower().split()
            words_of.append(np.fromiter(map(lookup.__getitem__, words), np.int64, len(words)))
        for i, items in index.candidates(words_of, threshold).items():
            if not items:
                continue
            words = normal_words(texts[a + i])
            here, words_here = shingles(words), set(words)
            for number, score in sorted(items.items()):
                item = index.items[number]
                question = len(item.question & here) / max(1, len(item.question))
                answer = len(item.answer & words_here) / len(item.answer) if item.answer else 1.0
                if question >= question_overlap and answer >= answer_overlap:
                    found[a + i].append((number, score, question, answer))
    return found


def _match_type(id_type: T.DataType) -> T.StructType:
    numbers = ("score", "question_overlap", "answer_overlap")
    return T.StructType([T.StructField("item_id", id_type), *[T.StructField(n, T.DoubleType()) for n in numbers]])


def _matches(text: Column, blocks: list, id_type: T.DataType, limits: tuple) -> Column:
    """The items found in a text. ``blocks``: broadcast (index, ids) of each block of items.

    A task takes each batch of documents through all blocks and holds one block at a time.
    """
    match = _match_type(id_type)

    @F.pandas_udf(T.ArrayType(match))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = match.names
        known: dict[int, _Terms] = {}
        for series in batches:
            texts = list(series)
            found: list[list[dict]] = [[] for _ in texts]
            for number, shared in enumerate(blocks):
                index, ids = shared.value
                lookup = known.setdefault(number, _Terms(index))
                for of_text, rows in zip(found, find_items(texts, index, lookup, limits)):
                    of_text += [dict(zip(names, (ids[n], *rest))) for n, *rest in rows]
                if len(blocks) > 1:
                    del index, ids, lookup, known[number]
                    vars(shared).pop("_value", None)  # read again from the worker's disk for the next batch
            yield pd.Series(found, dtype=object)

    # else Spark would look through a text again for each use of the result
    return find.asNondeterministic()(text.cast("binary"))


def _texts(text_col: str, answer_col: str | None) -> tuple[Column, Column]:
    answer = F.col(answer_col).cast("string").cast("binary") if answer_col else F.lit(None).cast("binary")
    return text_or_empty(text_col).cast("binary").alias("text"), answer.alias("answer")


def _part_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each part its length and its distinct words."""
    for frame in batches:
        parts = [p for text, answer in zip(frame["text"], frame["answer"]) for p in parts_of(item_words(text, answer)[0])]
        if parts:
            yield pd.DataFrame({"length": [len(p) for p in parts], "words": [list(set(p)) for p in parts]})


def _statistics(items: DataFrame, text_col: str, answer_col: str | None):
    """The statistics of all items, for the words of a block."""
    spark = items.sparkSession
    parts = items.select(*_texts(text_col, answer_col)).mapInPandas(_part_words, "length long, words array<binary>")
    n_parts, mean = parts.agg(F.count("*"), F.coalesce(F.avg("length"), F.lit(1.0))).first()
    holders = stored(parts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")))

    def of(block: list[tuple[bytes, bytes | None]]) -> Statistics:
        words = {w for text, answer in block for w in item_words(text, answer)[0]}
        asked = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
        found = holders.join(asked, "word", "left_semi").collect()
        return Statistics(n_parts, mean, {bytes(r.word): r.n for r in found})

    return of


def _blocks(items: DataFrame, item_col: str, text_col: str, answer_col: str | None) -> Iterator[tuple[list, list]]:
    """Items in blocks of bounded size, streamed to the driver partition by partition."""
    rows = items.select(F.col(item_col), *_texts(text_col, answer_col)).toLocalIterator()
    ids: list = []
    block: list[tuple[bytes, bytes | None]] = []
    size = 0
    for item_id, text, answer_text in rows:
        own = len(text) + len(answer_text or b"")
        if block and (len(block) >= BLOCK_ITEMS or size + own > BLOCK_BYTES):
            yield ids, block
            ids, block, size = [], [], 0
        ids.append(item_id)
        block.append((bytes(text), None if answer_text is None else bytes(answer_text)))
        size += own
    if block:
        yield ids, block


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    threshold: float = THRESHOLD,
    question_overlap: float = QUESTION_OVERLAP,
    answer_overlap: float = ANSWER_OVERLAP,
) -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` with an array of the items found, and that column's name.

    Without ``answer_col``, and where it is null, the last quarter of an item's words counts as its
    answer. An empty answer asks for nothing, so the question decides.
    """
    context = docs.sparkSession.sparkContext
    found = free_name(docs, "leaks")
    id_type = items.schema[item_col].dataType
    statistics = _statistics(items, item_text_col, answer_col)
    blocks = [
        context.broadcast((Index(block, statistics(block)), ids))
        for ids, block in _blocks(items, item_col, item_text_col, answer_col)
    ]
    if not blocks:
        return docs.withColumn(found, F.lit(None).cast(T.ArrayType(_match_type(id_type)))), found
    limits = (threshold, question_overlap, answer_overlap)
    return docs.withColumn(found, _matches(text_or_empty(text_col), blocks, id_type, limits)), found


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row for each document and test item found in it: ids, score and overlaps."""
    judged, found = leaked_items(docs, items, **options)
    named = judged.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("match"))
    fields = judged.schema[found].dataType.elementType.names
    return named.select("doc_id", *[F.col(f"match.{f}").alias(f) for f in fields])


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows in which no test item was found, with all their columns."""
    judged, found = leaked_items(docs, items, **options)
    return judged.where(F.coalesce(F.size(found), F.lit(0)) <= 0).drop(found)
