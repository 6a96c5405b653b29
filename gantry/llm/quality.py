"""Quality rules: word statistics and repetition, from a suffix array over the words.

Texts of a chunk are written one after another as word numbers that are private to
their document, so common prefixes never reach into another document. The maximal
repeated word strings are the intervals of common prefixes; the union of their spans
gives the share of the text that repeats, the deepest interval the longest repeat.

Cases: a null text is an empty one, has no words and fails; equal rows give equal
results; an empty table gives an empty table; columns of the input that are not the
id are left out of :func:`quality_report` and all kept by :func:`keep_good`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import chunks, free_name, text_or_empty
from gantry.llm.suffix import covered, longest_repeat_at

# ---- fixed values of the contract ----
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
# --------------------------------------

#: Repeats of at least so many words count as covered: fewer than the fixed rule's window, so
#: that words and phrases said over and over count, which leave no window of five twice.
MIN_REPEAT = 3
#: Largest share of the code points in words that repeats may cover. Clean prose of any length
#: stays below 0.25, as short repeats by chance are few.
MAX_COVERED = 0.3
#: Longest repeat, in words, that a good document may have, however long it is.
MAX_LONGEST = 30

_RESULT = """n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
             base_failed boolean, covered_share double, longest_repeat long, kept boolean"""
_NAMES = [part.split()[0] for part in _RESULT.split(",")]

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# neither white space nor the later bytes of a code point
_STARTS_CHAR = ~_IS_SPACE & ((np.arange(256) & 0xC0) != 0x80)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over consecutive ranges that end at ``ends``; ranges may be empty."""
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return total[ends] - total[np.r_[0, ends[:-1]]]


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes], min_repeat: int) -> dict[str, np.ndarray]:
    """The statistics of each text of a chunk."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    text_ends = np.cumsum([len(t) for t in texts])
    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    flat = [w for of_text in words for w in of_text]
    number: dict[bytes, int] = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    owner = np.repeat(np.arange(len(texts)), n_words)
    # code points of each word
    word_points = np.fromiter(map(len, flat), np.int64, len(flat))
    if not raw.size or raw.max() >= 0x80:
        word_points = np.fromiter((len(w) if w.isascii() else len(w.decode()) for w in flat), np.int64, len(flat))

    # one sequence of symbols private to their text, each text closed by a symbol of its own
    symbols = np.unique(owner * (len(number) + 1) + ids, return_inverse=True)[1] if len(ids) else ids
    places = np.arange(len(ids)) + owner
    sequence = np.empty(len(ids) + len(texts), np.int64)
    closing = np.cumsum(n_words) + np.arange(len(texts))
    sequence[closing] = len(ids) + np.arange(len(texts))
    sequence[places] = symbols
    longest = longest_repeat_at(sequence)[places]

    at = np.arange(len(ids))
    found = np.flatnonzero(longest >= WINDOW)
    in_window = covered(found, found + WINDOW, len(ids))
    found = np.flatnonzero(longest >= min_repeat)
    in_repeat = covered(found, at[found] + longest[found], len(ids))
    word_ends = np.cumsum(n_words)
    longest_of = np.zeros(len(texts), np.int64)
    np.maximum.at(longest_of, owner, longest)
    word_chars = _sums(_STARTS_CHAR[raw], text_ends)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": _sums(_IS_SYMBOL[raw], text_ends),
        "n_dup_lines": np.array([_repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": _sums(in_window, word_ends),
        "covered_share": _sums(in_repeat * word_points, word_ends) / np.maximum(word_chars, 1),
        "longest_repeat": longest_of,
    }


def quality_column(text: Column, min_repeat: int, max_covered: float, max_longest: int) -> Column:
    """A struct of the statistics and the verdict."""

    @F.pandas_udf(_RESULT)
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            texts = list(series)
            parts = [pd.DataFrame(measure(texts[a:b], min_repeat)) for a, b in chunks(texts)]
            found = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=_NAMES)
            found["base_failed"] = (found.n_words < MIN_WORDS) | (
                100 * found.n_repeat_words > MAX_REPEATED_PERCENT * found.n_words
            )
            found["kept"] = (
                ~found.base_failed & (found.covered_share <= max_covered) & (found.longest_repeat <= max_longest)
            )
            yield found[_NAMES]

    return report(text.cast("binary"))


def quality_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """One row per document with its statistics, the fixed rules' verdict and the final one."""
    found = quality_column(text_or_empty(text_col), min_repeat, max_covered, max_longest)
    return docs.select(F.col(id_col), found.alias("found")).select(id_col, "found.*")


def keep_good(
    docs: DataFrame,
    text_col: str = "text",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """The rows that pass, with all their columns."""
    found = free_name(docs, "quality")
    judged = docs.withColumn(found, quality_column(text_or_empty(text_col), min_repeat, max_covered, max_longest))
    return judged.where(F.col(found)["kept"]).drop(found)
