"""Words, chunks and column helpers shared by the operators.

A *word* is a maximal run of characters other than space and the control
characters 9 to 13. ``bytes.split`` and ``bytes.lower`` follow that definition
exactly (and touch ASCII letters only), so texts are handled as UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a Python worker takes apart at a time.
CHUNK_BYTES = 2 << 20

#: Rows that a Python worker is sent at a time, where rows may be long.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get at most ``BATCH_ROWS`` rows at a time from plans run in the ``with`` block.

    A batch is held several times over, by the JVM and by the worker, so Spark's 10,000 rows of
    whole texts or hash arrays take hundreds of megabytes. A smaller setting of the user's stays.
    """
    before = spark.conf.get(_BATCH_SETTING)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def chunks(texts: list[bytes] | list[str], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes (more for a single longer text)."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


class WordHashes(dict):
    """64-bit hashes of words, kept while a task runs; emptied when it grows large."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def lowest_by_hash(rows: DataFrame, hash_col: str, size: int) -> DataFrame:
    """The ``size`` rows with the smallest values of a 64-bit hash, for rows of different hashes.

    Only hashes below a cut are sorted. The cut follows from the number of rows, so that about
    twice ``size`` are below it: what is gathered does not grow with the rows or their partitions.
    """
    n = rows.count()
    if n > 4 * size:
        rows = rows.where(F.col(hash_col) < -(1 << 63) + (1 << 64) * 2 * size // n)
    return rows.orderBy(hash_col).limit(size)
