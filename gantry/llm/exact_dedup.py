"""Exact duplicates: of rows with the same normalised text one stays, in SQL expressions only.

1. Every text becomes its SHA-256, after lower-casing A-Z. Digest, id and a row number go
   to a scratch table; texts are read once.
2. A Misra-Gries summary (Spark's ``approx_top_k``, a frequent-items sketch of ``TRACKED``
   counters that combines before the shuffle) names candidates: every digest of more than
   one in ``SHARE`` rows is among them, since its counts are off by at most 3.5 / ``TRACKED``
   of the rows.
3. The candidates are counted exactly, and those that really have more than one in ``SHARE``
   rows are the winners: fewer than ``SHARE`` of them at any size of the table. With the row
   that each keeps they are broadcast, so rows of heavy groups are settled where they are.
4. All other digests have few rows each and go through an ordinary aggregate and join.

Cases: a null text counts as empty; a null id is smaller than any other; of rows that share
the largest id, one stays; repeated rows are copies; an empty table gives an empty result;
other columns, whatever their names, do not matter and are kept by :func:`without_copies`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import free_name, text_or_empty
from gantry.sources.scratch import staged, stored

#: Counters of the summary, and how many of its items are looked at.
TRACKED = 8192
CANDIDATES = 1000
#: A digest of more than one in so many rows is heavy.
SHARE = 500

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_digest(text: Column) -> Column:
    """SHA-256 (hexadecimal) of the text with A-Z in lower case."""
    return F.sha2(F.translate(text, _UPPER, _LOWER).cast("binary"), 256)


def _groups(rows: DataFrame) -> DataFrame:
    """``digest``, ``group_size`` and ``last`` (id and number of the row that stays)."""
    return rows.groupBy("digest").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("last"))


def heavy_groups(rows: DataFrame) -> DataFrame:
    """The groups of more than one in ``SHARE`` rows, counted exactly; fewer than ``SHARE`` rows."""
    top = rows.agg(F.expr(f"approx_top_k(xxhash64(digest), {CANDIDATES}, {TRACKED})").alias("top"))
    candidates = top.select(F.explode("top.item").alias("hash"))  # at most CANDIDATES rows
    found = rows.join(F.broadcast(candidates), F.xxhash64("digest") == F.col("hash"), "left_semi")
    return _groups(found).where(F.col("group_size") * SHARE > rows.count())


def _settled(rows: DataFrame) -> DataFrame:
    """Each row of ``id``, ``row``, ``digest`` with its group's ``group_size`` and ``last``."""
    heavy = stored(heavy_groups(rows))  # fewer than SHARE rows: broadcast twice
    light = rows.join(F.broadcast(heavy), "digest", "left_anti")
    return rows.join(F.broadcast(heavy), "digest").unionByName(light.join(_groups(light), "digest"))


def _digests(docs: DataFrame, id_col: str, text_col: str, row: Column) -> DataFrame:
    digest = F.unhex(text_digest(text_or_empty(text_col)))
    return docs.select(F.col(id_col).alias("id"), row.alias("row"), digest.alias("digest"))


def copies_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    rows = stored(_digests(docs, id_col, text_col, F.monotonically_increasing_id()))
    return _settled(rows).select(
        F.col("id").alias(id_col),
        F.col("last.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    row = free_name(docs, "row_number")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    with staged(_digests(numbered, id_col, text_col, F.col(f"`{row}`"))) as rows:
        kept = stored(_settled(rows).where(F.col("row") == F.col("last.row")).select(F.col("row").alias(row)))
    return numbered.join(kept, row, "left_semi").drop(row)
