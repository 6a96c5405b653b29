"""Chat formatting: logged snapshots of a growing conversation collapse to the longest.

A chat service often logs a conversation after every turn, each time from its start.
Rolling hashes over the turns give every prefix of every conversation a fingerprint;
an anti-join drops conversations whose whole fingerprint is a proper prefix of another
conversation, and among equal conversations all but the one with the smallest id.
What remains is rendered.

A prefix hash is the exclusive-or of two 64-bit hashes of (turn, role, text) over the
turns so far, so it is summed per turn number, then per block of numbers and then within
each block, over its numbers and not its rows: for the prefixes no conversation has to fit
in a task, however many rows share a number. The rendered text comes in segments of
``SEGMENT_TURNS`` turn numbers, and those in pieces of ``PIECE_ROWS`` rows, each of which one
task puts together; usual conversations are one piece of one segment.

A prefix of a conversation ends with a turn number and has all rows of the numbers up to it:
rows that share a number are one step, whatever their order.

Cases: null and empty texts and roles are kept as such (rendered empty, but distinct
from each other when compared); repeated rows count once; rows with the same turn but
different content are all kept, sorted by role and text; a null conversation id is a
conversation of its own; turns without a number come last, in their own segment;
empty tables give empty results; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.sources.scratch import stored

#: Turns in a block of the prefix hash, and in a segment of the rendered text.
SEGMENT_TURNS = 256
#: Rows of a segment that are put together in one text.
PIECE_ROWS = 4096


def _hashes() -> list[Column]:
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("turn", "role", "text")]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (0, 1)]


def _segment() -> Column:
    return F.floor(F.col("turn") / SEGMENT_TURNS).cast("long").alias("segment")


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """The turn numbers of distinct turns, each with the number of turns so far and the
    hashes of the prefix that its turns end."""
    first, second = _hashes()
    rows = turns.distinct().select("conv_id", "turn", _segment(), first.alias("h1"), second.alias("h2"))
    numbers = rows.groupBy("conv_id", "segment", "turn").agg(
        F.count("*").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    in_order = F.col("segment").asc_nulls_last()
    blocks = numbers.groupBy("conv_id", "segment").agg(
        F.sum("n").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    earlier = Window.partitionBy("conv_id").orderBy(in_order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    blocks = blocks.select(
        F.col("conv_id").alias("of_conv"),
        F.col("segment").alias("of_segment"),
        *[
            F.coalesce(total(c).over(earlier), F.lit(0)).alias(f"{c}_before")
            for c, total in (("n", F.sum), ("h1", F.bit_xor), ("h2", F.bit_xor))
        ],
        *[total(c).over(whole).alias(f"{c}_all") for c, total in (("n", F.sum), ("h1", F.bit_xor), ("h2", F.bit_xor))],
    )
    so_far = Window.partitionBy("conv_id", "segment").orderBy(F.col("turn").asc_nulls_last())
    running = numbers.withColumns(
        {
            "n": F.sum("n").over(so_far),
            "h1": F.bit_xor("h1").over(so_far),
            "h2": F.bit_xor("h2").over(so_far),
        }
    )
    joined = running.join(
        blocks, F.col("conv_id").eqNullSafe(F.col("of_conv")) & F.col("segment").eqNullSafe(F.col("of_segment"))
    )
    return joined.select(
        "conv_id",
        "segment",
        "turn",
        (F.col("n") + F.col("n_before")).alias("n"),
        F.col("h1").bitwiseXOR(F.col("h1_before")).alias("h1"),
        F.col("h2").bitwiseXOR(F.col("h2_before")).alias("h2"),
        "n_all",
        "h1_all",
        "h2_all",
    )


def maximal_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The turns (conv_id, segment, turn, role, text, n_turns) of conversations that prefix no other."""
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    prefixes = turn_prefixes(turns)
    whole = ["n_all", "h1_all", "h2_all"]
    # conversations of equal content, and the fingerprints that a longer one starts with
    kept = prefixes.groupBy(*whole).agg(F.min("conv_id").alias("kept_id"))
    longer = (
        prefixes.where(F.col("n") < F.col("n_all"))
        .select(F.col("n").alias("n_all"), F.col("h1").alias("h1_all"), F.col("h2").alias("h2_all"))
        .distinct()
    )
    maximal = kept.join(longer, whole, "left_anti").select("kept_id", F.col("n_all").alias("n_turns"))
    return turns.distinct().join(maximal, F.col("conv_id").eqNullSafe(F.col("kept_id"))).select(
        "conv_id", _segment(), "turn", "role", "text", "n_turns"
    )


def _pieces(turns: DataFrame) -> DataFrame:
    """``turns`` with the number ``piece`` of each ``PIECE_ROWS`` rows of a segment, in their order.

    Segments of at most so many rows are one piece. The rows of larger ones are sorted by range,
    so that a segment is spread over many tasks, and numbered from the counts of the ranges.
    """
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("conv_id", "segment")]
    counts = turns.groupBy("conv_id", "segment").agg(F.count("*").alias("rows")).where(F.col("rows") > PIECE_ROWS)
    crowded = stored(counts.select(F.col("conv_id").alias("of_conv_id"), F.col("segment").alias("of_segment")))
    if crowded.isEmpty():
        return turns.withColumn("piece", F.lit(0).cast("long"))
    usual = turns.join(crowded, same[0] & same[1], "left_anti").withColumn("piece", F.lit(0).cast("long"))
    in_order = ["conv_id", "segment", F.col("turn").asc_nulls_last(), "role", "text"]
    ranged = turns.join(crowded, same[0] & same[1], "left_semi").repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    numbered = stored(ranged.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("nth")))
    ranges = numbered.groupBy("conv_id", "segment", "range").agg(F.count("*").alias("rows"), F.min("nth").alias("first"))
    before = Window.partitionBy("conv_id", "segment").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *[F.col(c).alias(f"of_{c}") for c in ("conv_id", "segment", "range")],
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    placed = numbered.join(ranges, same[0] & same[1] & (F.col("range") == F.col("of_range")))
    piece = F.floor((F.col("nth") + F.col("shift")) / PIECE_ROWS).cast("long")
    return usual.unionByName(placed.select(*turns.columns, piece.alias("piece")))


def format_chats(conversations: DataFrame, **columns) -> DataFrame:
    """Rendered maximal conversations: conv_id, segment, piece, n_turns and text.

    Pieces and segments of a conversation, joined in order, are its training text: for each turn
    a line ``<|role|>``, the text and a line ``<|end|>``.
    """
    turns = _pieces(stored(maximal_conversations(conversations, **columns)))
    line = F.concat(
        F.lit("<|"),
        F.coalesce(F.col("role").cast("string"), F.lit("")),
        F.lit("|>\n"),
        F.coalesce(F.col("text").cast("string"), F.lit("")),
        F.lit("\n<|end|>\n"),
    )
    first = F.struct(F.col("turn").isNull().alias("a"), F.col("turn"), "role", F.col("text").alias("t"), line.alias("line"))
    return (
        turns.groupBy("conv_id", "segment", "piece", "n_turns")
        .agg(F.array_sort(F.collect_list(first)).alias("lines"))
        .select("conv_id", "segment", "piece", "n_turns", F.array_join(F.col("lines.line"), "").alias("text"))
    )
