"""Mixing of sources to target weights by a time-varying curriculum, in SQL expressions.

Every source has a weight schedule over the training run, w(t) = 1 + slope * (2t - 1)
for t from 0 to 1, so its demand for words up to t is target * (t + slope * (t^2 - t)).
The documents of a source stand in a fixed pseudo-random order; the inverse of the
demand gives each the position at which training reaches it, and sorting by position
gives the mix. A source that is wanted more than once is read again from its start.

Cumulative sums go over hash buckets first and then within each bucket, so a source
that holds most of the rows is never in one task.

Cases: a null text has no words; a null source is a source of its own, sorted last;
documents without words are taken 0 words and have no position;
repeated rows are taken one by one; empty tables give empty results; clashing names
are renamed while the plan runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.llm.common import WORD, free_name

# ---- fixed values of the contract ----
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_TIMES = 2
# --------------------------------------

#: Slopes of the weight schedules of the sources in order, repeating: early, even, late.
SLOPES = (-0.5, 0.0, 0.5)
#: Leading hex digits of the order key that make a bucket; 4,096 buckets for each source.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _repeating(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (rank % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple, share_percent: int, most_times: int) -> DataFrame:
    """Columns ``source``, ``source_size``, ``target``, ``slope`` from sizes of sources.

    Sharing by weight and re-sharing what exceeds a source's limit ends where every
    source gets the smaller of its limit and level * weight. Sources reach their limit
    in the order of limit / weight, so the level follows from running sums in that
    order. The input has one row for each source, not for each document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    ranked = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", _repeating(weights, F.col("rank")).cast("double"))
        .withColumn("limit", (F.col("source_size") * most_times).cast("double"))
        .withColumn("wanted", F.sum("source_size").over(all_rows) * share_percent / F.lit(100.0))
    )
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levelled = (
        ranked.withColumn("used", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(onward))
        .withColumn("level", (F.col("wanted") - F.col("used")) / F.col("open_weight"))
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("limit"))
        # the level of the first source that does not reach its limit
        .withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("limit") / F.col("weight"), "rank", "level"))).over(all_rows)["level"])
    )
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return levelled.select(
        "source", "source_size", target.alias("target"), _repeating(SLOPES, F.col("rank")).alias("slope")
    )


def _inverse_demand(share: Column, slope: Column) -> Column:
    """The time t in 0..1 at which t + slope * (t^2 - t) reaches ``share``."""
    share = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share)
    # the addition turns a negative zero into zero
    return F.when(slope == 0, share).otherwise(F.try_divide(root - (1 - slope), 2 * slope) + 0.0)


def training_positions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most_times: int = MOST_TIMES,
) -> DataFrame:
    """All rows and columns of ``docs`` with a struct column ``mix``:

    ``size``, ``source_size``, ``target``, ``taken`` and ``positions``, an array of the
    training positions (0..1) at which the document is read: none, one for each reading.
    """
    names = ("size", "source", "key", "bucket", "bucket_size", "before", "end", "mix", "of_source", "of_bucket")
    size, source, key, bucket, bucket_size, before, end, mix, of_source, of_bucket = (
        free_name(docs, f"mix_{n}") for n in names
    )
    identity = F.concat_ws(
        "\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in (id_col, text_col)]
    )
    sized = (
        docs.withColumn(size, word_count(F.col(text_col).cast("string")))
        # never null, so that windows and joins over it share one partitioning
        .withColumn(source, F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")))
        .withColumn(key, F.md5(identity))
        .withColumn(bucket, F.substring(F.col(key), 1, BUCKET_DIGITS))
    )
    buckets = sized.groupBy(source, bucket).agg(F.sum(size).alias(bucket_size))
    preceding = Window.partitionBy(source).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn(before, F.coalesce(F.sum(bucket_size).over(preceding), F.lit(0)))
    sources = source_targets(
        buckets.groupBy(F.nullif(F.col(source), F.lit("")).alias("source")).agg(F.sum(bucket_size).alias("source_size")),
        weights,
        share_percent,
        most_times,
    )
    sources = sources.withColumn("source", F.coalesce("source", F.lit("")))
    goals = buckets.join(sources, F.col(source) == F.col("source"), "left").select(
        F.col(source).alias(of_source),
        F.col(bucket).alias(of_bucket),
        before,
        F.struct("source_size", "target", "slope").alias(mix),
    )
    within = Window.partitionBy(source, bucket).orderBy(key)
    running = sized.withColumn(end, F.sum(size).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    placed = running.join(
        goals, (F.col(source) == F.col(of_source)) & (F.col(bucket) == F.col(of_bucket)), "left"
    )
    goal = F.col(mix)
    stop = F.round(goal["target"]).cast("long")
    start = F.col(before) + F.col(end) - F.col(size)

    def words_in(reading: int) -> Column:
        left = stop - reading * goal["source_size"] - start
        return F.least(F.greatest(left, F.lit(0)), F.col(size))

    def position(reading: int) -> Column:
        reached = F.try_divide((start + reading * goal["source_size"]).cast("double"), goal["target"])
        return F.when(words_in(reading) > 0, _inverse_demand(reached, goal["slope"]))

    readings = range(most_times)
    result = F.struct(
        F.col(size).alias("size"),
        goal["source_size"].alias("source_size"),
        goal["target"].alias("target"),
        reduce(Column.__add__, map(words_in, readings)).alias("taken"),
        F.array_compact(F.array(*map(position, readings))).alias("positions"),
    )
    out = free_name(docs, "mix")
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(out))


def mix_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document, range-sorted by its first training position; untaken ones last."""
    mixed = training_positions(docs, id_col, **options)
    mix = F.col(mixed.columns[-1])
    first = F.round(F.get(mix["positions"], F.lit(0)), 9)
    again = F.round(F.get(mix["positions"], F.lit(1)), 9)
    fields = [mix[name].alias(name) for name in ("size", "source_size", "target", "taken")]
    return mixed.select(F.col(id_col), *fields, first.alias("position"), again.alias("again")).orderBy(
        F.col("position").asc_nulls_last(), id_col
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The training mix: a row for each reading of each taken document, in training order.

    To the columns of ``docs`` it adds ``position`` and ``words``, the words of the
    document that this reading takes (all of them but for the last of a source).
    """
    mixed = training_positions(docs, id_col, **options)
    mix = mixed.columns[-1]
    position, words = free_name(docs, "position"), free_name(docs, "words")
    reading = free_name(docs, "reading")
    size, taken = F.col(mix)["size"], F.col(mix)["taken"]
    return (
        mixed.select("*", F.posexplode(F.col(mix)["positions"]).alias(reading, position))
        .withColumn(words, F.least(size, taken - F.col(reading) * size))
        .select(*[F.col(f"`{c}`") for c in docs.columns], position, words)
        .orderBy(position, id_col)
    )
