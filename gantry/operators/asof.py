"""As-of join: each fact takes the history row that was valid at its time.

Spark has no such join. Facts and history are put into one table, sorted by key and time,
and every fact takes the last history row before it. A key that holds a third of the facts
would be one sort in one task, so keys are cut into slices of time; what was valid when a
slice begins is carried into it from the slices before. The carrying needs one row for each
key and slice and no facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.operators.merge import quoted

_HISTORY, _FACT = 0, 1


def _named(df: DataFrame, columns: list[str]):
    return F.struct(*(F.col(quoted(c)) for c in columns))


def as_of(
    facts: DataFrame, history: DataFrame, key: str, time: str, valid_from: str, slice_unit: str = "day"
) -> DataFrame:
    """Facts with the columns of the history row of their ``key`` with the latest ``valid_from``
    that is not after their ``time``.

    A fact before the first history row, or without key or time, has NULLs. Of several history
    rows of a key that begin at the same time the largest counts. ``slice_unit`` is a unit of
    ``date_trunc``: the facts of one key and unit have to fit in one task. The two tables have
    only the key's name in common.
    """
    added = [c for c in history.columns if c != key]
    kinds = {f.name: f.dataType for f in history.schema}
    shared = {c.lower() for c in facts.columns} & {c.lower() for c in added}
    if shared:
        raise ValueError(f"columns of both tables: {', '.join(sorted(shared))}")
    values = [valid_from, *(c for c in added if c != valid_from)]
    # the struct begins with the time, so the largest is the latest
    valid = history.where(F.col(quoted(key)).isNotNull() & F.col(quoted(valid_from)).isNotNull()).select(
        F.col(quoted(key)).alias("k"), F.col(quoted(valid_from)).alias("at"), _named(history, values).alias("h")
    )
    valid = valid.withColumn("slice", F.date_trunc(slice_unit, "at"))
    dated = F.col(quoted(key)).isNotNull() & F.col(quoted(time)).isNotNull()
    rows = facts.where(dated).select(
        F.col(quoted(key)).alias("k"), F.col(quoted(time)).alias("at"), _named(facts, facts.columns).alias("f")
    )
    rows = rows.withColumn("slice", F.date_trunc(slice_unit, "at"))

    newest = valid.groupBy("k", "slice").agg(F.max("h").alias("newest"))
    asked = rows.select("k", "slice").distinct().withColumn("asked", F.lit(True))
    before = Window.partitionBy("k").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = asked.join(newest, ["k", "slice"], "full_outer")
    carried = slices.withColumn("h", F.last("newest", ignorenulls=True).over(before))
    carried = carried.where(F.col("asked") & F.col("h").isNotNull()).select("k", F.col("slice").alias("at"), "h", "slice")

    kind = F.lit(_HISTORY).alias("kind")
    # a row carried in, from an earlier slice, stands before one that begins with the slice
    known = valid.select("k", "slice", "at", kind, "h").union(carried.select("k", "slice", "at", kind, "h"))
    events = known.unionByName(
        rows.select("k", "slice", "at", F.lit(_FACT).alias("kind"), "f"), allowMissingColumns=True
    )
    so_far = Window.partitionBy("k", "slice").orderBy("at", "kind", "h").rowsBetween(Window.unboundedPreceding, 0)
    found = events.withColumn("valid", F.last("h", ignorenulls=True).over(so_far)).where(F.col("kind") == _FACT)
    joined = found.select("f.*", *(F.col(f"valid.{quoted(c)}").alias(c) for c in added))
    rest = facts.where(~dated).select(
        *(F.col(quoted(c)) for c in facts.columns), *(F.lit(None).cast(kinds[c]).alias(c) for c in added)
    )
    return joined.union(rest)
