"""Equipment-health reports over Silver and the star schema.

Each is one aggregate with a map-side combine, so a crane that sends a third of
all readings adds one partial row per task to the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.functions.telemetry import (
    critical_anomaly,
    load_critical,
    mtbf_hours,
    operating_hours,
    vibration_critical,
)
from gantry.operators.star import star_join
from gantry.schema import CRANE_ID, EVENT_TIME, LOAD, MODEL, REGION, VIBRATION


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows of each layer's table: (layer, row_count)."""
    counted = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count") for name, df in layers.items()]
    return reduce(DataFrame.union, counted)


def anomaly_flags(readings: DataFrame) -> DataFrame:
    """Readings with both single flags and the combined one."""
    return readings.withColumns(
        {
            "is_vibration_critical": vibration_critical(),
            "is_load_critical": load_critical(),
            "is_critical": critical_anomaly(),
        }
    )


def anomaly_totals(readings: DataFrame) -> DataFrame:
    """Critical readings per crane."""
    return readings.groupBy(CRANE_ID).agg(
        F.count_if(vibration_critical()).alias("vibration_anomalies"),
        F.count_if(load_critical()).alias("load_anomalies"),
        F.count_if(critical_anomaly()).alias("total_critical_anomalies"),
    )


def mtbf(readings: DataFrame) -> DataFrame:
    """Mean time between failures per crane, in hours."""
    counted = readings.groupBy(CRANE_ID).agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(critical_anomaly()).alias("anomalies")
    )
    return counted.withColumns(
        {
            "operating_hours": operating_hours(F.col("readings")),
            "mtbf_hours": mtbf_hours(F.col("readings"), F.col("anomalies")),
        }
    )


def _health(grouped, *more) -> DataFrame:
    return grouped.agg(
        *more,
        F.count(F.lit(1)).alias("readings"),
        F.max(LOAD).alias("max_load_kg"),
        F.avg(VIBRATION).alias("avg_vibration_mm_s"),
        F.count_if(critical_anomaly()).alias("anomalies"),
    )


def crane_hourly(fact: DataFrame) -> DataFrame:
    """Readings of each crane in tumbling hours; undated readings have no hour."""
    hourly = _health(fact.groupBy(CRANE_ID, F.window(EVENT_TIME, "1 hour").alias("hour")))
    return hourly.withColumn("hour_start", F.col("hour.start")).drop("hour")


def star_rollup(fact: DataFrame, dim: DataFrame, *by: str) -> DataFrame:
    """Readings by dimension attributes."""
    return _health(star_join(fact, dim).groupBy(*by))


def alarm_episodes(fact: DataFrame, gap: str = "1 day", slice_unit: str = "day") -> DataFrame:
    """Runs of critical readings of a crane, none more than ``gap`` after the one before.

    Readings are first merged into sessions within slices of time (a unit of ``date_trunc``),
    so that a crane that sends a third of all readings is spread over its slices. Sessions
    that go on across a slice's end are then joined, in a window over the sessions of a crane:
    their number depends on the time the table covers, not on the readings. Undated readings
    belong to no episode.
    """
    dated = fact.where(critical_anomaly() & F.col(EVENT_TIME).isNotNull())
    sliced = dated.withColumn("slice", F.date_trunc(slice_unit, EVENT_TIME))
    sessions = sliced.groupBy(CRANE_ID, "slice", F.session_window(EVENT_TIME, gap)).agg(
        F.min(EVENT_TIME).alias("started"),
        F.max(EVENT_TIME).alias("ended"),
        F.count(F.lit(1)).alias("readings"),
        F.max(LOAD).alias("max_load_kg"),
        F.max(VIBRATION).alias("max_vibration_mm_s"),
    )
    in_order = Window.partitionBy(CRANE_ID).orderBy("started")
    goes_on = F.col("started") <= F.lag("ended").over(in_order) + F.expr(f"INTERVAL {gap}")
    numbered = sessions.withColumn("begins", F.when(goes_on, 0).otherwise(1)).withColumn(
        "episode", F.sum("begins").over(in_order)
    )
    return (
        numbered.groupBy(CRANE_ID, "episode")
        .agg(
            F.min("started").alias("started"),
            F.max("ended").alias("ended"),
            F.sum("readings").alias("readings"),
            F.max("max_load_kg").alias("max_load_kg"),
            F.max("max_vibration_mm_s").alias("max_vibration_mm_s"),
        )
    )


def mtbf_by_episode(fact: DataFrame, gap: str = "1 day") -> DataFrame:
    """As :func:`mtbf`, but readings of one alarm episode are one failure.

    Cranes without an episode have no mean time between them.
    """
    counted = fact.groupBy(CRANE_ID).agg(F.count(F.lit(1)).alias("readings"))
    episodes = alarm_episodes(fact, gap).groupBy(CRANE_ID).agg(F.count(F.lit(1)).alias("episodes"))
    joined = counted.join(episodes, CRANE_ID, "left").withColumn("episodes", F.coalesce("episodes", F.lit(0)))
    return joined.withColumns(
        {
            "operating_hours": operating_hours(F.col("readings")),
            "mtbf_hours": mtbf_hours(F.col("readings"), F.col("episodes")),
        }
    )


def star_cube(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Health by every combination of region, model and crane, the total included, in one pass.

    ``grouped_by`` is the grouping id: 4 is set where the region is summed over, 2 the model,
    1 the crane, so 7 is the total; it tells such a NULL from a crane without a region.
    """
    health = _health(star_join(fact, dim).cube(REGION, MODEL, CRANE_ID), F.grouping_id().alias("grouped_by"))
    return health.withColumn("grouped_by", F.col("grouped_by").cast("long"))
