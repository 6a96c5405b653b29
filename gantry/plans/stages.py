"""Layer plans as pure functions of DataFrames; no reading or writing here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.functions.telemetry import parse_event_time
from gantry.operators.contract import keep_valid
from gantry.schema import (
    CRANE_ID,
    DIM_COLUMNS,
    EVENT_TIME,
    INGESTED_AT,
    LOAD,
    MESSAGE_ID,
    SOURCE_SYSTEM,
    TIMESTAMP,
    VIBRATION,
)


def to_bronze(landing: DataFrame) -> DataFrame:
    """Landing rows stamped with the ingestion instant and the source system."""
    return landing.withColumns(
        {INGESTED_AT: F.current_timestamp(), "source_system": F.lit(SOURCE_SYSTEM)}
    )


def to_silver(bronze: DataFrame) -> DataFrame:
    """Bronze rows that have their ids and physically possible measures."""
    return keep_valid(bronze)


def to_dim(silver: DataFrame) -> DataFrame:
    """Distinct crane attributes. A crane seen with two models has two rows."""
    return silver.select(DIM_COLUMNS).distinct()


def to_dim_latest(silver: DataFrame) -> DataFrame:
    """One row per crane, attributes of its latest reading (ties: largest id).

    One scan and one shuffle of a row per crane and task: the maximum is taken before the
    shuffle, over each task's rows sorted by crane, a sort that can spill.
    """
    attributes = F.struct(*(c for c in DIM_COLUMNS if c != CRANE_ID)).alias("attributes")
    last = F.max(F.struct(parse_event_time(), F.col(MESSAGE_ID), attributes)).alias("last")
    return silver.groupBy(CRANE_ID).agg(last).select(CRANE_ID, "last.attributes.*")


def to_dim_history(silver: DataFrame, slice_unit: str = "day") -> DataFrame:
    """The versions of each crane's attributes, with ``valid_from`` and ``valid_to`` (NULL: still valid).

    A version begins with the first dated reading that differs from the one before; of readings
    at the same time the one of the largest id counts. Readings are compared within slices of a
    crane's time (a unit of ``date_trunc``) first, so that a crane that sends most of them is
    spread over many tasks; what is left to compare is a row for each slice and each change.
    """
    attributes = F.struct(*(c for c in DIM_COLUMNS if c != CRANE_ID)).alias("attributes")
    timed = silver.select(CRANE_ID, attributes, MESSAGE_ID, parse_event_time().alias("valid_from")).where(
        F.col("valid_from").isNotNull()
    )
    sliced = timed.withColumn("slice", F.date_trunc(slice_unit, "valid_from"))
    within = Window.partitionBy(CRANE_ID, "slice").orderBy("valid_from", MESSAGE_ID)
    last = sliced.withColumn("next", F.lead("valid_from").over(within)).where(
        F.col("next").isNull() | (F.col("next") > F.col("valid_from"))
    )
    overall = Window.partitionBy(CRANE_ID).orderBy("valid_from")
    changes = last
    for window in (within, overall):
        before = F.lag(F.struct("attributes")).over(window)  # in a struct: NULL only for the first
        changes = changes.withColumn("before", before).where(~F.col("before").eqNullSafe(F.struct("attributes")))
    return changes.select(
        CRANE_ID, "attributes.*", "valid_from", F.lead("valid_from").over(overall).alias("valid_to")
    )


def to_fact(silver: DataFrame) -> DataFrame:
    """One row per reading, its text timestamp read as an instant."""
    return silver.select(
        MESSAGE_ID, CRANE_ID, parse_event_time(TIMESTAMP).alias(EVENT_TIME), LOAD, VIBRATION
    )
