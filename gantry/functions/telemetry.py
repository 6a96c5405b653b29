"""Column expressions over telemetry readings. All stay inside JVM codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gantry.schema import LOAD, TIMESTAMP, VIBRATION

# The distress thresholds (strict) and the reading interval.
CRITICAL_VIBRATION_MM_S = 45.0
CRITICAL_LOAD_KG = 45000.0
PING_MINUTES = 5


def parse_event_time(text: str | Column = TIMESTAMP) -> Column:
    """ISO-8601 text as an instant; text that is no timestamp becomes NULL.

    The ``try_`` form matters: with ANSI mode on, plain ``to_timestamp`` stops
    the whole job at the first unreadable value.
    """
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def event_date(text: str | Column = TIMESTAMP) -> Column:
    """Calendar day of a reading, NULL when its timestamp is unreadable."""
    return F.to_date(parse_event_time(text))


def vibration_critical() -> Column:
    return F.col(VIBRATION) > F.lit(CRITICAL_VIBRATION_MM_S)


def load_critical() -> Column:
    return F.col(LOAD) > F.lit(CRITICAL_LOAD_KG)


def critical_anomaly() -> Column:
    """A reading counts once when either threshold is passed.

    Meant for Silver or later: NaN sorts above every number, so raw readings
    that hold NaN would be flagged.
    """
    return vibration_critical() | load_critical()


def operating_hours(readings: Column) -> Column:
    """Each reading stands for one five-minute interval of operation.

    The casts keep the arithmetic in doubles; a bare ``5.0`` in SQL text would
    be a decimal and change the result type.
    """
    return readings * F.lit(PING_MINUTES).cast("double") / F.lit(60).cast("double")


def mtbf_hours(readings: Column, anomalies: Column) -> Column:
    """Mean operating hours between anomalies; NULL for a crane without any."""
    return operating_hours(readings) / F.nullif(anomalies, F.lit(0))
