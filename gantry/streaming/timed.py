"""Landing files as streams in event time: each message once, and hourly health as hours close.

Both keep state between micro-batches in a state store under the checkpoint, so a query that
is stopped, or dies, goes on where it was: files taken, watermark and state are all there, and
the file sink commits a micro-batch once. Nothing is noted anywhere else.

The watermark is the latest event time seen so far less the delay a user allows. It moves
between micro-batches and never back. State older than it is dropped, which bounds the state
by the readings of one delay and not by all history; readings older than it come too late,
are left out, and are counted (:func:`stream_counts`).

``every`` keeps a query running with a micro-batch that often; without it a query takes what
is there and stops.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gantry.functions.telemetry import parse_event_time
from gantry.plans.marts import crane_hourly
from gantry.plans.stages import to_bronze, to_fact, to_silver
from gantry.schema import BRONZE, EVENT_TIME, MESSAGE_ID
from gantry.streaming.ingest import appended, landing_stream

_WITHOUT_MARK = "_without_mark"


def distinct_messages(bronze: DataFrame, delay: str) -> DataFrame:
    """A stream of Bronze rows, each message id once.

    A repeat is dropped if its first copy came with an event time less than ``delay`` behind
    the watermark; later repeats are late rows, unless they carry a newer time. Rows without
    an id, or without a readable time, cannot be told apart or dated and are all kept: a
    value of their own makes each of them different.
    """
    timed = bronze.withColumn(EVENT_TIME, parse_event_time())
    unjudged = F.col(MESSAGE_ID).isNull() | F.col(EVENT_TIME).isNull()
    marked = timed.withColumn(_WITHOUT_MARK, F.when(unjudged, F.uuid()))
    once = marked.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark([MESSAGE_ID, _WITHOUT_MARK])
    return once.select(BRONZE.fieldNames())


def stream_distinct(
    spark: SparkSession,
    raw_data_path: str,
    target_path: str,
    checkpoint_path: str,
    delay: str,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append landing files to Bronze files, each message once (:func:`distinct_messages`)."""
    rows = to_bronze(landing_stream(spark, raw_data_path, max_files_per_trigger))
    return appended(distinct_messages(rows, delay), target_path, checkpoint_path, every)


def stream_hourly(
    spark: SparkSession,
    raw_data_path: str,
    target_path: str,
    checkpoint_path: str,
    delay: str,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append the health of each crane and hour once the watermark has passed the hour.

    Readings are counted in whatever order they come as long as their hour is open; those of
    a closed hour are late. Hours the watermark has not passed stay in the state store. A
    crane that sends most readings adds one partial row per task and hour to the shuffle.
    """
    fact = to_fact(to_silver(to_bronze(landing_stream(spark, raw_data_path, max_files_per_trigger))))
    return appended(crane_hourly(fact.withWatermark(EVENT_TIME, delay)), target_path, checkpoint_path, every)


@dataclass(frozen=True)
class StreamCounts:
    """What a query has done since it was started."""

    rows: int
    late: int
    repeated: int
    #: State rows now, and the watermark the next micro-batch starts from.
    in_state: int
    watermark: str | None


def stream_counts(query: StreamingQuery) -> StreamCounts:
    """Counts of a run, from the progress that Spark keeps of it.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` updates; a run of
    more micro-batches than that is refused rather than counted in part. Rows that an
    aggregate finds late are counted after they are combined: one for each crane, hour and task.
    """
    progress = query.recentProgress
    session = SparkSession.getActiveSession()
    kept = int(session.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")) if session else 100
    if len(progress) >= kept:
        raise ValueError(f"more than the last {kept} micro-batches are not known any more")
    state = [s for p in progress for s in p.stateOperators]
    return StreamCounts(
        rows=sum(p.numInputRows for p in progress),
        late=sum(s.numRowsDroppedByWatermark for s in state),
        repeated=sum(int((s.customMetrics or {}).get("numDroppedDuplicateRows", 0)) for s in state),
        in_state=state[-1].numRowsTotal if state else 0,
        watermark=(progress[-1].eventTime or {}).get("watermark") if progress else None,
    )
