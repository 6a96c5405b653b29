"""Landing files as a stream: append to Bronze files, then merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gantry.functions.telemetry import event_date, parse_event_time
from gantry.operators.merge import latest_per_key
from gantry.plans.stages import to_bronze
from gantry.schema import BRONZE, INGESTED_AT, MESSAGE_ID
from gantry.sources.landing import parse_lines
from gantry.sources.scratch import staged
from gantry.sources.tables import read_table, table_exists, upsert


def landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landing files as they arrive, malformed lines included."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_lines(reader.text(path))


def appended(stream: DataFrame, target_path: str, checkpoint_path: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet files: what there is now, or a micro-batch ``every`` so often."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
        .trigger(**trigger)
        .start(target_path)
    )


def stream_ingest(
    spark: SparkSession,
    raw_data_path: str,
    target_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append all landing files not taken yet, then stop; with ``every``, go on as files arrive.

    The checkpoint remembers which files were taken and the file sink commits
    each micro-batch once, so running it again adds nothing.
    """
    rows = to_bronze(landing_stream(spark, raw_data_path, max_files_per_trigger))
    return appended(rows, target_path, checkpoint_path, every)


def _not_merged_yet(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows without an id that the table does not hold with the same ingestion instant, copy by copy.

    Only rows without an id, as new as the batch, are read of the table.
    """
    since = rows.agg(F.min(INGESTED_AT)).first()[0]
    if since is None:
        return rows
    there = table.where(F.col(MESSAGE_ID).isNull() & (F.col(INGESTED_AT) >= F.lit(since)))
    return rows.exceptAll(there.select(rows.columns))


def merge_appended(
    spark: SparkSession, appended_path: str, target_path: str, checkpoint_path: str
) -> StreamingQuery:
    """Merge what :func:`stream_ingest` appended since the last call, then stop.

    Appending may repeat a message id, which a merge would refuse, so the latest
    row of each message in the batch is merged. What has been taken is known to the
    checkpoint alone. A batch that is replayed, after a crash or from a new checkpoint,
    changes nothing: rows with an id replace themselves, and of those without one only what
    the table does not hold yet is added. The merge runs in the caller's session, because a
    streaming query's own session plans without adaptive execution.
    """

    def merge(batch: DataFrame, number: int) -> None:
        with staged(latest_per_key(batch, MESSAGE_ID, INGESTED_AT, parse_event_time()), spark) as latest:
            rows = latest
            if table_exists(spark, target_path):
                without_id = latest.where(F.col(MESSAGE_ID).isNull())
                new = _not_merged_yet(without_id, read_table(spark, target_path))
                rows = latest.where(F.col(MESSAGE_ID).isNotNull()).unionByName(new)
            upsert(rows, target_path, MESSAGE_ID, event_date())

    return (
        spark.readStream.schema(BRONZE)
        .parquet(appended_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
