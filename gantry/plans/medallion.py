"""The batch run: landing files to Bronze, Silver and Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.functions.telemetry import event_date
from gantry.operators.contract import Violation, Watch
from gantry.plans.stages import to_bronze, to_dim, to_dim_latest, to_fact, to_silver
from gantry.schema import CRANE_ID, DIM_COLUMNS, EVENT_TIME, MESSAGE_ID, LakePaths
from gantry.sources.landing import read_landing
from gantry.sources.scratch import staged
from gantry.sources.tables import latest_snapshot, publish, read_changes, read_table, table_exists, upsert


def ingest_bronze(
    spark: SparkSession,
    raw_data_path: str,
    target_path: str,
    infer: bool = False,
    schema_mode: str = "strict",
    moves_within: int | None = None,
) -> None:
    """Merge the landing files into Bronze by message id.

    With ``schema_mode="evolve"`` new columns of an inferred batch are added to the table.

    An existing table is merged from a staged copy of the batch: the JSON text is
    parsed once, and all rows carry one ingestion instant.
    """
    batch = to_bronze(read_landing(spark, raw_data_path, infer))
    if not table_exists(spark, target_path):
        upsert(batch, target_path, MESSAGE_ID, event_date())
        return
    with staged(batch) as rows:
        upsert(rows, target_path, MESSAGE_ID, event_date(), schema_mode, moves_within=moves_within)


def _unseen(spark: SparkSession, source_path: str, target_path: str, incremental: bool):
    """The part of the source to merge, and what to tell the target about it.

    Rows that are only filtered or projected on their way keep the uniqueness of
    their message ids, so that is not checked again.
    """
    target, source = latest_snapshot(spark, target_path), latest_snapshot(spark, source_path)
    since = target.consumed.get(source_path) if target and incremental else None
    rows = read_changes(spark, source_path, since)
    known = {"consumed": {source_path: source.seen()}, "unique": source.unique_key == MESSAGE_ID}
    return rows, known


def cleanse_silver(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    mode: str = "fail",
    incremental: bool = False,
    schema_mode: str = "strict",
    moves_within: int | None = None,
) -> list[Violation]:
    """Merge the valid Bronze rows into Silver; returns the contract findings.

    ``mode="fail"`` stops before the table changes if the batch breaks the
    contract, ``"report"`` goes on. ``incremental`` merges only the days of Bronze
    that changed since the last merge; rows of other days are in Silver already.

    Bronze is read once: the rules are counted while the valid rows are written, to the
    new table or to the scratch copy that is then merged.
    """
    bronze, known = _unseen(spark, source_path, target_path, incremental)
    watch = Watch(to_silver(bronze), mode)
    if table_exists(spark, target_path):
        with staged(watch.rows) as rows:
            watch.accept()
            upsert(rows, target_path, MESSAGE_ID, event_date(), schema_mode, moves_within=moves_within, **known)
    else:
        publish(watch.rows, target_path, event_date(), key=MESSAGE_ID, accept=watch.accept, **known)
    return watch.findings()


def build_gold(
    spark: SparkSession,
    source_path: str,
    fact_path: str,
    dim_path: str,
    latest_wins: bool = False,
    incremental: bool = False,
    moves_within: int | None = None,
) -> None:
    """Merge Silver into the crane dimension and the telemetry fact table.

    A crane with conflicting attributes makes its merge ambiguous and fails it, unless
    ``latest_wins`` takes those of the latest reading, for which all of Silver is read
    (three columns and the time). ``incremental`` reads the days that changed.
    """
    silver = read_table(spark, source_path)
    changed, known = _unseen(spark, source_path, fact_path, incremental)
    if not table_exists(spark, dim_path):
        publish(to_dim_latest(silver) if latest_wins else to_dim(silver), dim_path, key=CRANE_ID, unique=latest_wins)
    elif latest_wins or not incremental:
        with staged(to_dim_latest(silver) if latest_wins else to_dim(silver)) as rows:
            upsert(rows, dim_path, CRANE_ID, unique=latest_wins)
    else:
        _refresh_dim(spark, silver, changed, dim_path)
    upsert(to_fact(changed), fact_path, MESSAGE_ID, F.to_date(EVENT_TIME), moves_within=moves_within, **known)


def _refresh_dim(spark: SparkSession, silver: DataFrame, changed: DataFrame, dim_path: str) -> None:
    """Merge the cranes of changed days into the dimension.

    A crane new to it has all its readings in the changed days. One with other attributes
    than the dimension's may still have those on days that did not change, so its attributes
    come from all of Silver, and are refused if they conflict; other cranes are not looked up
    there, and without any such crane Silver is not read at all.
    """
    dim = read_table(spark, dim_path)
    with staged(to_dim(changed)) as now:
        both = dim.join(now, CRANE_ID, "left_semi").select(DIM_COLUMNS).union(now).distinct()
        differing = both.groupBy(CRANE_ID).count().where("count > 1").select(CRANE_ID)
        source = now.join(dim, CRANE_ID, "left_anti")
        if not differing.isEmpty():
            again = to_dim(silver.join(differing, CRANE_ID, "left_semi"))
            source = source.join(differing, CRANE_ID, "left_anti").unionByName(again)
        with staged(source) as rows:
            if not rows.isEmpty():
                upsert(rows, dim_path, CRANE_ID)


def run_pipeline(
    spark: SparkSession,
    raw_data_path: str,
    paths: LakePaths,
    mode: str = "fail",
    incremental: bool = True,
    infer: bool = False,
    schema_mode: str = "strict",
    moves_within: int | None = None,
) -> list[Violation]:
    """Bronze, Silver, Gold in order; returns the contract findings.

    ``moves_within``: the days by which a correction moves a reading at most, if that is known
    (:func:`~gantry.sources.tables.upsert`).
    """
    ingest_bronze(spark, raw_data_path, paths.bronze, infer, schema_mode, moves_within)
    violations = cleanse_silver(spark, paths.bronze, paths.silver, mode, incremental, schema_mode, moves_within)
    build_gold(spark, paths.silver, paths.fact, paths.dim, incremental=incremental, moves_within=moves_within)
    return violations
