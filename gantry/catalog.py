"""Every operator as a query over the test tables, next to its SQL counterpart.

The queries read whole tables. Those about storage (JSON, tables, merges,
streams) really write and read back, in the shared scratch folder.

The merge queries need two batches of one feed. The first load holds everything
up to its closing date; the second, which begins ten days earlier, re-sends the
overlap with corrected loads and goes on to the end, undated events included.
Together they cover every event, and updates, inserts and untouched rows all occur.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.functions.telemetry import event_date, parse_event_time
from gantry.operators.asof import as_of
from gantry.operators.contract import ContractViolation, Watch, enforce, full_report
from gantry.operators.contract import contract_report as report
from gantry.operators.merge import ambiguous_keys, merge_upsert
from gantry.operators.star import calendar, enrich_dim, on_days, star_join, visible_cranes, visible_facts
from gantry.plans import marts
from gantry.plans.medallion import run_pipeline
from gantry.plans.stages import to_bronze, to_dim, to_dim_history, to_dim_latest, to_fact, to_silver
from gantry.schema import (
    CRANE_ID,
    EVENT_TIME,
    EXTRA_FIELDS,
    LOAD,
    MESSAGE_ID,
    MODEL,
    REGION,
    TELEMETRY,
    TIMESTAMP,
    VIBRATION,
    LakePaths,
)
from gantry.sources import sample
from gantry.sources.bucketed import upsert_bucketed
from gantry.sources.landing import read_landing, write_landing
from gantry.sources.scratch import scratch_path, stored
from gantry.sources.tables import EVENT_DATE, read_table, upsert
from gantry.streaming import timed
from gantry.streaming.ingest import merge_appended
from gantry.streaming.ingest import stream_ingest as run_stream

FIRST_LOAD_ENDS = "2024-01-21"
SECOND_LOAD_STARTS = "2024-01-11"
LOAD_CORRECTION = 1000.0
REGION_MANAGER = "NATION_7"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name."""

    def register(run: Query) -> Query:
        QUERIES[name or run.__name__] = run
        ORACLES[name or run.__name__] = oracle
        return run

    return register


# ---- SQL building blocks -------------------------------------------------

_MEASURES_SQL = """
    CAST(event_id AS VARCHAR) AS message_id,
    'CRN-' || CAST(user_id AS VARCHAR) AS crane_id,
    CAST(ts AS VARCHAR) AS "timestamp",
    value * CAST(200 AS DOUBLE) AS hoist_load_kg,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) * CAST(1.1 AS DOUBLE) - CAST(5 AS DOUBLE)
        AS vibration_mm_s"""

_TELEMETRY_SQL = f"""telemetry AS (
  SELECT {_MEASURES_SQL}, c_mktsegment AS crane_model, r_name AS operational_region
  FROM events
  LEFT JOIN customer ON user_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

_SILVER_SQL = f"""{_TELEMETRY_SQL}, silver AS (
  SELECT * FROM telemetry
  WHERE message_id IS NOT NULL AND crane_id IS NOT NULL
    AND hoist_load_kg >= 0 AND hoist_load_kg <= 50000
    AND vibration_mm_s >= 0 AND vibration_mm_s <= 100
)"""

_GOLD_SQL = f"""{_SILVER_SQL}, dim AS (
  SELECT DISTINCT crane_id, crane_model, operational_region FROM silver
), fact AS (
  SELECT message_id, crane_id, TRY_CAST("timestamp" AS TIMESTAMP) AS event_time,
    hoist_load_kg, vibration_mm_s
  FROM silver
)"""

_BATCHES_SQL = f"""readings AS (SELECT {_MEASURES_SQL}, ts, event_type FROM events),
first_load AS (
  SELECT message_id, crane_id, "timestamp", hoist_load_kg, vibration_mm_s
  FROM readings WHERE ts < TIMESTAMP '{FIRST_LOAD_ENDS}'
), second_load AS (
  SELECT message_id, crane_id, "timestamp",
    hoist_load_kg + CAST({LOAD_CORRECTION} AS DOUBLE) AS hoist_load_kg, vibration_mm_s, event_type
  FROM readings WHERE ts >= TIMESTAMP '{SECOND_LOAD_STARTS}' OR ts IS NULL
)"""

#: Every so many events lack their id, time or load.
_MESSY_SQL = f"""readings AS (SELECT event_id, {_MEASURES_SQL} FROM events), messy AS (
  SELECT CASE WHEN event_id % 89 <> 0 THEN message_id END AS message_id, crane_id,
    CASE WHEN event_id % 97 <> 0 THEN "timestamp" END AS "timestamp",
    CASE WHEN event_id % 83 <> 0 THEN hoist_load_kg END AS hoist_load_kg, vibration_mm_s
  FROM readings
)"""

_UPDATED_SQL = """
SELECT t.message_id,
  CASE WHEN s.message_id IS NOT NULL THEN s.crane_id ELSE t.crane_id END AS crane_id,
  CASE WHEN s.message_id IS NOT NULL THEN s."timestamp" ELSE t."timestamp" END AS "timestamp",
  CASE WHEN s.message_id IS NOT NULL THEN s.hoist_load_kg ELSE t.hoist_load_kg END AS hoist_load_kg,
  CASE WHEN s.message_id IS NOT NULL THEN s.vibration_mm_s ELSE t.vibration_mm_s END AS vibration_mm_s
FROM first_load t LEFT JOIN second_load s ON t.message_id = s.message_id"""

_INSERTED_SQL = """
SELECT message_id, crane_id, "timestamp", hoist_load_kg, vibration_mm_s FROM second_load s
WHERE NOT EXISTS (SELECT 1 FROM first_load t WHERE t.message_id = s.message_id)"""

_MERGED_SQL = f"WITH {_BATCHES_SQL} {_UPDATED_SQL} UNION ALL {_INSERTED_SQL}"

_HEALTH_SQL = """count(*) AS readings, max(hoist_load_kg) AS max_load_kg,
  round(avg(vibration_mm_s), 6) AS avg_vibration_mm_s,
  count(*) FILTER (WHERE vibration_mm_s > 45 OR hoist_load_kg > 45000) AS anomalies"""


def _checks_sql(rows_from: str) -> str:
    """One SELECT per value rule of the contract."""
    rules = [
        ("message_id", "not_null", "message_id IS NULL"),
        ("crane_id", "not_null", "crane_id IS NULL"),
        ("timestamp", "not_null", '"timestamp" IS NULL'),
        ("hoist_load_kg", "not_null", "hoist_load_kg IS NULL"),
        ("hoist_load_kg", "at_least", "hoist_load_kg < 0"),
        ("hoist_load_kg", "at_most", "hoist_load_kg > 50000"),
        ("vibration_mm_s", "not_null", "vibration_mm_s IS NULL"),
        ("vibration_mm_s", "at_least", "vibration_mm_s < 0"),
        ("vibration_mm_s", "at_most", "vibration_mm_s > 100"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, '{check}' AS check_name, "
        f"count(*) FILTER (WHERE {failed}) AS failures, count(*) AS rows_checked FROM {rows_from}"
        for column, check, failed in rules
    )


# ---- DataFrame building blocks -------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(sample.telemetry(spark, sf_dir))


def _stored_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as a stored table, as report queries find it."""
    return stored(to_dim(_silver(spark, sf_dir)))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table; it needs no crane attributes, so no join is made for them."""
    return to_fact(to_silver(sample.readings(spark, sf_dir)))


def _first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.readings(spark, sf_dir, F.col("ts") < F.lit(FIRST_LOAD_ENDS).cast("timestamp_ntz"))


def _second_load(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    since = F.col("ts") >= F.lit(SECOND_LOAD_STARTS).cast("timestamp_ntz")
    resent = sample.readings(spark, sf_dir, since | F.col("ts").isNull(), *extra)
    return resent.withColumn(LOAD, F.col(LOAD) + F.lit(LOAD_CORRECTION))


def _run(spark: SparkSession, sf_dir: str) -> LakePaths:
    """All tables, loaded from landing files."""
    paths = LakePaths(scratch_path(spark))
    write_landing(sample.telemetry(spark, sf_dir), paths.landing)
    run_pipeline(spark, paths.landing, paths, mode="report")
    return paths


def _rounded(health: DataFrame) -> DataFrame:
    """Averages without the last digits, which depend on the order of adding."""
    return health.withColumn("avg_vibration_mm_s", F.round("avg_vibration_mm_s", 6))


def _side_by_side(spark: SparkSession, *jobs: Callable) -> list:
    """The results of jobs that do not depend on each other.

    Each alone leaves cores idle, between its stages and at their ends; those go to the others.
    """
    with ThreadPoolExecutor(len(jobs)) as threads:
        running = [threads.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [r.result() for r in running]


def _messy(spark: SparkSession, sf_dir: str, when=None) -> DataFrame:
    """Readings some of which lack their id, time or load."""
    rows = sample.readings(spark, sf_dir, when, "event_id")
    missing = {MESSAGE_ID: 89, TIMESTAMP: 97, LOAD: 83}
    return rows.withColumns(
        {c: F.when(F.col("event_id") % every != 0, F.col(c)) for c, every in missing.items()}
    ).drop("event_id")


def _plain_time(df: DataFrame, column: str = EVENT_TIME) -> DataFrame:
    """An instant as its UTC wall-clock time, the type plain SQL compares."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


# ---- scans and sinks -----------------------------------------------------


@_query(f"WITH {_TELEMETRY_SQL} SELECT * FROM telemetry")
def landing_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON sink and JSON scan, there and back."""
    landing = scratch_path(spark)
    write_landing(sample.telemetry(spark, sf_dir), landing)
    return read_landing(spark, landing).select(TELEMETRY.fieldNames())


@_query(f"WITH {_SILVER_SQL} SELECT * FROM silver")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table split by day, read back by path."""
    path = scratch_path(spark)
    upsert(_silver(spark, sf_dir), path, MESSAGE_ID, event_date())
    return read_table(spark, path)


@_query(f"WITH {_TELEMETRY_SQL} SELECT *, 'crane_iot_sensors' AS source_system FROM telemetry")
def bootstrap_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load of a table that does not exist yet."""
    path = scratch_path(spark)
    upsert(to_bronze(sample.telemetry(spark, sf_dir)), path, MESSAGE_ID, event_date())
    return read_table(spark, path).drop("ingestion_timestamp")


# ---- projections and filters ---------------------------------------------


@_query(
    f"WITH {_TELEMETRY_SQL} SELECT *, 'crane_iot_sensors' AS source_system, true AS ingested FROM telemetry"
)
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = to_bronze(sample.telemetry(spark, sf_dir))
    return bronze.withColumn("ingested", F.col("ingestion_timestamp").isNotNull()).drop("ingestion_timestamp")


@_query(
    f"""WITH {_TELEMETRY_SQL} SELECT message_id, crane_id FROM telemetry
    WHERE message_id IS NOT NULL AND crane_id IS NOT NULL"""
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample.message_ids(spark, sf_dir)
    return rows.filter(F.col(MESSAGE_ID).isNotNull() & F.col(CRANE_ID).isNotNull())


@_query(
    f"""WITH {_TELEMETRY_SQL} SELECT message_id, hoist_load_kg, vibration_mm_s FROM telemetry
    WHERE hoist_load_kg BETWEEN 0 AND 50000 AND vibration_mm_s BETWEEN 0 AND 100"""
)
def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample.readings(spark, sf_dir).select(MESSAGE_ID, LOAD, VIBRATION)
    return rows.filter(F.col(LOAD).between(0.0, 50000.0) & F.col(VIBRATION).between(0.0, 100.0))


@_query(f"WITH {_SILVER_SQL} SELECT * FROM silver")
def silver_cleanse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@_query(
    """WITH texts AS (
      SELECT event_id, 'plain' AS form, CAST(ts AS VARCHAR) AS txt FROM events
      UNION ALL SELECT event_id, 'zulu', replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z' FROM events
      UNION ALL SELECT event_id, 'date_only', CAST(CAST(ts AS DATE) AS VARCHAR) FROM events
      UNION ALL SELECT event_id, 'garbage', event_type FROM events
      UNION ALL SELECT event_id, 'empty', '' FROM events
    )
    SELECT CAST(event_id AS VARCHAR) AS message_id, form, TRY_CAST(txt AS TIMESTAMP) AS event_time FROM texts""",
    name="parse_event_time",
)
def parse_event_time_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's instant in several spellings, two of them unreadable."""
    plain = F.col("ts").cast("string")
    spellings = {
        "plain": plain,
        "zulu": F.concat(F.replace(plain, F.lit(" "), F.lit("T")), F.lit("Z")),
        "date_only": F.col("ts").cast("date").cast("string"),
        "garbage": F.col("event_type"),
        "empty": F.lit(""),
    }
    forms = F.array(*(F.struct(F.lit(n).alias("form"), c.alias("txt")) for n, c in spellings.items()))
    texts = sample.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias(MESSAGE_ID), F.inline(forms)
    )
    return _plain_time(texts.select(MESSAGE_ID, "form", parse_event_time("txt").alias(EVENT_TIME)))


# ---- merge ---------------------------------------------------------------


@_query(_MERGED_SQL, name="merge_upsert")
def merge_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids are unique in both batches."""
    first, second = _first_load(spark, sf_dir), _second_load(spark, sf_dir)
    return merge_upsert(first, second, MESSAGE_ID, unique_keys=True)


@_query(_MERGED_SQL)
def merge_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for batches too large to broadcast."""
    first, second = _first_load(spark, sf_dir), _second_load(spark, sf_dir)
    return merge_upsert(first, second, MESSAGE_ID, unique_keys=True, small_source=False)


_NULL_MERGE_SQL = f"""WITH {_MESSY_SQL}, first_load AS (SELECT * FROM messy), second_load AS (
  SELECT message_id, crane_id, "timestamp", hoist_load_kg + CAST(1000 AS DOUBLE) AS hoist_load_kg, vibration_mm_s
  FROM messy WHERE hoist_load_kg IS NULL OR hoist_load_kg > 10000)
{_UPDATED_SQL} UNION ALL {_INSERTED_SQL}"""


def _null_merge(spark: SparkSession, sf_dir: str, small: bool) -> DataFrame:
    rows = _messy(spark, sf_dir)
    source = rows.filter(F.col(LOAD).isNull() | (F.col(LOAD) > 10000.0)).withColumn(LOAD, F.col(LOAD) + 1000.0)
    return merge_upsert(rows, source, MESSAGE_ID, unique_keys=True, small_source=small)


@_query(_NULL_MERGE_SQL)
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL ids on both sides match nothing; a NULL load replaces a value."""
    return _null_merge(spark, sf_dir, small=True)


@_query(_NULL_MERGE_SQL)
def merge_null_keys_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_merge(spark, sf_dir, small=False)


@_query(f"WITH {_BATCHES_SQL} {_UPDATED_SQL}")
def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _first_load(spark, sf_dir), _second_load(spark, sf_dir)
    return merge_upsert(first, second, MESSAGE_ID, insert=False, unique_keys=True)


@_query(f"WITH {_BATCHES_SQL} SELECT * FROM first_load UNION ALL {_INSERTED_SQL}")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _first_load(spark, sf_dir), _second_load(spark, sf_dir)
    return merge_upsert(first, second, MESSAGE_ID, update=False, unique_keys=True)


@_query(_MERGED_SQL)
def merge_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, merge, and merge the same batch again, on a stored table."""
    path = scratch_path(spark)
    second = _second_load(spark, sf_dir)
    for batch in (_first_load(spark, sf_dir), second, second):
        upsert(batch, path, MESSAGE_ID, event_date())
    return read_table(spark, path)


@_query(
    """WITH models AS (
      SELECT DISTINCT 'CRN-' || CAST(user_id AS VARCHAR) AS crane_id, event_type FROM events
    ), master AS (SELECT 'CRN-' || CAST(c_custkey AS VARCHAR) AS crane_id FROM customer)
    SELECT crane_id, count(*) AS copies FROM models
    WHERE crane_id IN (SELECT crane_id FROM master) GROUP BY crane_id HAVING count(*) > 1"""
)
def merge_ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cranes whose conflicting models would make merging the dimension ambiguous."""
    conflicting = to_dim(sample.telemetry_by_kind(spark, sf_dir))
    return ambiguous_keys(sample.crane_master(spark, sf_dir), conflicting, CRANE_ID)


@_query(
    f"""WITH {_BATCHES_SQL}
    SELECT t.message_id,
      CASE WHEN s.message_id IS NOT NULL THEN s.hoist_load_kg ELSE t.hoist_load_kg END AS hoist_load_kg,
      t.vibration_mm_s, s.event_type
    FROM first_load t LEFT JOIN second_load s ON t.message_id = s.message_id
    UNION ALL
    SELECT message_id, hoist_load_kg, CAST(NULL AS DOUBLE), event_type FROM second_load s
    WHERE NOT EXISTS (SELECT 1 FROM first_load t WHERE t.message_id = s.message_id)"""
)
def merge_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch has lost the vibration column and gained the event type."""
    target = _first_load(spark, sf_dir).select(MESSAGE_ID, LOAD, VIBRATION)
    source = _second_load(spark, sf_dir, "event_type").select(MESSAGE_ID, LOAD, "event_type")
    return merge_upsert(target, source, MESSAGE_ID, schema_mode="evolve", unique_keys=True)


@_query(
    f"""WITH {_BATCHES_SQL}
    SELECT t.message_id,
      CASE WHEN s.message_id IS NOT NULL THEN s.hoist_load_kg ELSE t.hoist_load_kg END AS hoist_load_kg,
      t.vibration_mm_s, s.event_type, s.crane_id
    FROM first_load t LEFT JOIN second_load s ON t.message_id = s.message_id
    UNION ALL
    SELECT message_id, hoist_load_kg, CAST(NULL AS DOUBLE), event_type, crane_id FROM second_load s
    WHERE NOT EXISTS (SELECT 1 FROM first_load t WHERE t.message_id = s.message_id)"""
)
def merge_evolve_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures in a struct: the second batch's lacks the vibration and has gained a kind and a nested origin."""
    target = _first_load(spark, sf_dir).select(MESSAGE_ID, F.struct(LOAD, VIBRATION).alias("reading"))
    origin = F.struct(CRANE_ID).alias("origin")
    source = _second_load(spark, sf_dir, "event_type").select(
        MESSAGE_ID, F.struct(F.col("event_type"), F.col(LOAD), origin).alias("reading")
    )
    merged = merge_upsert(target, source, MESSAGE_ID, schema_mode="evolve", unique_keys=True)
    parts = [f"reading.{c}" for c in (LOAD, VIBRATION, "event_type", f"origin.{CRANE_ID}")]
    return merged.select(MESSAGE_ID, *parts)


@_query(_MERGED_SQL)
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table bucketed by message id: created, merged, and merged once more with the same batch."""
    name, path = f"telemetry_{uuid.uuid4().hex}", scratch_path(spark)
    second = _second_load(spark, sf_dir)
    for batch in (_first_load(spark, sf_dir), second, second):
        upsert_bucketed(batch, name, path, MESSAGE_ID, buckets=8, unique=True)
    return spark.table(name)


# ---- layers --------------------------------------------------------------


@_query(f"WITH {_GOLD_SQL} SELECT * FROM dim")
def dim_crane(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_dim(_silver(spark, sf_dir))


@_query(f"WITH {_GOLD_SQL} SELECT * FROM fact")
def fact_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_fact(spark, sf_dir))


@_query(
    """WITH raw AS (SELECT event_id, 'CRN-' || CAST(user_id AS VARCHAR) AS crane_id, ts, event_type FROM events)
    SELECT crane_id, event_type AS crane_model, CAST(NULL AS VARCHAR) AS operational_region
    FROM (SELECT *, row_number() OVER (
            PARTITION BY crane_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS newest FROM raw)
    WHERE newest = 1"""
)
def dim_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_dim_latest(sample.telemetry_by_kind(spark, sf_dir))


@_query(
    f"""WITH {_GOLD_SQL}
    SELECT dim.*, c_name AS owner_name, c_acctbal AS owner_balance
    FROM dim LEFT JOIN customer ON dim.crane_id = 'CRN-' || CAST(c_custkey AS VARCHAR)"""
)
def dim_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_dim(to_dim(_silver(spark, sf_dir)), sample.crane_master(spark, sf_dir))


@_query(
    f"""WITH {_GOLD_SQL}
    SELECT 'bronze' AS layer, count(*) AS row_count FROM telemetry
    UNION ALL SELECT 'silver', count(*) FROM silver
    UNION ALL SELECT 'fact', count(*) FROM fact
    UNION ALL SELECT 'dim', count(*) FROM dim"""
)
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted in the stored tables of a pipeline run."""
    paths = _run(spark, sf_dir)
    layers = {"bronze": paths.bronze, "silver": paths.silver, "fact": paths.fact, "dim": paths.dim}
    return marts.layer_counts({name: read_table(spark, path) for name, path in layers.items()})


@_query(
    f"""WITH {_GOLD_SQL}
    SELECT operational_region, crane_model, {_HEALTH_SQL}
    FROM fact JOIN dim ON fact.crane_id = dim.crane_id GROUP BY operational_region, crane_model"""
)
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files through all four tables, then crane health from the star schema."""
    paths = _run(spark, sf_dir)
    fact, dim = read_table(spark, paths.fact), read_table(spark, paths.dim)
    return _rounded(marts.star_rollup(fact, dim, REGION, MODEL))


_VALID_SQL = """message_id IS NOT NULL AND crane_id IS NOT NULL
    AND hoist_load_kg BETWEEN 0 AND 50000 AND vibration_mm_s BETWEEN 0 AND 100"""


@_query(
    f"""WITH dated AS (SELECT event_id, ts, {_MEASURES_SQL} FROM events), messy AS (
      SELECT ts, CASE WHEN event_id % 89 <> 0 THEN message_id END AS message_id, crane_id,
        CASE WHEN event_id % 97 <> 0 THEN "timestamp" END AS "timestamp",
        CASE WHEN event_id % 83 <> 0 THEN hoist_load_kg END AS hoist_load_kg, vibration_mm_s
      FROM dated
    ), first_load AS (
      SELECT * FROM (SELECT message_id, crane_id, "timestamp", hoist_load_kg, vibration_mm_s FROM dated
                     WHERE ts < TIMESTAMP '{FIRST_LOAD_ENDS}') WHERE {_VALID_SQL}
    ), second_load AS (
      SELECT * FROM (SELECT message_id, crane_id, "timestamp",
                       hoist_load_kg + CAST({LOAD_CORRECTION} AS DOUBLE) AS hoist_load_kg, vibration_mm_s FROM messy
                     WHERE ts >= TIMESTAMP '{SECOND_LOAD_STARTS}' OR ts IS NULL) WHERE {_VALID_SQL}
    ), silver AS ({_UPDATED_SQL} UNION ALL {_INSERTED_SQL})
    SELECT message_id, crane_id, TRY_CAST("timestamp" AS TIMESTAMP) AS event_time, hoist_load_kg, vibration_mm_s,
      incremental FROM silver CROSS JOIN (VALUES (true), (false)) AS runs(incremental)"""
)
def medallion_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table after a second day: corrections, undated rows, rows without id, a broken line.

    Merging only the days that changed must give the same as merging all.
    """
    since = F.col("ts") >= F.lit(SECOND_LOAD_STARTS).cast("timestamp_ntz")
    second = _messy(spark, sf_dir, since | F.col("ts").isNull())
    second = second.withColumn(LOAD, F.col(LOAD) + F.lit(LOAD_CORRECTION))
    base = scratch_path(spark)
    landings = (_first_load(spark, sf_dir), f"{base}/day_1"), (second, f"{base}/day_2")
    _side_by_side(spark, *(partial(write_landing, *landing) for landing in landings))
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(f"{base}/day_2")

    def lake(incremental: bool) -> DataFrame:
        paths = LakePaths(f"{base}/{'incremental' if incremental else 'full'}")
        for day in ("day_1", "day_2"):
            run_pipeline(spark, f"{base}/{day}", paths, mode="report", incremental=incremental)
        return read_table(spark, paths.fact).withColumn("incremental", F.lit(incremental))

    facts = _side_by_side(spark, partial(lake, True), partial(lake, False))
    return _plain_time(facts[0].union(facts[1]))


@_query(
    f"""WITH {_BATCHES_SQL}, old AS (SELECT * FROM first_load WHERE {_VALID_SQL}),
    new AS (SELECT * FROM second_load WHERE {_VALID_SQL})
    SELECT old.message_id, coalesce(new.hoist_load_kg, old.hoist_load_kg) AS hoist_load_kg, new.event_type
    FROM old LEFT JOIN new ON old.message_id = new.message_id
    UNION ALL SELECT message_id, hoist_load_kg, event_type FROM new
    WHERE message_id NOT IN (SELECT message_id FROM old)"""
)
def medallion_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a second batch brought a field the tables did not have."""
    base = scratch_path(spark)
    write_landing(_first_load(spark, sf_dir).withColumn(MODEL, F.lit("M")).withColumn(REGION, F.lit("R")), f"{base}/day_1")
    second = _second_load(spark, sf_dir, "event_type").withColumn(MODEL, F.lit("M")).withColumn(REGION, F.lit("R"))
    write_landing(second, f"{base}/day_2")
    paths = LakePaths(f"{base}/lake")
    for day in ("day_1", "day_2"):
        run_pipeline(spark, f"{base}/{day}", paths, mode="report", infer=True, schema_mode="evolve")
    return read_table(spark, paths.silver).select(MESSAGE_ID, LOAD, "event_type")


@_query(
    """SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS firmware FROM events"""
)
def landing_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field outside the schema, through the landing files and kept beside the known ones."""
    landing = scratch_path(spark)
    rows = sample.readings(spark, sf_dir, None, "event_type").withColumnRenamed("event_type", "firmware")
    write_landing(rows, landing)
    kept = F.get_json_object(EXTRA_FIELDS, "$.firmware")
    return to_bronze(read_landing(spark, landing)).select(MESSAGE_ID, kept.alias("firmware"))


@_query("""SELECT CAST(event_id AS VARCHAR) AS message_id, event_id AS firmware, value > 25 AS heavy FROM events""")
def landing_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types taken from the files: a whole number, a truth value and a nested object."""
    landing = scratch_path(spark)
    events = sample.table(spark, sf_dir, "events")
    write_landing(
        events.select(
            F.col("event_id").cast("string").alias(MESSAGE_ID),
            F.col("event_id").alias("firmware"),
            F.struct((F.col("value") > 25).alias("heavy")).alias("state"),
        ),
        landing,
    )
    return read_landing(spark, landing, infer=True).select(MESSAGE_ID, "firmware", "state.heavy")


@_query(f"WITH {_GOLD_SQL} SELECT * FROM dim")
def dim_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after two days, the second of which reads the changed days of Silver only."""
    rows = sample.telemetry(spark, sf_dir)
    first = F.col(TIMESTAMP) < F.lit(FIRST_LOAD_ENDS)
    paths = LakePaths(scratch_path(spark))
    for day, when in enumerate((first, ~first | F.col(TIMESTAMP).isNull())):
        write_landing(rows.filter(when), f"{paths.base}/day_{day}")
        run_pipeline(spark, f"{paths.base}/day_{day}", paths, mode="report")
    return read_table(spark, paths.dim)


# ---- contract ------------------------------------------------------------


@_query(f"WITH {_SILVER_SQL} {_checks_sql('silver')}")
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All value rules over the cleansed rows."""
    return report(to_silver(sample.readings(spark, sf_dir)))


@_query(f"WITH {_TELEMETRY_SQL} {_checks_sql('telemetry')}")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules over raw rows: why readings are dropped."""
    return report(sample.readings(spark, sf_dir))


@_query(
    f"""WITH {_MESSY_SQL}, checked AS (SELECT * FROM messy)
    SELECT * FROM ({_checks_sql('checked')}) WHERE column_name NOT IN ('crane_id', 'hoist_load_kg')
    UNION ALL SELECT 'crane_id', 'present', CAST(NULL AS BIGINT), count(*) FROM messy
    UNION ALL SELECT 'hoist_load_kg', 'type double', CAST(NULL AS BIGINT), count(*) FROM messy"""
)
def contract_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with NULLs, without the crane, and with the load as text."""
    rows = _messy(spark, sf_dir).drop(CRANE_ID)
    return full_report(rows.withColumn(LOAD, F.col(LOAD).cast("string")))


@_query(f"WITH {_MESSY_SQL} {_checks_sql('messy')}")
def reject_counts_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why readings are dropped, among rows with NULL ids, times and measures."""
    return report(_messy(spark, sf_dir))


@_query(
    f"""WITH {_MESSY_SQL} SELECT * FROM messy WHERE message_id IS NOT NULL AND crane_id IS NOT NULL
      AND hoist_load_kg BETWEEN 0 AND 50000 AND vibration_mm_s BETWEEN 0 AND 100"""
)
def silver_cleanse_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(_messy(spark, sf_dir))


@_query(f"WITH {_SILVER_SQL} {_checks_sql('silver')}")
def contract_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same findings as the report, counted while the rows are written."""
    watch = Watch(to_silver(sample.readings(spark, sf_dir)), mode="report")
    stored(watch.rows)
    schema = "column_name string, check_name string, failures long, rows_checked long"
    return spark.createDataFrame(watch.report(), schema)


@_query(f"WITH {_MESSY_SQL} SELECT column_name, check_name, failures FROM ({_checks_sql('messy')}) WHERE failures > 0")
def contract_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eager validation: what the refusal of a batch that breaks the contract says."""
    found = []
    try:
        enforce(_messy(spark, sf_dir), mode="fail")
    except ContractViolation as refusal:
        found = [(v.column, v.check, v.failures) for v in refusal.violations]
    return spark.createDataFrame(found, "column_name string, check_name string, failures long")


# ---- streaming -----------------------------------------------------------


@_query(f"WITH {_TELEMETRY_SQL} SELECT *, 'crane_iot_sensors' AS source_system FROM telemetry")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files taken by a stream; the second run finds nothing new."""
    base = scratch_path(spark)
    write_landing(sample.telemetry(spark, sf_dir), f"{base}/landing")
    for _ in range(2):
        run_stream(spark, f"{base}/landing", f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select(*TELEMETRY.fieldNames(), "source_system")


@_query(_MERGED_SQL)
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended by the stream, then merged: the later row of a message counts."""
    base = scratch_path(spark)
    for batch in (_first_load(spark, sf_dir), _second_load(spark, sf_dir)):
        batch.write.mode("append").json(f"{base}/landing")
        run_stream(spark, f"{base}/landing", f"{base}/appended", f"{base}/taken").awaitTermination()
    merge_appended(spark, f"{base}/appended", f"{base}/table", f"{base}/merged").awaitTermination()
    merged = read_table(spark, f"{base}/table")
    return merged.select(MESSAGE_ID, CRANE_ID, TIMESTAMP, LOAD, VIBRATION)


DELAY_DAYS = 5

#: Three landings: the two batches, then all events once more, every seventh under a new id.
_FEED_SQL = f"""{_BATCHES_SQL}, feed AS (
  SELECT 1 AS landed, message_id, crane_id, "timestamp", hoist_load_kg, vibration_mm_s FROM first_load
  UNION ALL SELECT 2, message_id, crane_id, "timestamp", hoist_load_kg, vibration_mm_s FROM second_load
  UNION ALL SELECT 3, CASE WHEN CAST(message_id AS BIGINT) % 7 = 0 THEN 'again-' || message_id ELSE message_id END,
    crane_id, "timestamp", hoist_load_kg + CAST(2000 AS DOUBLE), vibration_mm_s FROM readings
), marks AS (
  SELECT landed + 1 AS landed, max(date_trunc('millisecond', CAST("timestamp" AS TIMESTAMP))) - INTERVAL {DELAY_DAYS} DAY AS mark
  FROM (SELECT f.landed AS row_landed, n.landed, "timestamp" FROM feed f JOIN (VALUES (1), (2)) n(landed) ON f.landed <= n.landed)
  GROUP BY landed
), judged AS (
  SELECT feed.*, mark IS NOT NULL AND CAST("timestamp" AS TIMESTAMP) <= mark AS late
  FROM feed LEFT JOIN marks ON feed.landed = marks.landed
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY landed) AS copy FROM judged
  WHERE late IS DISTINCT FROM true AND "timestamp" IS NOT NULL
)"""


def _distinct_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[timed.StreamCounts]]:
    base = scratch_path(spark)
    again = sample.readings(spark, sf_dir).withColumn(LOAD, F.col(LOAD) + F.lit(2000.0))
    renamed = F.when(F.col(MESSAGE_ID).cast("long") % 7 == 0, F.concat(F.lit("again-"), MESSAGE_ID)).otherwise(F.col(MESSAGE_ID))
    counts = []
    for batch in (_first_load(spark, sf_dir), _second_load(spark, sf_dir), again.withColumn(MESSAGE_ID, renamed)):
        batch.write.mode("append").json(f"{base}/landing")
        query = timed.stream_distinct(spark, f"{base}/landing", f"{base}/table", f"{base}/checkpoint", f"{DELAY_DAYS} days")
        query.awaitTermination()
        counts.append(timed.stream_counts(query))
    return spark.read.parquet(f"{base}/table"), counts


@_query(
    f"""WITH {_FEED_SQL}
    SELECT message_id, crane_id, "timestamp", hoist_load_kg, vibration_mm_s FROM numbered WHERE copy = 1
    UNION ALL SELECT message_id, crane_id, "timestamp", hoist_load_kg, vibration_mm_s FROM feed WHERE "timestamp" IS NULL"""
)
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message once, over three runs of one query; what comes too late is left out."""
    rows, _ = _distinct_stream(spark, sf_dir)
    return rows.select(MESSAGE_ID, CRANE_ID, TIMESTAMP, LOAD, VIBRATION)


@_query(
    f"""WITH {_FEED_SQL}
    SELECT landed, count(*) AS row_count, count(*) FILTER (WHERE late) AS late,
      count(*) FILTER (WHERE copy > 1) AS repeated
    FROM (SELECT landed, late, 1 AS copy FROM judged WHERE late OR "timestamp" IS NULL
          UNION ALL SELECT landed, late, copy FROM numbered) GROUP BY landed"""
)
def stream_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the three runs counted: rows taken, rows too late, repeats."""
    _, counts = _distinct_stream(spark, sf_dir)
    rows = [(run, c.rows, c.late, c.repeated) for run, c in enumerate(counts, 1)]
    return spark.createDataFrame(rows, "landed int, row_count long, late long, repeated long")


#: A second landing that is older than the first, and a third with the rest.
_HOURS_SQL = f"""{_GOLD_SQL}, feed AS (
  SELECT *, CASE
    WHEN CAST(message_id AS BIGINT) % 3 = 0 AND event_time >= TIMESTAMP '{SECOND_LOAD_STARTS}'
      AND event_time < TIMESTAMP '{FIRST_LOAD_ENDS}' THEN 1
    WHEN CAST(message_id AS BIGINT) % 3 = 1 AND event_time < TIMESTAMP '{FIRST_LOAD_ENDS}' THEN 2 ELSE 3 END AS landed
  FROM fact
), marks AS (
  SELECT n.landed, max(date_trunc('millisecond', event_time)) - INTERVAL {DELAY_DAYS} DAY AS mark
  FROM feed JOIN (VALUES (2), (3), (4)) n(landed) ON feed.landed < n.landed GROUP BY n.landed
), timely AS (
  SELECT feed.*, date_trunc('hour', event_time) AS hour_start FROM feed LEFT JOIN marks ON feed.landed = marks.landed
  WHERE event_time IS NOT NULL AND (mark IS NULL OR date_trunc('hour', event_time) + INTERVAL 1 HOUR > mark)
)"""


@_query(
    f"""WITH {_HOURS_SQL} SELECT crane_id, hour_start, {_HEALTH_SQL} FROM timely
    WHERE hour_start + INTERVAL 1 HOUR <= (SELECT mark FROM marks WHERE landed = 4) GROUP BY crane_id, hour_start"""
)
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that three runs have closed; the second landing is older than the first."""
    base = scratch_path(spark)
    rows, number = sample.telemetry(spark, sf_dir), F.col(MESSAGE_ID).cast("long") % 3
    old = F.col(TIMESTAMP) < F.lit(FIRST_LOAD_ENDS)
    first = (number == 0) & old & (F.col(TIMESTAMP) >= F.lit(SECOND_LOAD_STARTS))
    second = (number == 1) & old
    landed = F.when(first, 1).when(second, 2).otherwise(3)
    for run in (1, 2, 3):
        rows.where(landed == run).write.mode("append").json(f"{base}/landing")
        args = (f"{base}/landing", f"{base}/hours", f"{base}/checkpoint", f"{DELAY_DAYS} days")
        timed.stream_hourly(spark, *args).awaitTermination()
    return _plain_time(_rounded(spark.read.parquet(f"{base}/hours")), "hour_start")


# ---- reports -------------------------------------------------------------


@_query(
    f"""WITH {_SILVER_SQL} SELECT message_id, crane_id, vibration_mm_s > 45 AS is_vibration_critical,
      hoist_load_kg > 45000 AS is_load_critical,
      vibration_mm_s > 45 OR hoist_load_kg > 45000 AS is_critical FROM silver"""
)
def anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = marts.anomaly_flags(to_silver(sample.readings(spark, sf_dir)))
    return flagged.select(MESSAGE_ID, CRANE_ID, "is_vibration_critical", "is_load_critical", "is_critical")


@_query(
    f"""WITH {_SILVER_SQL} SELECT crane_id,
      count(*) FILTER (WHERE vibration_mm_s > 45) AS vibration_anomalies,
      count(*) FILTER (WHERE hoist_load_kg > 45000) AS load_anomalies,
      count(*) FILTER (WHERE vibration_mm_s > 45 OR hoist_load_kg > 45000) AS total_critical_anomalies
    FROM silver GROUP BY crane_id"""
)
def anomaly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.anomaly_totals(to_silver(sample.readings(spark, sf_dir)))


@_query(
    f"""WITH {_SILVER_SQL}, counted AS (
      SELECT crane_id, count(*) AS readings,
        count(*) FILTER (WHERE vibration_mm_s > 45 OR hoist_load_kg > 45000) AS anomalies
      FROM silver GROUP BY crane_id)
    SELECT *, readings * CAST(5 AS DOUBLE) / CAST(60 AS DOUBLE) AS operating_hours,
      readings * CAST(5 AS DOUBLE) / CAST(60 AS DOUBLE) / nullif(anomalies, 0) AS mtbf_hours
    FROM counted"""
)
def mtbf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mtbf(to_silver(sample.readings(spark, sf_dir)))


@_query(
    f"""WITH {_GOLD_SQL} SELECT crane_id, date_trunc('hour', event_time) AS hour_start, {_HEALTH_SQL}
    FROM fact WHERE event_time IS NOT NULL GROUP BY crane_id, date_trunc('hour', event_time)"""
)
def crane_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_rounded(marts.crane_hourly(_fact(spark, sf_dir))), "hour_start")


@_query(
    f"""WITH {_GOLD_SQL} SELECT fact.*, crane_model, operational_region
    FROM fact JOIN dim ON fact.crane_id = dim.crane_id""",
    name="star_join",
)
def star_join_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(star_join(_fact(spark, sf_dir), _stored_dim(spark, sf_dir)))


@_query(
    f"""WITH {_GOLD_SQL} SELECT crane_model, {_HEALTH_SQL}
    FROM fact JOIN dim ON fact.crane_id = dim.crane_id GROUP BY crane_model"""
)
def star_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(marts.star_rollup(_fact(spark, sf_dir), _stored_dim(spark, sf_dir), MODEL))


@_query(
    f"""WITH {_GOLD_SQL}, grants AS (
      SELECT n_name AS user_name, r_name AS operational_region
      FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT fact.* FROM fact WHERE crane_id IN (
      SELECT crane_id FROM dim WHERE operational_region IN (
        SELECT operational_region FROM grants WHERE user_name = '{REGION_MANAGER}'))"""
)
def rls_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one regional manager sees of the fact table."""
    grants = sample.region_grants(spark, sf_dir)
    dim = _stored_dim(spark, sf_dir)
    return _plain_time(visible_facts(_fact(spark, sf_dir), dim, grants, REGION_MANAGER))


@_query(
    f"""WITH {_GOLD_SQL} SELECT * FROM dim WHERE operational_region IN (
      SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = '{REGION_MANAGER}')"""
)
def rls_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same manager sees of the dimension."""
    return visible_cranes(to_dim(_silver(spark, sf_dir)), sample.region_grants(spark, sf_dir), REGION_MANAGER)


ZONE_MANAGERS = ("NATION_6", "NATION_7", "NATION_8", "NATION_10")


@_query(
    f"""WITH RECURSIVE {_GOLD_SQL}, parents AS (
      SELECT r_name AS child, 'ZONE_' || CAST(r_regionkey % 2 AS VARCHAR) AS parent FROM region
      UNION SELECT 'ZONE_' || CAST(r_regionkey % 2 AS VARCHAR), 'WORLD' FROM region UNION SELECT 'WORLD', 'ZONE_0'
    ), reach AS (
      SELECT n_name AS user_name, CASE n_nationkey % 3 WHEN 0 THEN 'WORLD'
        WHEN 1 THEN 'ZONE_' || CAST(n_regionkey % 2 AS VARCHAR) ELSE r_name END AS place
      FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name IN {ZONE_MANAGERS}
      UNION SELECT user_name, child FROM parents JOIN reach ON parent = place
    ) SELECT DISTINCT user_name, fact.* FROM fact JOIN dim ON fact.crane_id = dim.crane_id
      JOIN reach ON operational_region = place"""
)
def rls_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What managers see whose grants are the world, zones or a region: all below, cycles or not."""
    grants, parents = sample.zone_grants(spark, sf_dir), sample.region_parents(spark, sf_dir)
    fact, dim = _fact(spark, sf_dir), _stored_dim(spark, sf_dir)
    seen = [visible_facts(fact, dim, grants, u, parents).withColumn("user_name", F.lit(u)) for u in ZONE_MANAGERS]
    return _plain_time(reduce(DataFrame.union, seen))


@_query(
    f"""WITH {_GOLD_SQL}
    SELECT operational_region, crane_model, dim.crane_id,
      GROUPING(operational_region, crane_model, dim.crane_id) AS grouped_by, {_HEALTH_SQL}
    FROM fact JOIN dim ON fact.crane_id = dim.crane_id GROUP BY CUBE (operational_region, crane_model, dim.crane_id)"""
)
def star_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every roll-up of region, model and crane at once."""
    return _rounded(marts.star_cube(_fact(spark, sf_dir), _stored_dim(spark, sf_dir)))


@_query(
    f"""WITH {_GOLD_SQL}
    SELECT fact.*, CAST(weekofyear(event_time) AS INTEGER) AS iso_week FROM fact WHERE isodow(event_time) >= 6"""
)
def weekend_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings on the weekends of the calendar; only those days of the stored fact table are read."""
    path = scratch_path(spark)
    upsert(_fact(spark, sf_dir), path, MESSAGE_ID, F.to_date(EVENT_TIME))
    dated = read_table(spark, path, with_event_date=True)
    days = stored(calendar(spark, "2024-01-01", "2024-12-31")).where("iso_weekday >= 6")
    weekend = on_days(dated, EVENT_DATE, days)
    return _plain_time(weekend.select(MESSAGE_ID, CRANE_ID, EVENT_TIME, LOAD, VIBRATION, "iso_week"))


@_query(
    f"""WITH {_GOLD_SQL}, history AS (
      SELECT 'CRN-' || CAST(user_id AS VARCHAR) AS crane_id, ts AS serviced_at, event_id AS service_id
      FROM events WHERE event_type = 'signup')
    SELECT message_id, fact.crane_id, event_time, serviced_at, service_id
    FROM fact ASOF LEFT JOIN history ON fact.crane_id = history.crane_id AND fact.event_time >= history.serviced_at"""
)
def fact_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading with the crane's service that was the latest at its time."""
    facts = _fact(spark, sf_dir).select(MESSAGE_ID, CRANE_ID, EVENT_TIME)
    joined = as_of(facts, sample.service_history(spark, sf_dir), CRANE_ID, EVENT_TIME, "serviced_at")
    return _plain_time(_plain_time(joined), "serviced_at")


_HISTORY_SQL = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id, 'CRN-' || CAST(user_id AS VARCHAR) AS crane_id, ts, event_type FROM events
), last_at AS (
  SELECT crane_id, ts, event_type FROM raw WHERE ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY crane_id, ts ORDER BY message_id DESC) = 1
), versions AS (
  SELECT crane_id, event_type AS crane_model, ts AS valid_from FROM last_at
  WINDOW w AS (PARTITION BY crane_id ORDER BY ts)
  QUALIFY row_number() OVER w = 1 OR lag(event_type) OVER w IS DISTINCT FROM event_type
)"""


@_query(
    f"""WITH {_HISTORY_SQL} SELECT *, CAST(NULL AS VARCHAR) AS operational_region,
      lead(valid_from) OVER (PARTITION BY crane_id ORDER BY valid_from) AS valid_to FROM versions"""
)
def dim_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of each crane's attributes, with their validity."""
    return _plain_time(_plain_time(to_dim_history(sample.telemetry_by_kind(spark, sf_dir)), "valid_from"), "valid_to")


@_query(
    f"""WITH {_HISTORY_SQL}
    SELECT message_id, raw.crane_id, ts AS event_time, crane_model, valid_from
    FROM raw ASOF LEFT JOIN versions ON raw.crane_id = versions.crane_id AND raw.ts >= versions.valid_from"""
)
def star_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading with its crane's attributes as they were at its time."""
    readings = sample.telemetry_by_kind(spark, sf_dir)
    facts = to_fact(readings).select(MESSAGE_ID, CRANE_ID, EVENT_TIME)
    history = to_dim_history(readings).select(CRANE_ID, MODEL, "valid_from")
    return _plain_time(_plain_time(as_of(facts, history, CRANE_ID, EVENT_TIME, "valid_from")), "valid_from")


EPISODE_GAP = "1 day"

_EPISODES_SQL = f"""{_GOLD_SQL}, critical AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL '{EPISODE_GAP}' THEN 0 ELSE 1 END AS begins
  FROM fact WHERE (vibration_mm_s > 45 OR hoist_load_kg > 45000) AND event_time IS NOT NULL
  WINDOW w AS (PARTITION BY crane_id ORDER BY event_time)
), numbered AS (
  SELECT *, CAST(sum(begins) OVER (PARTITION BY crane_id ORDER BY event_time) AS BIGINT) AS episode FROM critical
), episodes AS (
  SELECT crane_id, episode, min(event_time) AS started, max(event_time) AS ended, count(*) AS readings,
    max(hoist_load_kg) AS max_load_kg, max(vibration_mm_s) AS max_vibration_mm_s
  FROM numbered GROUP BY crane_id, episode
)"""


@_query(f"WITH {_EPISODES_SQL} SELECT * FROM episodes")
def alarm_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of critical readings with at most a day between them."""
    return _plain_time(_plain_time(marts.alarm_episodes(_fact(spark, sf_dir), EPISODE_GAP), "started"), "ended")


@_query(
    f"""WITH {_EPISODES_SQL}, counted AS (
      SELECT fact.crane_id, count(*) AS readings, any_value(coalesce(n, 0)) AS episodes
      FROM fact LEFT JOIN (SELECT crane_id, count(*) AS n FROM episodes GROUP BY crane_id) e ON fact.crane_id = e.crane_id
      GROUP BY fact.crane_id)
    SELECT *, readings * CAST(5 AS DOUBLE) / CAST(60 AS DOUBLE) AS operating_hours,
      readings * CAST(5 AS DOUBLE) / CAST(60 AS DOUBLE) / nullif(episodes, 0) AS mtbf_hours FROM counted"""
)
def mtbf_by_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mtbf_by_episode(_fact(spark, sf_dir), EPISODE_GAP)
