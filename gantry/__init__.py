"""Crane telemetry on Spark: JSON landing files to a Bronze/Silver/Gold star schema."""

from gantry.operators.asof import as_of
from gantry.operators.contract import TELEMETRY_CONTRACT, ContractViolation, Watch, enforce
from gantry.operators.merge import AmbiguousMergeError, merge_upsert
from gantry.plans.medallion import build_gold, cleanse_silver, ingest_bronze, run_pipeline
from gantry.schema import LakePaths
from gantry.sources.tables import read_table, table_exists, upsert
from gantry.streaming.ingest import stream_ingest
from gantry.streaming.timed import stream_distinct, stream_hourly

__all__ = [
    "AmbiguousMergeError",
    "ContractViolation",
    "LakePaths",
    "TELEMETRY_CONTRACT",
    "Watch",
    "as_of",
    "build_gold",
    "cleanse_silver",
    "enforce",
    "ingest_bronze",
    "merge_upsert",
    "read_table",
    "run_pipeline",
    "stream_distinct",
    "stream_hourly",
    "stream_ingest",
    "table_exists",
    "upsert",
]
