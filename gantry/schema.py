"""Layer schemas and storage locations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Landing field names and the lineage constant.
MESSAGE_ID = "message_id"
CRANE_ID = "crane_id"
TIMESTAMP = "timestamp"
LOAD = "hoist_load_kg"
VIBRATION = "vibration_mm_s"
MODEL = "crane_model"
REGION = "operational_region"
SOURCE_SYSTEM = "crane_iot_sensors"

CORRUPT_RECORD = "_corrupt_record"
EXTRA_FIELDS = "_extra_fields"
INGESTED_AT = "ingestion_timestamp"
EVENT_TIME = "event_time"

TELEMETRY = T.StructType(
    [
        T.StructField(MESSAGE_ID, T.StringType()),
        T.StructField(CRANE_ID, T.StringType()),
        T.StructField(TIMESTAMP, T.StringType()),
        T.StructField(LOAD, T.DoubleType()),
        T.StructField(VIBRATION, T.DoubleType()),
        T.StructField(MODEL, T.StringType()),
        T.StructField(REGION, T.StringType()),
    ]
)

# What a landing file is read as: a malformed or wrongly typed line keeps its
# raw text next to whatever fields could be read, and fields not listed here are
# kept as a JSON object of texts.
PARSED = T.StructType([*TELEMETRY.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
LANDING = T.StructType([*PARSED.fields, T.StructField(EXTRA_FIELDS, T.StringType())])

BRONZE = T.StructType(
    [
        *LANDING.fields,
        T.StructField(INGESTED_AT, T.TimestampType()),
        T.StructField("source_system", T.StringType()),
    ]
)

DIM_COLUMNS = [CRANE_ID, MODEL, REGION]
FACT_COLUMNS = [MESSAGE_ID, CRANE_ID, EVENT_TIME, LOAD, VIBRATION]


@dataclass(frozen=True)
class LakePaths:
    """The four tables of one deployment, all under one base folder."""

    base: str

    @property
    def landing(self) -> str:
        return f"{self.base}/landing_zone"

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/telemetry"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/telemetry"

    @property
    def fact(self) -> str:
        return f"{self.base}/gold/fact_telemetry"

    @property
    def dim(self) -> str:
        return f"{self.base}/gold/dim_crane"
