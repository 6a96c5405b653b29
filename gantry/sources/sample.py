"""Telemetry read out of the star-schema test tables.

Every event is a sensor message; its user is the crane, the user's customer row
gives model and region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.schema import CRANE_ID, LOAD, MESSAGE_ID, MODEL, REGION, TELEMETRY, TIMESTAMP, VIBRATION


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crane(key: str):
    return F.concat(F.lit("CRN-"), F.col(key).cast("string"))


def _vibration() -> Column:
    return F.get_json_object("props", "$.k").try_cast("double") * F.lit(1.1) - F.lit(5.0)


def _measurements() -> dict[str, Column]:
    return {
        MESSAGE_ID: F.col("event_id").cast("string"),
        CRANE_ID: _crane("user_id"),
        TIMESTAMP: F.col("ts").cast("string"),
        LOAD: F.col("value") * F.lit(200.0),
    }


def _with_vibration(events: DataFrame) -> DataFrame:
    """Events with the measure held by their JSON payload.

    A plain projection would be copied into every filter on the measure, and the
    payload parsed three times per row; what ``explode`` yields is not copied.
    """
    return events.select("*", F.explode(F.array(_vibration())).alias(VIBRATION))


def message_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message and crane ids only."""
    ids = _measurements()
    return table(spark, sf_dir, "events").select(*(ids[c].alias(c) for c in (MESSAGE_ID, CRANE_ID)))


def readings(spark: SparkSession, sf_dir: str, when: Column | None = None, *extra: str) -> DataFrame:
    """Messages with ids and measures only, no join.

    ``when`` restricts the events by their own columns, ``extra`` names further
    event columns to keep.
    """
    events = table(spark, sf_dir, "events")
    if when is not None:
        events = events.filter(when)
    named = (c.alias(n) for n, c in _measurements().items())
    return _with_vibration(events).select(*named, VIBRATION, *extra)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region names; 25 rows at every scale."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows. A message of an unknown crane keeps NULL attributes."""
    events, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    # Each table joins as a plain scan, whose size Spark knows: small ones are
    # broadcast, and the events move at most once, for the customers.
    joined = (
        _with_vibration(events)
        .join(customer, F.col("user_id") == F.col("c_custkey"), "left")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
    )
    attributes = {MODEL: F.col("c_mktsegment"), REGION: F.col("r_name")}
    return joined.withColumns({**_measurements(), **attributes}).select(TELEMETRY.fieldNames())


def telemetry_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`telemetry`, but a crane's model changes with the kind of event."""
    events = table(spark, sf_dir, "events").withColumns(
        {
            **_measurements(),
            VIBRATION: _vibration(),
            MODEL: F.col("event_type"),
            REGION: F.lit(None).cast("string"),
        }
    )
    return events.select(TELEMETRY.fieldNames())


def crane_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External master data of all cranes, seen or not."""
    return table(spark, sf_dir, "customer").select(
        _crane("c_custkey").alias(CRANE_ID),
        F.col("c_name").alias("owner_name"),
        F.col("c_acctbal").alias("owner_balance"),
    )


def region_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's manager may see the region the nation is in."""
    return regions(spark, sf_dir).select(F.col("n_name").alias("user_name"), F.col("r_name").alias(REGION))


def region_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions below zones, zones below the world, which is, by mistake, below one of them again."""
    zones = table(spark, sf_dir, "region").select("r_name", _zone("r_regionkey").alias("zone"))
    below_zone = zones.select(F.col("r_name").alias("child"), F.col("zone").alias("parent"))
    below_world = zones.select(F.col("zone").alias("child"), F.lit("WORLD").alias("parent")).distinct()
    mistake = zones.select(F.lit("WORLD").alias("child"), F.lit("ZONE_0").alias("parent")).distinct()
    return below_zone.union(below_world).union(mistake)


def _zone(key: str) -> Column:
    return F.concat(F.lit("ZONE_"), (F.col(key) % 2).cast("string"))


def zone_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's manager may see the world, the zone of its region, or the region, in turn."""
    turn = F.col("n_nationkey") % 3
    place = F.when(turn == 0, "WORLD").when(turn == 1, _zone("n_regionkey")).otherwise(F.col("r_name"))
    return regions(spark, sf_dir).select(F.col("n_name").alias("user_name"), place.alias(REGION))


def service_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services of cranes: every sign-up event is one, valid until the crane's next."""
    return table(spark, sf_dir, "events").where(F.col("event_type") == "signup").select(
        _crane("user_id").alias(CRANE_ID),
        F.col("ts").cast("timestamp").alias("serviced_at"),
        F.col("event_id").alias("service_id"),
    )
