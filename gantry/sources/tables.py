"""Tables as Parquet folders that are only ever added to.

``<path>/_snapshot=<n>/[_event_date=<d>/]part-*``  data, written once
``<path>/_snapshots/<n>.json``                     folders that make up version n

A version becomes visible when its small file appears, after Spark has committed
the data; a write that dies before that leaves a folder nobody reads, and the
next write takes a new number. Nothing is overwritten in place, so a table may be
an input of the plan that produces its next version. One writer per table.

A table split by event day lets a merge rewrite only the days it touches:
the new version names the rewritten folders and, for every other day, the old
ones. An unsplit table is rewritten whole.
"""

from __future__ import annotations

import bisect
import datetime
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantry.operators.merge import checked_merge, has_unique_keys, quoted
from gantry.sources.files import folder_names, read_text, write_text_once

# Not names a telemetry field is likely to have.
EVENT_DATE = "_event_date"
_SNAPSHOT = "_snapshot"
_NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Snapshot:
    number: int
    schema: T.StructType
    by_date: bool
    folders: list[str]
    # What this table already contains: [table id, version] of an upstream table by its path.
    consumed: dict[str, list]
    # The key no two rows share, where that is known.
    unique_key: str | None
    # Made anew when a table is created, also where there has been one before.
    table: str

    def seen(self) -> list:
        """What a table that has read this version remembers of it."""
        return [self.table, self.number]


def _load(spark: SparkSession, path: str, number: int) -> Snapshot:
    raw = json.loads(read_text(spark, f"{path}/_snapshots/{number}.json"))
    schema = T.StructType.fromJson(raw.pop("schema"))
    return Snapshot(number=number, schema=schema, **raw)


def latest_snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest complete version of a table, or None if there is no table."""
    numbers = [
        int(name.removesuffix(".json"))
        for name in folder_names(spark, f"{path}/_snapshots")
        if name.endswith(".json") and not name.startswith(".")
    ]
    return _load(spark, path, max(numbers)) if numbers else None


def table_exists(spark: SparkSession, path: str) -> bool:
    return latest_snapshot(spark, path) is not None


def _scan(spark: SparkSession, path: str, snapshot: Snapshot, folders: list[str]) -> DataFrame:
    """The named folders of a version, with the event day if it is split by it."""
    extra = [T.StructField(EVENT_DATE, T.DateType())] if snapshot.by_date else []
    schema = T.StructType([*snapshot.schema.fields, *extra])
    if not folders:
        return spark.createDataFrame([], schema)
    files = T.StructType([*schema.fields, T.StructField(_SNAPSHOT, T.IntegerType())])
    reader = spark.read.schema(files).option("basePath", path)
    rows = reader.parquet(*(f"{path}/{f}" for f in folders))
    return rows.select([quoted(name) for name in schema.fieldNames()])


def _existing(spark: SparkSession, path: str) -> Snapshot:
    snapshot = latest_snapshot(spark, path)
    if snapshot is None:
        raise FileNotFoundError(f"no table at {path}")
    return snapshot


def read_table(spark: SparkSession, path: str, with_event_date: bool = False) -> DataFrame:
    """The newest version of a table.

    ``with_event_date`` adds the day a split table is divided by (``EVENT_DATE``),
    so that a filter on it prunes folders.
    """
    snapshot = _existing(spark, path)
    df = _scan(spark, path, snapshot, snapshot.folders)
    return df if with_event_date or not snapshot.by_date else df.drop(EVENT_DATE)


def read_changes(spark: SparkSession, path: str, since: list | None) -> DataFrame:
    """Rows of the folders written after ``since``, a version given as :meth:`Snapshot.seen`.

    Every row that differs from that version is among them, along with unchanged
    rows of the same days. All rows, if there is no such version or the table has
    been created anew since.
    """
    snapshot = _existing(spark, path)
    table, number = since or [None, None]
    listed = table == snapshot.table and f"{number}.json" in folder_names(spark, f"{path}/_snapshots")
    seen = set(_load(spark, path, number).folders) if listed else set()
    df = _scan(spark, path, snapshot, [f for f in snapshot.folders if f not in seen])
    return df.drop(EVENT_DATE) if snapshot.by_date else df


def _write(df: DataFrame, path: str) -> tuple[int, list[str]]:
    """Write rows under the next free number; returns it with the new folders."""
    spark = df.sparkSession
    taken = [0]
    for name in folder_names(spark, path):
        if name.startswith(f"{_SNAPSHOT}="):
            taken.append(int(name.split("=")[1]))
    number = max(taken) + 1
    folder = f"{_SNAPSHOT}={number}"
    if EVENT_DATE not in df.columns:
        df.write.parquet(f"{path}/{folder}")
        return number, [folder]
    # Rebalancing gathers a day into few files and lets AQE split a day that
    # holds most of the rows over several tasks.
    df.hint("rebalance", EVENT_DATE).write.partitionBy(EVENT_DATE).parquet(f"{path}/{folder}")
    days = [n for n in folder_names(spark, f"{path}/{folder}") if n.startswith(f"{EVENT_DATE}=")]
    return number, [f"{folder}/{d}" for d in days]


def _announce(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    text = json.dumps(
        {
            "schema": snapshot.schema.jsonValue(),
            "by_date": snapshot.by_date,
            "folders": snapshot.folders,
            "consumed": snapshot.consumed,
            "unique_key": snapshot.unique_key,
            "table": snapshot.table,
        }
    )
    write_text_once(spark, f"{path}/_snapshots/{snapshot.number}.json", text)


def publish(
    df: DataFrame,
    path: str,
    event_date: Column | None = None,
    consumed: dict[str, list] | None = None,
    key: str | None = None,
    unique: bool = False,
    accept: Callable[[], None] | None = None,
) -> None:
    """Make ``df`` the next version of the table, whole.

    ``event_date`` splits the table by that day. Merges are faster on a table known
    to have no repeats of its ``key``; unless ``unique`` says so, the written rows
    are checked for that, reading nothing but the key. ``accept`` is called when the rows
    are written and before they are announced; if it raises, there is no new version.
    """
    spark = df.sparkSession
    dated = df if event_date is None else df.withColumn(EVENT_DATE, event_date)
    number, folders = _write(dated, path)
    if accept:
        accept()
    snapshot = Snapshot(number, df.schema, event_date is not None, folders, consumed or {}, None, uuid.uuid4().hex)
    if key is not None and (unique or has_unique_keys(_scan(spark, path, snapshot, folders), key)):
        snapshot = replace(snapshot, unique_key=key)
    _announce(spark, path, snapshot)


def _days(rows: DataFrame) -> set[str]:
    """The day folders rows belong in.

    One value per day comes to the driver, as text, since Python has no dates
    before year 1.
    """
    found = rows.select(F.col(EVENT_DATE).cast("string").alias("day")).distinct().collect()
    return {f"{EVENT_DATE}={_NULL_DATE if r.day is None else r.day}" for r in found}


def _near(folders: list[str], days: set[str], within: int) -> list[str]:
    """The folders of days up to ``within`` days before or after one of ``days``, and of no day."""

    def number(name: str) -> int | None:
        day = name.rsplit("=", 1)[1]
        return None if day == _NULL_DATE else (datetime.date.fromisoformat(day) - datetime.date(1, 1, 1)).days

    dated = sorted(n for n in map(number, days) if n is not None)

    def is_near(folder: str) -> bool:
        n = number(folder)
        at = bisect.bisect_left(dated, n - within) if n is not None else 0
        return n is None or (at < len(dated) and dated[at] <= n + within)

    return [f for f in folders if is_near(f)]


def _touched(
    spark: SparkSession, path: str, old: Snapshot, source: DataFrame, key: str, moves_within: int | None
) -> set[str]:
    """The folders a merge has to rewrite.

    Those of the source's days, and those of target rows the source matches on
    other days: a corrected timestamp moves a row, and its old day must be
    rewritten too. For the latter only the key and the day are read, of all days, or, where
    rows move by ``moves_within`` days at most, of those near a day of the source.
    """
    days = _days(source)
    touched = {f for f in old.folders if f.rsplit("/", 1)[1] in days}
    others = [f for f in old.folders if f not in touched]
    if moves_within is not None:
        others = _near(others, days, moves_within)
    if others:
        keys = source.select(quoted(key)).distinct()
        elsewhere = _scan(spark, path, old, others).select(quoted(key), EVENT_DATE)
        days = _days(elsewhere.join(keys, key, "left_semi"))
        touched |= {f for f in others if f.rsplit("/", 1)[1] in days}
    return touched


def upsert(
    df: DataFrame,
    path: str,
    key: str,
    event_date: Column | None = None,
    schema_mode: str = "strict",
    consumed: dict[str, list] | None = None,
    unique: bool = False,
    moves_within: int | None = None,
) -> None:
    """Merge a batch into the table at ``path``, or create it from the batch.

    Creating does not de-duplicate. ``event_date`` is the day expression of a
    table split by day, and must be given on every call for such a table. ``unique``
    says that the batch repeats no key, which saves checking it. ``moves_within`` promises that
    a correction moves a row by that many days at most and takes no row's date away, so the
    keys of days further off are not read: a merge then costs what it touches, however long
    the history. The batch is read
    several times; give a :func:`~gantry.sources.scratch.staged`
    one if computing it is expensive or not repeatable.
    """
    spark = df.sparkSession
    old = latest_snapshot(spark, path)
    if old is None:
        publish(df, path, event_date, consumed, key, unique)
        return
    if old.by_date != (event_date is not None):
        raise ValueError(f"{path} was created with a different split")

    batch, touched = df, set(old.folders)
    if old.by_date:
        batch = df.withColumn(EVENT_DATE, event_date)
        touched = _touched(spark, path, old, batch, key, moves_within)
    # Every target row a source key matches is in the touched folders, so the check
    # for ambiguous keys misses nothing by looking only there.
    target = _scan(spark, path, old, sorted(touched))
    merged, still_unique = checked_merge(target, batch, key, schema_mode, old.unique_key == key, unique)
    number, folders = _write(merged, path)
    _announce(
        spark,
        path,
        Snapshot(
            number,
            T.StructType([f for f in merged.schema.fields if f.name != EVENT_DATE]),
            old.by_date,
            [f for f in old.folders if f not in touched] + folders,
            {**old.consumed, **(consumed or {})},
            key if still_unique else None,
            old.table,
        ),
    )
