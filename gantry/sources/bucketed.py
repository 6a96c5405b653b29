"""Tables bucketed by their key: a merge moves the batch and not the table.

Rows are dealt into a fixed number of buckets by the key's hash when they are written, so a
join on the key finds both sides dealt alike once the batch is: only the batch is shuffled,
however large the table. The catalog says where the newest version is; a merge writes a new
folder and then points the table there, so readers see one version or the other, and those
that have begun keep the files they read. One writer per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.operators.merge import checked_merge, quoted


def _written(df: DataFrame, name: str, folder: str, key: str, buckets: int) -> None:
    """``df`` as a new bucketed table at a folder. A task adds a file to each bucket it has rows of."""
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)


def _dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows by bucket, for one file in each. What a join with buckets gives is dealt already."""
    return df.repartition(buckets, F.col(quoted(key)))


def create_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """A table of the rows, repeated keys included. It is a folder under ``path``."""
    _written(_dealt(df, key, buckets), name, f"{path}/{uuid.uuid4().hex}", key, buckets)


def bucket_count(spark: SparkSession, name: str) -> int:
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return int(described["Num Buckets"])


def merged_bucketed(
    spark: SparkSession, name: str, batch: DataFrame, key: str, schema_mode: str = "strict", unique: bool = False
) -> DataFrame:
    """The table's rows after merging the batch; nothing is written.

    ``unique`` says that neither the table nor the batch repeats a key.
    """
    # for a join with buckets Spark deals the other side alike
    table = spark.table(name)
    rows, _ = checked_merge(table, batch, key, schema_mode, target_unique=unique, source_unique=unique, small_source=False)
    return rows


def upsert_bucketed(
    batch: DataFrame,
    name: str,
    path: str,
    key: str,
    buckets: int,
    schema_mode: str = "strict",
    unique: bool = False,
    accept: Callable[[], None] | None = None,
) -> None:
    """Create the table from the batch, or merge the batch into it.

    ``accept`` is called when the new rows are written and before they become the table; what
    it raises leaves the table as it was.
    """
    spark = batch.sparkSession
    exists = spark.catalog.tableExists(name)
    buckets = bucket_count(spark, name) if exists else buckets
    rows = merged_bucketed(spark, name, batch, key, schema_mode, unique) if exists else _dealt(batch, key, buckets)
    pending = f"{name}_{uuid.uuid4().hex}"
    folder = f"{path}/{uuid.uuid4().hex}"
    _written(rows, pending, folder, key, buckets)
    try:
        if accept:
            accept()
        if not exists:
            spark.sql(f"ALTER TABLE {pending} RENAME TO {name}")
            return
        if spark.table(pending).schema != spark.table(name).schema:
            new = [f for f in spark.table(pending).schema if f.name not in spark.table(name).columns]
            for field in new:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({quoted(field.name)} {field.dataType.simpleString()})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    finally:
        if spark.catalog.tableExists(pending):
            spark.sql(f"DROP TABLE {pending}")  # the files of an external table stay
