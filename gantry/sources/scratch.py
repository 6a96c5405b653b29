"""Intermediate data in the folder all executors share.

Written tables are used instead of executor-local persistence, so a lost
executor costs at most the tasks it was running. Scratch folders live as long as
the Python process that asked for them.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gantry.sources.files import remove_folder

_SETTING = "spark.checkpoint.dir"
_local_folder: str | None = None
_in_use: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a folder of its own; on a
    cluster that is an error, because executors could not see it.
    """
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="gantry-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def _tidy(spark: SparkSession) -> None:
    """Drop what is left at exit, if the session's JVM is still there to do it."""
    for path in _in_use:
        try:
            remove_folder(spark, path)
        except Exception:
            return


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, used by nothing else."""
    path = f"{shared_folder(spark)}/gantry-{uuid.uuid4().hex}"
    if not _in_use:
        atexit.register(_tidy, spark)
    _in_use.add(path)
    return path


def _written(df: DataFrame, path: str, reader: SparkSession) -> DataFrame:
    df.write.parquet(path)
    return reader.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from a written table.

    Cuts the lineage, fixes values such as the ingestion instant, and gives
    Spark the real size, so that a small result is broadcast without a hint and
    a large one is not.
    """
    return _written(df, scratch_path(df.sparkSession), df.sparkSession)


@contextmanager
def staged(df: DataFrame, reader: SparkSession | None = None) -> Iterator[DataFrame]:
    """:func:`stored` for the length of a ``with`` block.

    ``reader`` reads the rows in another session than the one that computes them.
    """
    reader = reader or df.sparkSession
    path = scratch_path(reader)
    try:
        yield _written(df, path, reader)
    finally:
        remove_folder(reader, path)
        _in_use.discard(path)
