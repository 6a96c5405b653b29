"""Small driver-side file operations through Spark's own Hadoop file systems.

Only folder names and files of a few kilobytes pass through here; data is read
and written by Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty if there is no such folder."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file so that readers see all of it or none of it.

    The text goes to a hidden neighbour first and is renamed into place.
    """
    fs, final = _path(spark, path)
    folder, name = path.rsplit("/", 1)
    _, pending = _path(spark, f"{folder}/.{name}.pending")
    stream = fs.create(pending, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(pending, final):
        fs.delete(pending, False)
        raise FileExistsError(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)
