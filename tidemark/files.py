"""Paths on whatever file system they name, through Hadoop's client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _resolve(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> bool:
    system, where = _resolve(spark, path)
    return system.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file as a whole: written beside, then renamed."""
    system, where = _resolve(spark, path)
    _, beside = _resolve(spark, f"{path}.new")
    out = system.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.exists(where):
        system.delete(where, False)
    if not system.rename(beside, where):
        raise OSError(f"{path} can't be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; null if there is none."""
    system, where = _resolve(spark, path)
    if not system.exists(where):
        return None
    source = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
