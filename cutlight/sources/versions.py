"""Numbered versions of a table under one folder: kind=N subfolders, of which those count that Spark's writer has closed."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def closed(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the closed versions of a kind, rising."""
    fs, root = _at(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    numbers = [int(n.removeprefix(f"{kind}=")) for n in names if n.startswith(f"{kind}=")]
    return sorted(n for n in numbers if fs.exists(_at(spark, f"{path}/{kind}={n}/_SUCCESS")[1]))


def drop(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
