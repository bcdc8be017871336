"""Session settings that the library's queries are written for."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    """A session in UTC with adaptive execution; more: further settings by name."""
    b = SparkSession.builder.master(master).appName("cutlight")
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (settings | more).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share; on one machine a temporary one will do."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def shuffled(df: DataFrame) -> DataFrame:
    """df for a join that must go by shuffle: Spark takes a table exploded from a small file to be as small as that file, and would send it whole through the driver."""
    return df.hint("merge")


def spread(df: DataFrame, *keys: str, rows: int = 50_000) -> DataFrame:
    """df dealt by keys into tasks of about so many rows, at least one a core: a small file is read by one or two tasks, and what is exploded from it stays in them.

    The number is fixed, so adaptive execution does not merge them by the bytes there are before rows are exploded, and two tables spread from one by the same keys meet without a shuffle.
    """
    return df.repartition(tasks(df, rows), *keys)


def tasks(df: DataFrame, rows: int = 50_000) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows))


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: for what several branches of a plan use, so that it is computed once and plans stay short."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
