"""The stage log as a stream: latest states, stale titles, heartbeats. Each gives what its batch twin gives on the same rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cutlight.operators.operations import stage_state
from cutlight.sources.versions import closed, drop

#: How late a row may come where time closes a window (latest states take rows of any age).
LATENESS = "10 minutes"


def read_log(spark: SparkSession, path: str, schema: str, files: int = 2) -> DataFrame:
    """The log's Parquet files as a stream, so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def latest(rows: DataFrame) -> DataFrame:
    """movie_id, event_id, stage, ts_us, seq, status, fingerprint: the row of each stage with the greatest (ts_us, seq)."""
    g = rows.groupBy("movie_id", "event_id", "stage").agg(F.max(F.struct("ts_us", "seq", "status", "fingerprint")).alias("s"))
    return g.select("movie_id", "event_id", "stage", "s.*")


#: Batches whose rows stand by themselves before they are merged into one base.
DELTAS = 8


def upsert_states(log: DataFrame, target: str, checkpoint: str, deltas: int = DELTAS) -> None:
    """Reduce each micro-batch of all there is to the latest row a stage, under target.

    target holds one base (the latest rows of all batches up to its number) and a delta for each batch behind it; every
    deltas batches they become the next base, and what it replaces goes. So what is read and kept follows the number of stages, not that
    of batches. State is the greatest (ts_us, seq): neither the order of arrival nor a replayed batch changes it; a batch that
    runs again writes over its own delta, or is in the base already. A base that was not closed is not read.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bases = closed(spark, target, "base")
        if bases and number <= bases[-1]:
            return
        latest(batch).write.mode("overwrite").parquet(f"{target}/delta={number}")
        waiting = [n for n in closed(spark, target, "delta") if not bases or n > bases[-1]]
        if len(waiting) >= deltas:
            _latest(spark, target).write.mode("overwrite").parquet(f"{target}/base={number}")
            for kind, numbers in (("delta", closed(spark, target, "delta")), ("base", bases[:-1])):
                for n in numbers:
                    drop(spark, f"{target}/{kind}={n}")

    log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


_STATE = "movie_id bigint, event_id bigint, stage string, ts_us bigint, seq bigint, status string, fingerprint bigint"


def _parts(spark: SparkSession, target: str) -> list[str]:
    bases = closed(spark, target, "base")
    return [f"{target}/base={n}" for n in bases[-1:]] + [f"{target}/delta={n}" for n in closed(spark, target, "delta") if not bases or n > bases[-1]]


def _latest(spark: SparkSession, target: str) -> DataFrame:
    """The latest row a stage; a base or a delta that stands alone holds one row a stage as it is."""
    parts = _parts(spark, target)
    if not parts:
        return spark.createDataFrame([], _STATE)
    rows = spark.read.schema(_STATE).parquet(*parts)
    return latest(rows) if len(parts) > 1 else rows


def read_states(spark: SparkSession, target: str) -> DataFrame:
    """movie_id, event_id, stage, status, ts_us: the latest of what upsert_states has written, as the log says it."""
    return _latest(spark, target).select("movie_id", "event_id", "stage", "status", "ts_us")


def read_corrected(spark: SparkSession, target: str) -> DataFrame:
    """read_states with the corrections of operations.stage_state: an event's latest row is the latest of its stages."""
    return stage_state(_latest(spark, target), ["seq"])


def failure_streaks(log: DataFrame, least: int = 5, forget: str | None = None) -> DataFrame:
    """Runs of identical failures in each title's log, unbroken by anything else, as they grow: movie_id, run, status, started, n.

    log: movie_id, seq (rising in a title's log), ts_us, status. A keyed state holds a title's open run and the seq it has read: rows up to it
    have been counted and are skipped, so a replay changes nothing. A run of at least least rows has a row for each batch that lengthens it; the
    greatest n is its length. forget ("30 days"): a title without rows for so long loses its state; for streams that run on, as one that
    stops at the end of its input would wait for that time.
    """
    wait = int(pd.Timedelta(forget).total_seconds() * 1000) if forget else None

    def step(key: tuple, chunks, state):
        if state.hasTimedOut:
            state.remove()
            return
        seq, status, started, n, run = state.get if state.exists else (-1, None, 0, 0, 0)
        rows = pd.concat(list(chunks))
        rows = rows[rows["seq"] > seq].drop_duplicates("seq").sort_values("seq")
        out = []
        for at, ts, now in zip(rows["seq"].tolist(), rows["ts_us"].tolist(), rows["status"].tolist(), strict=True):
            if now == status:
                n += 1
            else:
                if n >= least and status.startswith("FAILED"):
                    out.append((key[0], run, status, started, n))
                status, started, n, run = now, ts, 1, run + 1
            seq = at
        if n >= least and status.startswith("FAILED"):
            out.append((key[0], run, status, started, n))
        state.update((seq, status, started, n, run))
        if wait:
            state.setTimeoutDuration(wait)
        yield pd.DataFrame(out, columns=["movie_id", "run", "status", "started", "n"])

    keyed = log.select("movie_id", "seq", "ts_us", "status").groupBy("movie_id")
    kind = "seq bigint, status string, started bigint, n bigint, run bigint"
    return keyed.applyInPandasWithState(step, "movie_id bigint, run bigint, status string, started bigint, n bigint", kind, "append", GroupStateTimeout.ProcessingTimeTimeout if forget else GroupStateTimeout.NoTimeout)


_STREAK = "movie_id bigint, run bigint, status string, started bigint, n bigint, seq bigint"


def upsert_streaks(log: DataFrame, target: str, checkpoint: str, least: int = 5) -> None:
    """What failure_streaks puts out, under target, of all there is, without Python: for logs of many titles with few rows a batch each.

    A batch and the titles' open runs after the batch before it meet by one shuffle on the title; windows number the runs. Each batch writes its streaks
    and all open runs; of these only the last two are kept. A batch that runs again reads the open runs before it, so it writes the same.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [n for n in closed(spark, target, "runs") if n < number]
        at = f"{target}/runs={before[-1]}/kind=open" if before else None
        state = spark.read.schema(_STREAK).parquet(at) if at else spark.createDataFrame([], _STREAK)
        one = F.lit(1).cast("bigint").alias("n")
        rows = batch.select("movie_id", F.lit(None).cast("bigint").alias("run"), "status", F.col("ts_us").alias("started"), one, "seq")
        title = Window.partitionBy("movie_id")
        by = title.orderBy("seq")
        x = state.unionByName(rows).withColumn("read", F.max(F.when(F.col("run").isNotNull(), F.col("seq"))).over(title))
        x = x.where(F.col("run").isNotNull() | F.col("read").isNull() | (F.col("seq") > F.col("read")))
        x = x.withColumn("last", F.lag("seq").over(by)).where(F.col("last").isNull() | (F.col("last") != F.col("seq")))  # a row that came twice counts once
        begins = F.when(F.col("run").isNotNull() | (F.row_number().over(by) > 1) & F.col("status").eqNullSafe(F.lag("status").over(by)), 0).otherwise(1)
        x = x.withColumns({"begins": begins, "base": F.coalesce(F.max("run").over(title), F.lit(0).cast("bigint"))})
        x = x.withColumn("no", F.col("base") + F.sum("begins").over(by))
        g = x.groupBy("movie_id", F.col("no").alias("run")).agg(F.max("status").alias("status"), F.min_by("started", "seq").alias("started"), F.sum("n").alias("n"), F.max("seq").alias("seq"), F.bool_or(F.col("run").isNull()).alias("grew"))
        last = F.col("run") == F.max("run").over(title)
        kinds = F.array_compact(F.array(F.when(last, F.lit("open")), F.when(F.col("grew") & (F.col("n") >= least) & F.col("status").startswith("FAILED"), F.lit("streak"))))
        g = g.withColumn("kinds", kinds)
        g.select(*[c.split()[0] for c in _STREAK.split(", ")], F.explode("kinds").alias("kind")).write.mode("overwrite").partitionBy("kind").parquet(f"{target}/runs={number}")
        for n in before[:-1]:
            drop(spark, f"{target}/runs={n}/kind=open")

    log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_streaks(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all batches that upsert_streaks has written, as failure_streaks gives them."""
    x = spark.read.schema(f"{_STREAK}, runs bigint, kind string").parquet(target)
    return x.where("kind = 'streak'").select("movie_id", "run", "status", "started", "n")


def longest(streaks: DataFrame) -> DataFrame:
    """One row a run of what failure_streaks has put out."""
    return streaks.groupBy("movie_id", "run").agg(F.max_by("status", "n").alias("status"), F.min("started").alias("started"), F.max("n").alias("n"))


def stale_titles(log: DataFrame, after: str = "1800 seconds") -> DataFrame:
    """Closed stretches of activity: movie_id, started, stale_at (no row came until then), rows. log: movie_id, ts (timestamp)."""
    s = log.withWatermark("ts", LATENESS).groupBy("movie_id", F.session_window("ts", after).alias("w")).agg(F.count(F.lit(1)).alias("rows"))
    return s.select("movie_id", F.col("w.start").alias("started"), F.col("w.end").alias("stale_at"), "rows")


def heartbeats(log: DataFrame, every: str = "30 seconds") -> DataFrame:
    """Rows of each stage in each tumbling window: stage, from, rows. log: stage, ts (timestamp)."""
    return log.withWatermark("ts", LATENESS).groupBy("stage", F.window("ts", every).alias("w")).agg(F.count(F.lit(1)).alias("rows")).select("stage", F.col("w.start").alias("from"), "rows")


