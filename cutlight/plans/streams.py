"""Queries over the stage log as a stream, compared with their batch twins, and over subtitle text."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.registry import query
from cutlight.session import shared_dir
from cutlight.sources import subtitles as sub
from cutlight.streaming import stage_log as sl


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _log(spark: SparkSession, d: str) -> DataFrame:
    """The log with one number for the order of rows of one time."""
    x = fx.stage_log(spark, d)
    return x.select("movie_id", "event_id", "stage", "ts_us", (F.col("fingerprint") * 100000000000 + F.col("l_suppkey") * 10000000 + F.floor(F.col("l_extendedprice"))).cast("bigint").alias("seq"), "status", "fingerprint")


_SEQ = "CAST(fingerprint * 100000000000 + l_suppkey * 10000000 + floor(l_extendedprice) AS BIGINT)"


@query(with_(f"SELECT movie_id, event_id, stage, arg_max(status, (ts_us, {_SEQ})) AS status, max(ts_us) AS ts_us FROM lg GROUP BY ALL", "lg"))
def x01_stream_latest_state(spark: SparkSession, d: str) -> DataFrame:
    return sl.read_states(spark, _states(spark, d))


def _states(spark: SparkSession, d: str) -> str:
    """The log in two parts, each read by a run of its own."""
    at = _scratch(spark)
    log = _log(spark, d)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema.fields)
    for part in (0, 1):
        log.where(F.pmod("seq", F.lit(2)) == part).repartition(6, "event_id").write.mode("append").parquet(f"{at}/log")
        sl.upsert_states(sl.read_log(spark, f"{at}/log", schema), f"{at}/states", f"{at}/checkpoint", 3)
    return f"{at}/states"


@query(with_("SELECT", "lg").removesuffix("\nSELECT") + f""", st AS (SELECT movie_id, event_id, stage, max(ts_us) AS ts_us, arg_max(struct_pack(s := status, f := fingerprint), (ts_us, {_SEQ})) AS x FROM lg GROUP BY ALL),
cur AS (SELECT movie_id, event_id, arg_max(fingerprint, (ts_us, {_SEQ})) AS c FROM lg GROUP BY ALL)
SELECT movie_id, event_id, stage, ts_us, CASE WHEN x.s = 'RUNNING' THEN 'FAILED_RETRYABLE' WHEN x.s = 'COMPLETE' AND x.f <> c THEN 'STALE' ELSE x.s END AS status FROM st JOIN cur USING (movie_id, event_id)""")
def x01_stream_stage_state(spark: SparkSession, d: str) -> DataFrame:
    return sl.read_corrected(spark, _states(spark, d))


_ORDER = "ts_us, event_id, fingerprint, l_suppkey, l_extendedprice"


@query(with_(f"SELECT movie_id, status, min(ts_us) AS started, count(*) AS n FROM (SELECT *, sum(n) OVER (PARTITION BY movie_id ORDER BY {_ORDER}) AS run FROM (SELECT *, CASE WHEN lag(status) OVER (PARTITION BY movie_id ORDER BY {_ORDER}) = status THEN 0 ELSE 1 END AS n FROM lg)) WHERE starts_with(status, 'FAILED') GROUP BY movie_id, run, status HAVING count(*) >= 3", "lg"))
def x03_stream_failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    """The log in four stretches of time; after two of them the stream stops, and goes on with a stretch that it has read before."""
    at = _scratch(spark)
    by = Window.partitionBy("movie_id").orderBy("ts_us", "event_id", "fingerprint", "l_suppkey", "l_extendedprice")
    log = fx.stage_log(spark, d).withColumn("seq", F.row_number().over(by).cast("bigint"))
    log = log.withColumn("stretch", F.floor((F.col("seq") - 1) * 4 / F.max("seq").over(Window.partitionBy("movie_id")))).select("movie_id", "seq", "ts_us", "status", "stretch")
    log.write.partitionBy("stretch").parquet(f"{at}/all")
    all_ = spark.read.parquet(f"{at}/all")
    files = max(2, spark.sparkContext.defaultParallelism)  # of one stretch: a batch of the stream
    for stretches in ((0, 1), (1, 2, 3)):
        for n in stretches:
            all_.where(F.col("stretch") == n).drop("stretch").repartition(files, "movie_id").write.mode("append").parquet(f"{at}/log")
        log = sl.read_log(spark, f"{at}/log", "movie_id bigint, seq bigint, ts_us bigint, status string", files)
        sl.upsert_streaks(log, f"{at}/runs", f"{at}/checkpoint", 3)
    return sl.longest(sl.read_streaks(spark, f"{at}/runs")).select("movie_id", "status", "started", "n")


def _stamped(spark: SparkSession, d: str) -> DataFrame:
    """Events as log rows in event time, an hour made a minute, and a probe row that closes all windows before it."""
    e = fx.table(spark, d, "events").select(F.col("user_id").alias("movie_id"), F.col("event_type").alias("stage"), F.timestamp_micros(F.floor((fx.micros("ts") - 1704067200000000) / 60)).alias("ts"))
    probe = spark.range(1).select(F.lit(-1).cast("bigint").alias("movie_id"), F.lit("probe").alias("stage"), F.timestamp_micros(F.lit(10**13)).alias("ts"))
    return e.union(probe)


def _run(spark: SparkSession, d: str, make) -> DataFrame:
    """make over the stamped log as a stream, written in append mode and read back."""
    at = _scratch(spark)
    log = _stamped(spark, d)
    log.where("movie_id >= 0").write.parquet(f"{at}/log")
    log.where("movie_id < 0").write.mode("append").parquet(f"{at}/log")
    schema = "movie_id bigint, stage string, ts timestamp"
    for _ in range(2):  # the second run sees the watermark that the probe has set
        out = make(spark.readStream.schema(schema).parquet(f"{at}/log"))
        out.writeStream.format("parquet").outputMode("append").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{at}/out")


_STAMP = "st AS (SELECT user_id AS movie_id, event_type AS stage, CAST(floor((epoch_us(ts) - 1704067200000000) / 60) AS BIGINT) AS us FROM events)"


@query(f"WITH {_STAMP} SELECT movie_id, min(us) AS started_us, max(us) + 1800000000 AS stale_us, count(*) AS rows FROM (SELECT *, sum(n) OVER (PARTITION BY movie_id ORDER BY us, stage) AS run FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY movie_id ORDER BY us, stage) < 1800000000 THEN 0 ELSE 1 END AS n FROM st)) GROUP BY movie_id, run")
def x02_stream_stale_titles(spark: SparkSession, d: str) -> DataFrame:
    x = _run(spark, d, sl.stale_titles).where("movie_id >= 0")
    return x.select("movie_id", F.unix_micros("started").alias("started_us"), F.unix_micros("stale_at").alias("stale_us"), "rows")


@query(f"WITH {_STAMP} SELECT stage, us // 30000000 * 30000000 AS from_us, count(*) AS rows FROM st GROUP BY ALL")
def x04_stream_heartbeats(spark: SparkSession, d: str) -> DataFrame:
    x = _run(spark, d, sl.heartbeats).where("stage <> 'probe'")
    return x.select("stage", F.unix_micros("from").alias("from_us"), "rows")


_SRT = "srt AS (SELECT movie_id, cue_ord, printf('%02d:%02d:%02d,%03d', s // 3600, s // 60 % 60, s % 60, ms) AS a, cue_ord % 13 = 0 AS bad, trim(text, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t, s + ms / 1000 AS secs FROM (SELECT movie_id, cue_ord, text, CAST(floor(start_s) AS BIGINT) AS s, CAST(floor((start_s - floor(start_s)) * 1000 + 0.5) AS BIGINT) AS ms FROM cu))"


def _srt(spark: SparkSession, d: str) -> DataFrame:
    """One subtitle file a title: every 13th cue has a broken timing line."""
    c = fx.cues(spark, d)
    s = F.floor("start_s")
    ms = F.floor((F.col("start_s") - s) * 1000 + 0.5)
    a = F.format_string("%02d:%02d:%02d,%03d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, ms)
    block = F.concat(F.col("cue_ord").cast("string"), F.lit("\r\n"), a, F.when(F.col("cue_ord") % 13 == 0, F.lit(" -> ")).otherwise(F.lit(" --> ")), a, F.lit("\r\n"), F.col("text"))
    return c.groupBy("movie_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cue_ord", block.alias("b")))), lambda x: x["b"]), "\r\n\r\n").alias("text"))


@query(with_("SELECT", "cu").removesuffix("\nSELECT") + f", {_SRT} SELECT movie_id, row_number() OVER (PARTITION BY movie_id ORDER BY cue_ord) AS cue_ord, cue_ord AS source_index, round(secs, 3) AS start_s, t AS text FROM srt WHERE NOT bad")
def s01_subtitle_ingest(spark: SparkSession, d: str) -> DataFrame:
    cues, _ = sub.parse_blocks(_srt(spark, d), "movie_id")
    return cues.select("movie_id", "cue_ord", "source_index", F.round("start_s", 3).alias("start_s"), "text")


@query(with_("SELECT", "cu").removesuffix("\nSELECT") + f", {_SRT} SELECT movie_id, count(*) AS n, any_value('malformed timing line') AS reason FROM srt WHERE bad GROUP BY movie_id")
def s01_malformed_blocks(spark: SparkSession, d: str) -> DataFrame:
    _, bad = sub.parse_blocks(_srt(spark, d), "movie_id")
    return bad.groupBy("movie_id", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(with_("""SELECT movie_id, count(*) AS cues, count(*) FILTER (cue_ord % 17 = 0) AS bad_ids, count(*) FILTER (n > 1) AS repeated_ids, count(*) FILTER (trim(text, ' ') = '' OR cue_ord % 23 = 0) AS empty, count(*) FILTER (start_s < before) AS out_of_order FROM (SELECT *, count(*) OVER (PARTITION BY movie_id, id) AS n, lag(start_s) OVER (PARTITION BY movie_id ORDER BY cue_ord) AS before
 FROM (SELECT movie_id, cue_ord, text, CASE WHEN cue_ord % 17 = 0 THEN 'CUE_' || cue_ord WHEN cue_ord % 19 = 0 THEN printf('SRT_%06d', cue_ord - 1) ELSE cue_id END AS id, CASE WHEN cue_ord % 29 = 0 THEN start_s - 60 ELSE start_s END AS start_s FROM cu)) GROUP BY movie_id""", "cu"))
def s03_canonical_cues(spark: SparkSession, d: str) -> DataFrame:
    """Cues with foreign and repeated ids, without text, and moved to an earlier time."""
    n = F.col("cue_ord")
    id_ = F.when(n % 17 == 0, F.concat(F.lit("CUE_"), n.cast("string"))).when(n % 19 == 0, F.format_string("SRT_%06d", n - 1)).otherwise(F.col("cue_id"))
    x = fx.cues(spark, d).withColumn("cue_id", id_).withColumn("text", F.when(n % 23 != 0, F.col("text"))).withColumn("start_s", F.when(n % 29 == 0, F.col("start_s") - 60).otherwise(F.col("start_s")))
    return sub.canonical_cue_errors(x)
