"""Queries over requests, stage logs and batches, and set reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import operations as op
from cutlight.registry import query

_TIE = ["fingerprint", "l_suppkey", "l_extendedprice"]
_LATEST = """, st AS (SELECT movie_id, event_id, stage, max(ts_us) AS ts_us, arg_max(struct_pack(s := status, f := fingerprint), (ts_us, fingerprint, l_suppkey, l_extendedprice)) AS x FROM lg GROUP BY ALL),
cur AS (SELECT movie_id, event_id, arg_max(fingerprint, (ts_us, fingerprint, l_suppkey, l_extendedprice)) AS c FROM lg GROUP BY ALL),
state AS (SELECT movie_id, event_id, stage, ts_us, CASE WHEN x.s = 'RUNNING' THEN 'FAILED_RETRYABLE' WHEN x.s = 'COMPLETE' AND x.f <> c THEN 'STALE' ELSE x.s END AS status FROM st JOIN cur USING (movie_id, event_id))
"""


def _with_state(body: str) -> str:
    return with_("SELECT", "lg").removesuffix("\nSELECT") + _LATEST + body


def _state(spark: SparkSession, d: str) -> DataFrame:
    return op.stage_state(fx.stage_log(spark, d), _TIE)


@query(_with_state("SELECT movie_id, event_id, stage, status, ts_us FROM state"))
def l08_stage_state(spark: SparkSession, d: str) -> DataFrame:
    return _state(spark, d)


@query(_with_state("""SELECT movie_id, count(*) AS events, CAST(sum(a) AS BIGINT) AS complete, CAST(sum(b) AS BIGINT) AS stale, CAST(sum(c) AS BIGINT) AS pending, CAST(sum(e) AS BIGINT) AS failed_retryable, CAST(sum(f) AS BIGINT) AS failed_final, count(*) FILTER (a = n) AS done
FROM (SELECT movie_id, event_id, count(*) AS n, count(*) FILTER (status = 'COMPLETE') AS a, count(*) FILTER (status = 'STALE') AS b, count(*) FILTER (status = 'PENDING') AS c, count(*) FILTER (status = 'FAILED_RETRYABLE') AS e, count(*) FILTER (status = 'FAILED_FINAL') AS f FROM state GROUP BY ALL) GROUP BY movie_id"""))
def a14_status_report(spark: SparkSession, d: str) -> DataFrame:
    return op.status_report(_state(spark, d))


@query(_with_state("""SELECT stage, count(*) FILTER (status = 'COMPLETE') AS "COMPLETE", count(*) FILTER (status = 'FAILED_FINAL') AS "FAILED_FINAL", count(*) FILTER (status = 'FAILED_RETRYABLE') AS "FAILED_RETRYABLE", count(*) FILTER (status = 'PENDING') AS "PENDING", count(*) FILTER (status = 'STALE') AS "STALE" FROM state GROUP BY stage"""))
def a16_stage_matrix(spark: SparkSession, d: str) -> DataFrame:
    return op.stage_matrix(_state(spark, d), list(fx.STAGES))


@query(with_("SELECT movie_id, provider, count(*) AS requests, CAST(sum(prompt) AS BIGINT) AS prompt, CAST(sum(cached) AS BIGINT) AS cached, CAST(sum(output) AS BIGINT) AS output, round(sum((greatest(prompt - cached, 0) * 0.10::DOUBLE + cached * 0.01::DOUBLE + output * 0.50::DOUBLE) / 1e6), 6) AS usd FROM rq GROUP BY ROLLUP (movie_id, provider)", "rq"))
def a13_cost_rollup(spark: SparkSession, d: str) -> DataFrame:
    return op.cost(fx.requests(spark, d)).withColumn("usd", F.round("usd", 6))


@query(with_("SELECT movie_id, t.c AS code, t.m AS message, t.n AS n FROM (SELECT movie_id, arg_max(struct_pack(c := http, m := msg, n := n), (n, -f)) AS t FROM (SELECT movie_id, http, split_part(message, ':', 1) AS msg, count(*) AS n, min(event_id) AS f FROM rq WHERE http <> 200 GROUP BY ALL) GROUP BY movie_id)", "rq"))
def a15_dominant_failure(spark: SparkSession, d: str) -> DataFrame:
    x = fx.requests(spark, d).where("http <> 200").select("movie_id", F.col("event_id").alias("ord"), F.col("http").alias("code"), F.substring_index("message", ":", 1).alias("message"))
    return op.dominant_failure(x, ["movie_id"])


@query(with_("SELECT event_id, regexp_replace(message, 'sk-[A-Za-z0-9_-]+', '[REDACTED]', 'g') AS message FROM rq", "rq"))
def v24_redaction(spark: SparkSession, d: str) -> DataFrame:
    return fx.requests(spark, d).select("event_id", op.redact(F.col("message")).alias("message"))


@query(with_("SELECT event_id, CASE WHEN http IN (401, 403) THEN 'AUTHENTICATION' WHEN http = 429 THEN 'RATE_LIMIT' WHEN http >= 500 THEN 'SERVER' WHEN http >= 400 THEN 'INVALID_REQUEST' ELSE 'NONE' END AS reason, http = 429 OR http >= 500 AS retryable, CASE WHEN http = 429 OR http >= 500 THEN CAST(regexp_extract(message, 'retry after (\\d+) s', 1) AS BIGINT) END AS retry_after, http = 429 AS quota FROM rq", "rq"))
def v25_error_classes(spark: SparkSession, d: str) -> DataFrame:
    return fx.requests(spark, d).select("event_id", op.classify_error(F.col("message")).alias("e")).select("event_id", "e.*")


_FOLD = """, r AS (SELECT movie_id, event_id, samples, bytes, out_tokens, row_number() OVER (PARTITION BY movie_id ORDER BY ts_us, event_id) AS i FROM rq WHERE samples <= 128 AND bytes <= 25000 AND out_tokens <= 24000),
f AS (SELECT movie_id, event_id, i, 1::BIGINT AS b, 1::BIGINT AS n, samples AS s, bytes AS y, out_tokens AS o FROM r WHERE i = 1
 UNION ALL SELECT r.movie_id, r.event_id, r.i, CASE WHEN q THEN b + 1 ELSE b END, CASE WHEN q THEN 1 ELSE n + 1 END, CASE WHEN q THEN samples ELSE s + samples END, CASE WHEN q THEN bytes ELSE y + bytes END, CASE WHEN q THEN out_tokens ELSE o + out_tokens END
 FROM (SELECT r.*, b, n, s, y, o, n + 1 > 8 OR s + samples > 128 OR y + bytes > 25000 OR o + out_tokens > 24000 AS q FROM f JOIN r ON r.movie_id = f.movie_id AND r.i = f.i + 1) r)
"""


def _batches(spark: SparkSession, d: str) -> DataFrame:
    return op.capacity_batches(fx.requests(spark, d), ["ts_us", "event_id"], {"samples": 128, "bytes": 25000, "out_tokens": 24000}, 8)


@query(with_("SELECT", "rq").removesuffix("\nSELECT") + _FOLD + "SELECT rq.movie_id, rq.event_id, coalesce(b, 0) AS batch FROM rq LEFT JOIN f ON f.event_id = rq.event_id")
def g16_capacity_batches(spark: SparkSession, d: str) -> DataFrame:
    return _batches(spark, d).select("movie_id", "event_id", "batch")


@query(with_("SELECT", "rq").removesuffix("\nSELECT") + _FOLD + "SELECT movie_id, count(*) AS batches, CAST(2 * sum(2 * size - 1) AS BIGINT) AS ceiling, max(size) AS largest FROM (SELECT movie_id, b, count(*) AS size FROM f GROUP BY ALL) GROUP BY movie_id")
def g17_request_plan(spark: SparkSession, d: str) -> DataFrame:
    return op.request_plan(_batches(spark, d))


@query(with_("SELECT movie_id, CASE WHEN bool_or(http = 429) THEN 'STOPPED_QUOTA' WHEN bool_or(http = 401) THEN 'STOPPED_BLOCKED' WHEN bool_or(http >= 500) THEN 'PARTIAL' ELSE 'COMPLETE' END AS status, coalesce(list(event_id ORDER BY event_id) FILTER (http = 429 OR http >= 500), []::BIGINT[]) AS pending FROM rq GROUP BY movie_id", "rq"))
def p22_stop_status(spark: SparkSession, d: str) -> DataFrame:
    return op.pipeline_stop(fx.requests(spark, d))


@query(with_("SELECT movie_id, status, min(ts_us) AS started, count(*) AS n FROM (SELECT *, sum(n) OVER (PARTITION BY movie_id ORDER BY ts_us, event_id, fingerprint, l_suppkey, l_extendedprice) AS run FROM (SELECT *, CASE WHEN lag(status) OVER (PARTITION BY movie_id ORDER BY ts_us, event_id, fingerprint, l_suppkey, l_extendedprice) = status THEN 0 ELSE 1 END AS n FROM lg)) WHERE starts_with(status, 'FAILED') GROUP BY movie_id, run, status HAVING count(*) >= 3", "lg"))
def x03_failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    return op.failure_streaks(fx.stage_log(spark, d), ["ts_us", "event_id", *_TIE], 3)


@query("SELECT k AS key, CASE WHEN a IS NULL THEN 'INSERT' WHEN b IS NULL THEN 'KEEP' WHEN a = b THEN 'REUSE' ELSE 'CONFLICT' END AS action FROM (SELECT p_partkey AS k, p_size AS a FROM part WHERE p_partkey % 3 <> 0) FULL JOIN (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS b FROM part WHERE p_partkey % 4 <> 0) USING (k)")
def l14_insert_only_merge(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("fingerprint"))
    new = p.where("key % 4 <> 0").withColumn("fingerprint", F.when(F.col("key") % 5 == 0, F.col("fingerprint") + 1).otherwise(F.col("fingerprint")))
    return op.insert_only(p.where("key % 3 <> 0"), new)


@query(with_("SELECT DISTINCT movie_id, event_id FROM lg WHERE status = 'COMPLETE' EXCEPT SELECT movie_id, event_id FROM lg WHERE status = 'FAILED_FINAL'", "lg"))
def u01_set_difference(spark: SparkSession, d: str) -> DataFrame:
    x = fx.stage_log(spark, d)
    side = lambda s: x.where(F.col("status") == s).select("movie_id", "event_id")
    return side("COMPLETE").subtract(side("FAILED_FINAL"))


@query(with_("SELECT movie_id, cue_ord FROM cu WHERE cue_ord % 10 < 4 INTERSECT SELECT movie_id, cue_ord FROM cu WHERE (cue_ord + 3) % 10 < 5", "cu"))
def u02_shared_ordinals(spark: SparkSession, d: str) -> DataFrame:
    x = fx.cues(spark, d).select("movie_id", "cue_ord")
    return x.where("cue_ord % 10 < 4").intersect(x.where("(cue_ord + 3) % 10 < 5"))


@query(with_("SELECT side, count(*) AS n FROM ((SELECT 'only_left' AS side, movie_id, event_id FROM lg WHERE status = 'COMPLETE' EXCEPT ALL SELECT 'only_left', movie_id, event_id FROM lg WHERE stage <> 'metadata') UNION ALL (SELECT 'only_right', movie_id, event_id FROM lg WHERE stage <> 'metadata' EXCEPT ALL SELECT 'only_right', movie_id, event_id FROM lg WHERE status = 'COMPLETE')) GROUP BY side", "lg"))
def u03_multiset_difference(spark: SparkSession, d: str) -> DataFrame:
    x = fx.stage_log(spark, d)
    a, b = x.where("status = 'COMPLETE'").select("movie_id", "event_id"), x.where("stage <> 'metadata'").select("movie_id", "event_id")
    both = a.exceptAll(b).withColumn("side", F.lit("only_left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_right")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"))
