"""Timeline tables derived from the driver's tables, and the same derivations as DuckDB SQL (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutlight.session import spread, tasks

# The vocabulary of observations.
UTILITIES = ("clear_reaction", "concrete_action", "environment", "generic_dialogue_only", "generic_presence_only", "movement", "object_activity", "physical_interaction", "strong_nonverbal_interaction", "unclear", "useful_state")
SIGNALS = ("clear_reaction", "concrete_activity", "generic_dialogue_only", "none", "physical_interaction", "strong_body_language", "unclear", "useful_environment_or_composition")
COMPLETE = ("true", "true", "false", "unclear", "true")
CONTEXT = ("low", "medium", "high", "unclear", "low")
FLAGS = ("title_card", "credits", "logo", "dominant_text", "black_or_empty", "corrupt_or_unusable")
TYPES = ("argument", "conversation", "monologue", "montage", "sparse_dialogue", "transition")
TONES = ("comic", "dramatic", "neutral", "tense")
FUNCTIONS = ("conflict", "exposition", "resolution", "revelation", "transition")
STAGES = ("grouping", "semantic", "horizontal_export", "vertical_reframe", "vertical_validation", "metadata", "finalization")
MEMBERS = ("horizontal.mp4", "metadata.json", "thumbnail.jpg", "vertical.mp4", "validation.json")
FPS = 24


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pick(values, at) -> F.Column:
    """Entry number at of a fixed list."""
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def micros(c: str) -> F.Column:
    """Microseconds since 1970 of a timestamp, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))


def cues(spark: SparkSession, d: str) -> DataFrame:
    """movie_id, cue_ord, cue_id, source_index, start_s, end_s, text."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.floor(F.col("doc_id") / 7).alias("movie_id"))
    lines = spread(docs, "movie_id", rows=2_000).select("doc_id", "movie_id", F.posexplode(F.split("text", "\n")).alias("line", "text")).where(F.trim("text") != "")
    by = Window.partitionBy("movie_id").orderBy("doc_id", "line")
    x = lines.withColumn("cue_ord", F.row_number().over(by).cast("bigint"))
    x = x.withColumn("dur", F.least(F.length("text"), F.lit(120))).withColumn("step", F.col("dur") + F.col("cue_ord") % 7 * 10)
    x = x.withColumn("end_u", F.sum("step").over(Window.partitionBy("movie_id").orderBy("cue_ord")))
    return x.select(
        "movie_id", "cue_ord", F.format_string("SRT_%06d", "cue_ord").alias("cue_id"), F.col("cue_ord").alias("source_index"),
        ((F.col("end_u") - F.col("dur")) / 20).alias("start_s"), (F.col("end_u") / 20).alias("end_s"), "text",
    )


def segments(spark: SparkSession, d: str) -> DataFrame:
    """One map for each title: five cues a segment. movie_id, segment_id, first_ord, last_ord, start_s, end_s, four enums."""
    g = cues(spark, d).groupBy("movie_id", F.floor((F.col("cue_ord") - 1) / 5).alias("n"))
    x = g.agg(F.min("cue_ord").alias("first_ord"), F.max("cue_ord").alias("last_ord"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"))
    at = F.col("first_ord") * 3
    return x.select(
        "movie_id", F.format_string("NARR_%06d", F.col("n") + 1).alias("segment_id"), "first_ord", "last_ord", "start_s", "end_s",
        pick(TYPES, at % len(TYPES)).alias("segment_type"), pick(TONES, at % len(TONES)).alias("narrative_tone"), pick(FUNCTIONS, at % len(FUNCTIONS)).alias("narrative_function"),
        F.when(F.col("first_ord") % 4 == 0, "new_interaction").otherwise("unknown").alias("continuity_next"),
    )


def shots(spark: SparkSession, d: str) -> DataFrame:
    """One shot for each event that has a successor of its user; an hour of event time is a second.

    Events are dealt by title into tasks of about 20,000: adaptive execution would merge them by their bytes, and what is exploded from shots of a title stays in its task.
    """
    e = spread(table(spark, d, "events"), "user_id", rows=20_000).withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    e = e.withColumn("start_s", (micros("ts") - 1704067200000000) / 3.6e9)
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = e.withColumn("end_s", F.lead("start_s").over(by)).withColumn("n", F.row_number().over(by)).where("end_s is not null")
    frame = lambda c: F.floor(F.col(c) * FPS + 0.5)
    k = F.col("k")
    return e.select(
        F.col("user_id").alias("movie_id"), F.col("event_id"), F.col("n").cast("bigint").alias("shot_ord"), F.format_string("FULL_SHOT_%04d", "n").alias("shot_id"), "start_s", "end_s",
        frame("start_s").alias("start_frame"), frame("end_s").alias("end_frame"), (60 + F.col("value") / 5).alias("brightness"), F.col("value").alias("sharpness"), (k / 4).alias("motion"),
        (k % 10 / 20).alias("near_black"), F.when(k % 3 != 0, k % 5).alias("setting_id"), F.when(k % 4 == 0, F.floor(k / 10)).alias("interaction_id"),
        (k == 99).alias("scene_break_after"), (k == 98).alias("scene_break_before"), (k / 100).alias("cut_score"), F.when(k % 7 == 1, F.floor(k / 20)).alias("action_id"),
        F.when(k % 6 == 2, F.floor(k / 50)).alias("scene_id"), F.when(k % 9 == 3, F.lit(1)).alias("establishing_id"), F.when(k % 2 == 0, k % 3).alias("participants"),
        F.when(k % 5 < 3, k % 4).alias("subject_id"), F.when(k % 3 == 1, k % 6).alias("composition"), (k % 8 == 5).alias("reverse_shot"), "k", "value",
    )


def dealt_shots(spark: SparkSession, d: str) -> DataFrame:
    """shots dealt by title and shot into tasks of 10,000: what is exploded from them and joined by shot then stays where it is."""
    return shots(spark, d).repartition(tasks(table(spark, d, "events"), 10_000), "movie_id", "shot_id")


def observations(spark: SparkSession, d: str) -> DataFrame:
    """One observation for each event: utility, signal, complete, context, flags (hard ones that are set), n_actions."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    i, k = F.col("event_id"), F.col("k")
    return e.select(
        F.col("user_id").alias("movie_id"), "event_id", "ts", "k", pick(UTILITIES, k % len(UTILITIES)).alias("utility"), pick(SIGNALS, (i * 7 + k) % len(SIGNALS)).alias("signal"),
        pick(COMPLETE, i % 5).alias("complete"), pick(CONTEXT, F.floor(i / 5) % 5).alias("context"),
        F.when(k < 6, F.array(pick(FLAGS, k))).otherwise(F.array().cast("array<string>")).alias("flags"), (i % 2).alias("n_actions"),
    )


def records(spark: SparkSession, d: str) -> DataFrame:
    """Up to three records of an observation: event_id, r, contract, created_us, valid."""
    e = table(spark, d, "events").select(F.col("user_id").alias("movie_id"), "event_id", micros("ts").alias("us"))
    x = e.select("movie_id", "event_id", "us", F.explode(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int"))).alias("r"))
    return x.select("movie_id", "event_id", "r", pick(("v1", "temporal_v2", "visual_reuse"), F.col("r")).alias("contract"), (F.col("us") + F.col("r") * 60000000).alias("created_us"), ((F.col("event_id") + F.col("r")) % 7 != 0).alias("valid"))


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """Detected persons: movie_id, shot_id, event_id, sample, person, x, y, w, h, confidence."""
    return boxes_of(dealt_shots(spark, d))


def boxes_of(shots: DataFrame, *more: str) -> DataFrame:
    """The boxes of these shots, and more of their columns."""
    x = shots.select("movie_id", "shot_id", "event_id", "k", "value", *more, F.explode(F.sequence(F.lit(0), F.lit(4))).alias("sample"))
    x = x.select("*", F.explode(F.sequence(F.lit(1), (1 + F.col("k") % 3).cast("int"))).alias("person"))
    w = 120 + F.col("event_id") % 5 * 40
    at = F.col("value") * 3 + 97 * F.col("person") + 11 * F.col("sample")
    return x.select("movie_id", "shot_id", "event_id", "k", *more, "sample", "person", (at - F.floor(at / 1600) * 1600).alias("x"), (F.col("k") * 7 % 500).cast("double").alias("y"), w.cast("double").alias("w"), (w * 2.5).alias("h"), (0.5 + F.col("k") % 50 / 100).alias("confidence"))


def frame_stats(spark: SparkSession, d: str) -> DataFrame:
    """Per-frame statistics: movie_id, shot_id, sample, n, s1, s2, dark, laplacian, diff_prev."""
    s = shots(spark, d).where("k <> 98")
    x = s.select("movie_id", "shot_id", "k", "value", "brightness", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("sample"))
    n, mean = 1000 + 10 * F.col("sample"), F.col("brightness") + F.col("sample")
    return x.select("movie_id", "shot_id", "sample", n.cast("bigint").alias("n"), (n * mean).alias("s1"), (n * (mean * mean + F.col("k") + 1)).alias("s2"), F.floor(F.col("k") % 10 * n / 20).alias("dark"), (F.col("value") + F.col("sample")).alias("laplacian"), F.when(F.col("sample") > 0, F.col("k") / 4 + F.col("sample")).alias("diff_prev"))


def stage_log(spark: SparkSession, d: str) -> DataFrame:
    """movie_id, event_id, stage, ts_us, status, fingerprint, and the tie-break columns."""
    x = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    f, s = F.col("l_returnflag"), F.col("l_linestatus")
    status = F.when((f == "R") & (s == "O"), "RUNNING").when(f == "R", "FAILED_RETRYABLE").when(s == "F", "COMPLETE").when(f == "A", "PENDING").otherwise("FAILED_FINAL")
    return x.select(F.col("o_custkey").alias("movie_id"), F.col("l_orderkey").alias("event_id"), pick(STAGES, F.col("l_linenumber") - 1).alias("stage"), (micros("l_shipdate") + F.col("l_linenumber").cast("bigint") * 3600000000).alias("ts_us"), status.alias("status"), F.col("l_partkey").alias("fingerprint"), "l_suppkey", "l_extendedprice")


def requests(spark: SparkSession, d: str) -> DataFrame:
    """Provider requests: movie_id, event_id, ts_us, provider, prompt, cached, output, http, message, samples, bytes, out_tokens."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    k, t = F.col("k"), F.col("event_type")
    http = F.when(t.isin("click", "view"), 200).when(t == "purchase", 429).when(t == "signup", 503).when(k % 2 == 0, 401).otherwise(400)
    prompt, samples = F.floor(F.col("value") * 10), 1 + k % 16
    e = e.withColumn("http", http)
    said = F.concat(F.lit("status "), F.col("http").cast("string"), F.lit(": retry after "), k.cast("string"), F.lit(" s"), F.when(k % 10 == 0, F.concat(F.lit(" key sk-TEST"), F.col("event_id").cast("string"))).otherwise(""))
    return e.select(F.col("user_id").alias("movie_id"), "event_id", micros("ts").alias("ts_us"), t.alias("provider"), prompt.alias("prompt"), F.floor(prompt / 4).alias("cached"), (k * 5).alias("output"), F.col("http").cast("bigint").alias("http"), said.alias("message"), samples.alias("samples"), F.floor(F.col("value") * 60).alias("bytes"), (1600 + 180 * (1 + k % 3) + 30 * samples).alias("out_tokens"))


def assets(spark: SparkSession, d: str) -> DataFrame:
    """movie_id, asset, name, size, vertical, review."""
    p = spread(table(spark, d, "part"), "p_partkey")
    return p.select((F.col("p_partkey") % 20).alias("movie_id"), F.col("p_partkey").alias("asset"), F.col("p_name").alias("name"), F.col("p_size").cast("bigint").alias("size"), F.when(F.col("p_size") % 2 == 1, "PASS").otherwise("REVIEW").alias("vertical"), pick(("PENDING", "NOT_REQUIRED", "APPROVED", "NOT_REQUIRED"), F.col("p_size") % 4).alias("review"))


def asset_files(spark: SparkSession, d: str) -> DataFrame:
    """Files there are: asset, member, name, sha, recorded_sha."""
    x = spread(table(spark, d, "part"), "p_partkey").select(F.col("p_partkey").alias("asset"), F.posexplode(F.array(*[F.lit(m) for m in MEMBERS])).alias("member", "name"))
    x = x.where(~((F.col("asset") % 11 == 0) & (F.col("member") == F.col("asset") % 5)))
    sha = F.sha2(F.concat(F.col("asset").cast("string"), F.col("name")).cast("binary"), 256)
    return x.select("asset", F.col("member").cast("bigint").alias("member"), "name", sha.alias("sha"), F.when(F.col("asset") % 13 == 0, F.concat(F.lit("x"), sha)).otherwise(sha).alias("recorded_sha"))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_K = "CAST(json_extract(props, '$.k') AS BIGINT)"
#: name -> (tables it needs, body)
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "cu_l": ((), "SELECT doc_id, doc_id // 7 AS movie_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents"),
    "cu_o": (("cu_l",), "SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY doc_id, line) AS cue_ord, least(length(text), 120) AS dur FROM cu_l WHERE trim(text, ' ') <> ''"),
    "cu_e": (("cu_o",), "SELECT *, CAST(sum(dur + cue_ord % 7 * 10) OVER (PARTITION BY movie_id ORDER BY cue_ord) AS BIGINT) AS end_u FROM cu_o"),
    "cu": (("cu_e",), "SELECT movie_id, cue_ord, printf('SRT_%06d', cue_ord) AS cue_id, cue_ord AS source_index, (end_u - dur) / 20 AS start_s, end_u / 20 AS end_s, text FROM cu_e"),
    "sg_g": (("cu",), "SELECT movie_id, (cue_ord - 1) // 5 AS n, min(cue_ord) AS first_ord, max(cue_ord) AS last_ord, min(start_s) AS start_s, max(end_s) AS end_s FROM cu GROUP BY ALL"),
    "sg": (("sg_g",), f"SELECT movie_id, printf('NARR_%06d', n + 1) AS segment_id, first_ord, last_ord, start_s, end_s, {_list(TYPES)}[first_ord * 3 % {len(TYPES)} + 1] AS segment_type, {_list(TONES)}[first_ord * 3 % {len(TONES)} + 1] AS narrative_tone, {_list(FUNCTIONS)}[first_ord * 3 % {len(FUNCTIONS)} + 1] AS narrative_function, CASE WHEN first_ord % 4 = 0 THEN 'new_interaction' ELSE 'unknown' END AS continuity_next FROM sg_g"),
    "ev": ((), f"SELECT *, {_K} AS k, epoch_us(ts) AS us FROM events"),
    "sh_e": (("ev",), "SELECT *, (us - 1704067200000000) / 3.6e9 AS start_s, (lead(us) OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1704067200000000) / 3.6e9 AS end_s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM ev"),
    "sh": (("sh_e",), "SELECT user_id AS movie_id, event_id, n AS shot_ord, printf('FULL_SHOT_%04d', n) AS shot_id, start_s, end_s, CAST(floor(start_s * 24 + 0.5) AS BIGINT) AS start_frame, CAST(floor(end_s * 24 + 0.5) AS BIGINT) AS end_frame, 60 + value / 5 AS brightness, value AS sharpness, k / 4 AS motion, k % 10 / 20 AS near_black, CASE WHEN k % 3 <> 0 THEN k % 5 END AS setting_id, CASE WHEN k % 4 = 0 THEN k // 10 END AS interaction_id, k = 99 AS scene_break_after, k = 98 AS scene_break_before, k / 100 AS cut_score, CASE WHEN k % 7 = 1 THEN k // 20 END AS action_id, CASE WHEN k % 6 = 2 THEN k // 50 END AS scene_id, CASE WHEN k % 9 = 3 THEN 1 END AS establishing_id, CASE WHEN k % 2 = 0 THEN k % 3 END AS participants, CASE WHEN k % 5 < 3 THEN k % 4 END AS subject_id, CASE WHEN k % 3 = 1 THEN k % 6 END AS composition, k % 8 = 5 AS reverse_shot, k, value FROM sh_e WHERE end_s IS NOT NULL"),
    "ob": (("ev",), f"SELECT user_id AS movie_id, event_id, ts, k, {_list(UTILITIES)}[k % {len(UTILITIES)} + 1] AS utility, {_list(SIGNALS)}[(event_id * 7 + k) % {len(SIGNALS)} + 1] AS signal, {_list(COMPLETE)}[event_id % 5 + 1] AS complete, {_list(CONTEXT)}[event_id // 5 % 5 + 1] AS context, CASE WHEN k < 6 THEN [{_list(FLAGS)}[k + 1]] ELSE []::VARCHAR[] END AS flags, event_id % 2 AS n_actions FROM ev"),
    "rec": (("ev",), "SELECT user_id AS movie_id, event_id, CAST(r AS BIGINT) AS r, ['v1', 'temporal_v2', 'visual_reuse'][r + 1] AS contract, us + r * 60000000 AS created_us, (event_id + r) % 7 <> 0 AS valid FROM ev, unnest(range(0, 3)) t(r) WHERE r <= event_id % 3"),
    "bx_p": (("sh",), "SELECT movie_id, shot_id, event_id, k, sample, person, value * 3 + 97 * person + 11 * sample AS pos, 120 + event_id % 5 * 40 AS w FROM sh, unnest(range(0, 5)) s(sample), unnest(range(1, 4)) q(person) WHERE person <= 1 + k % 3"),
    "bx": (("bx_p",), "SELECT movie_id, shot_id, event_id, k, sample, person, pos - floor(pos / 1600) * 1600 AS x, CAST(k * 7 % 500 AS DOUBLE) AS y, CAST(w AS DOUBLE) AS w, w * 2.5::DOUBLE AS h, 0.5::DOUBLE + k % 50 / 100 AS confidence FROM bx_p"),
    "fs": (("sh",), "SELECT movie_id, shot_id, sample, 1000 + 10 * sample AS n, (1000 + 10 * sample) * (brightness + sample) AS s1, (1000 + 10 * sample) * ((brightness + sample) * (brightness + sample) + k + 1) AS s2, k % 10 * (1000 + 10 * sample) // 20 AS dark, value + sample AS laplacian, CASE WHEN sample > 0 THEN k / 4 + sample END AS diff_prev FROM sh, unnest(range(0, 3)) t(sample) WHERE k <> 98"),
    "lg": ((), f"SELECT o_custkey AS movie_id, l_orderkey AS event_id, {_list(STAGES)}[l_linenumber] AS stage, epoch_us(l_shipdate) + l_linenumber * 3600000000 AS ts_us, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'RUNNING' WHEN l_returnflag = 'R' THEN 'FAILED_RETRYABLE' WHEN l_linestatus = 'F' THEN 'COMPLETE' WHEN l_returnflag = 'A' THEN 'PENDING' ELSE 'FAILED_FINAL' END AS status, l_partkey AS fingerprint, l_suppkey, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
    "rq_h": (("ev",), "SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 200 WHEN event_type = 'purchase' THEN 429 WHEN event_type = 'signup' THEN 503 WHEN k % 2 = 0 THEN 401 ELSE 400 END AS http FROM ev"),
    "rq": (("rq_h",), "SELECT user_id AS movie_id, event_id, us AS ts_us, event_type AS provider, CAST(floor(value * 10) AS BIGINT) AS prompt, CAST(floor(value * 10) AS BIGINT) // 4 AS cached, k * 5 AS output, CAST(http AS BIGINT) AS http, 'status ' || http || ': retry after ' || k || ' s' || CASE WHEN k % 10 = 0 THEN ' key sk-TEST' || event_id ELSE '' END AS message, 1 + k % 16 AS samples, CAST(floor(value * 60) AS BIGINT) AS bytes, 1600 + 180 * (1 + k % 3) + 30 * (1 + k % 16) AS out_tokens FROM rq_h"),
    "ass": ((), "SELECT p_partkey % 20 AS movie_id, p_partkey AS asset, p_name AS name, CAST(p_size AS BIGINT) AS size, CASE WHEN p_size % 2 = 1 THEN 'PASS' ELSE 'REVIEW' END AS vertical, ['PENDING', 'NOT_REQUIRED', 'APPROVED', 'NOT_REQUIRED'][p_size % 4 + 1] AS review FROM part"),
    "fil": ((), f"SELECT asset, member, name, sha, CASE WHEN asset % 13 = 0 THEN 'x' || sha ELSE sha END AS recorded_sha FROM (SELECT p_partkey AS asset, m AS member, {_list(MEMBERS)}[m + 1] AS name, sha256(p_partkey || {_list(MEMBERS)}[m + 1]) AS sha FROM part, unnest(range(0, 5)) t(m)) WHERE NOT (asset % 11 = 0 AND member = asset % 5)"),
}


#: Derivations that queries read more than once.
_SHARED = {"bx", "cu", "sh", "sg"}


def with_(sql: str, *names: str) -> str:
    """sql behind the derivations it needs; sql may begin with further tables of its own, as 'name AS (...), ...' before SELECT."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for below in CTE[name][0]:
                add(below)
            order.append(name)

    for n in names:
        add(n)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in _SHARED else ''}({CTE[n][1]})" for n in order) + "\n" + sql
