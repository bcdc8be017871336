"""Queries over temporal samples, asset windows, seams and review rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import narrative as nv
from cutlight.operators import review as rv
from cutlight.operators import shots as sh
from cutlight.plans.narrative import _chunk_sql
from cutlight.plans.shots import _scores, _shots_with_context, _with_edges, _with_scores
from cutlight.registry import query

MOMENTS = ("complete_action", "composition", "partial_action", "sustained_state", "unclear")


@query(with_("""SELECT movie_id, ev AS event, CASE WHEN musts <= 16 THEN printf('SAMPLE_%02d', row_number() OVER (PARTITION BY movie_id, ev ORDER BY frame, shot_id)) END AS sample_id, shot_id, frame, roles, CAST(NULL AS VARCHAR) AS error FROM picked WHERE musts <= 16 AND turn <= 16
UNION ALL SELECT DISTINCT movie_id, ev, NULL, NULL, NULL, NULL, 'coverage exceeds the cap' FROM picked WHERE musts > 16""", "sh").replace("\nSELECT movie_id, ev AS", """, s AS (SELECT movie_id, (shot_ord - 1) // (1 + movie_id % 19) AS ev, shot_id, start_frame AS a, end_frame AS b, k % 2 = 0 AS lively FROM sh WHERE end_frame > start_frame),
r AS (SELECT *, row_number() OVER (PARTITION BY movie_id, ev ORDER BY a, shot_id) AS r, row_number() OVER (PARTITION BY movie_id, ev ORDER BY a DESC, shot_id DESC) AS back, row_number() OVER (PARTITION BY movie_id, ev ORDER BY b - a DESC, a) AS lng FROM s),
w AS (SELECT movie_id, ev, shot_id, 1 AS step, r AS o, (a + b - 1) // 2 AS frame, 'middle' AS role FROM r UNION ALL SELECT movie_id, ev, shot_id, 2, 0, a, 'begin' FROM r WHERE r = 1 UNION ALL SELECT movie_id, ev, shot_id, 3, 0, b - 1, 'end' FROM r WHERE back = 1
 UNION ALL SELECT movie_id, ev, shot_id, 4, r, a, 'begin' FROM r UNION ALL SELECT movie_id, ev, shot_id, 5, r, b - 1, 'end' FROM r UNION ALL SELECT movie_id, ev, shot_id, 6, lng * 2, a + (b - a - 1) // 4, 'development' FROM r WHERE lively UNION ALL SELECT movie_id, ev, shot_id, 6, lng * 2 + 1, a + (b - a - 1) * 3 // 4, 'development' FROM r WHERE lively),
g AS (SELECT movie_id, ev, shot_id, frame, min(step * 1000 + o) AS p, list_filter(['begin', 'middle', 'end', 'development'], lambda x: list_contains(list(role), x)) AS roles FROM w GROUP BY movie_id, ev, shot_id, frame),
picked AS (SELECT *, row_number() OVER (PARTITION BY movie_id, ev ORDER BY p, frame, shot_id) AS turn, count(*) FILTER (p < 4000) OVER (PARTITION BY movie_id, ev) AS musts FROM g)
SELECT movie_id, ev AS""", 1))
def w15_sample_plan(spark: SparkSession, d: str) -> DataFrame:
    event = F.floor((F.col("shot_ord") - 1) / (1 + F.col("movie_id") % 19))
    x = fx.shots(spark, d).where("end_frame > start_frame").select("movie_id", event.alias("event"), "shot_id", "start_frame", "end_frame", (F.col("k") % 2 == 0).alias("lively"))
    return rv.sample_plan(x)


@query(with_("SELECT", "sh").removesuffix("\nSELECT") + f""", mo AS (SELECT movie_id, shot_ord AS ord, event_id AS moment, {fx._list(MOMENTS)}[k % 5 + 1] AS kind, start_frame AS a0, greatest(start_frame + 1, end_frame - k % 10) AS b0, k % 25 AS key, k % 11 = 0 AS weak, k % 7 <> 0 AS clr FROM sh),
st AS (SELECT *, CASE WHEN weak THEN 'WEAK' WHEN NOT clr OR kind = 'unclear' THEN 'REVIEW' WHEN b0 - a0 > 480 AND kind = 'partial_action' THEN 'REVIEW' ELSE 'CANDIDATE' END AS state, b0 - a0 > 480 AND kind IN ('sustained_state', 'composition') AS clip FROM mo),
cl AS (SELECT *, CASE WHEN clip THEN a0 + (b0 - a0 - 480) // 2 ELSE a0 END AS a, CASE WHEN clip THEN a0 + (b0 - a0 - 480) // 2 + 480 ELSE b0 END AS b FROM st),
ca AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY ord) AS i FROM cl WHERE state = 'CANDIDATE'),
n AS (SELECT movie_id, max(i) AS n FROM ca GROUP BY movie_id),
f(movie_id, i, kept) AS (SELECT movie_id, 0::BIGINT, []::STRUCT(m BIGINT, a BIGINT, b BIGINT, key BIGINT)[] FROM n
 UNION ALL SELECT f.movie_id, f.i + 1, CASE WHEN len(list_filter(kept, lambda p: p.key = ca.key OR greatest(0, least(ca.b, p.b) - greatest(ca.a, p.a)) >= 0.8::DOUBLE * least(ca.b - ca.a, p.b - p.a))) > 0 THEN kept ELSE list_append(kept, struct_pack(m := ca.moment, a := ca.a, b := ca.b, key := ca.key)) END FROM f JOIN ca ON ca.movie_id = f.movie_id AND ca.i = f.i + 1),
won AS (SELECT f.movie_id, unnest(list_transform(kept, lambda p: p.m)) AS moment FROM f JOIN n ON n.movie_id = f.movie_id AND n.n = f.i)
SELECT cl.movie_id, cl.moment, CASE WHEN state <> 'CANDIDATE' THEN state WHEN won.moment IS NOT NULL THEN 'WINDOW' ELSE 'SUPPRESSED' END AS state, CASE WHEN won.moment IS NOT NULL THEN a END AS start_frame, CASE WHEN won.moment IS NOT NULL THEN b END AS end_frame FROM cl LEFT JOIN won ON won.movie_id = cl.movie_id AND won.moment = cl.moment""")
def g15_asset_windows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    x = fx.shots(spark, d).select("movie_id", F.col("shot_ord").alias("ord"), F.col("event_id").alias("moment"), fx.pick(MOMENTS, k % 5).alias("kind"), "start_frame", F.greatest(F.col("start_frame") + 1, F.col("end_frame") - k % 10).alias("end_frame"), (k % 25).alias("reuse_key"), (k % 11 == 0).alias("weak"), (k % 7 != 0).alias("clear"))
    return rv.asset_windows(x, fx.FPS)


@query(_chunk_sql(""", resp AS (SELECT movie_id, chunk, (cue_ord + chunk) // 5 AS n, min(cue_ord) AS f, max(cue_ord) AS "at" FROM chk GROUP BY ALL),
bd AS (SELECT movie_id, chunk, "at", f % 4 = 0 AS nw FROM resp),
sp AS (SELECT movie_id, chunk, min(cue_ord) AS lo, max(cue_ord) AS hi FROM chk GROUP BY ALL),
ov AS (SELECT a.movie_id, a.chunk, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM sp a JOIN sp b ON a.movie_id = b.movie_id AND b.chunk = a.chunk + 1 WHERE greatest(a.lo, b.lo) < least(a.hi, b.hi)),
sd AS (SELECT ov.movie_id, ov.chunk, "at", nw, 'l' AS s FROM ov JOIN bd ON bd.movie_id = ov.movie_id AND bd.chunk = ov.chunk AND "at" >= lo AND "at" < hi UNION ALL SELECT ov.movie_id, ov.chunk, "at", nw, 'r' FROM ov JOIN bd ON bd.movie_id = ov.movie_id AND bd.chunk = ov.chunk + 1 AND "at" >= lo AND "at" < hi),
cd AS (SELECT movie_id, chunk, "at", bool_or(nw) AS nw, bool_or(s = 'l') AS l, bool_or(s = 'r') AS r FROM sd GROUP BY ALL),
nn AS (SELECT cd.*, l AND r AS both_, NOT (l AND r) AND EXISTS (SELECT 1 FROM cd o WHERE o.movie_id = cd.movie_id AND o.chunk = cd.chunk AND abs(o."at" - cd."at") = 1 AND ((cd.l AND o.r) OR (cd.r AND o.l))) AS near_, false AS fb FROM cd),
al AS (SELECT movie_id, chunk, "at", nw, both_, near_, fb FROM nn UNION ALL SELECT movie_id, chunk, unnest(range(lo, hi)), false, false, false, true FROM ov WHERE NOT EXISTS (SELECT 1 FROM cd WHERE cd.movie_id = ov.movie_id AND cd.chunk = ov.chunk)),
sc AS (SELECT al.*, round(greatest(0, y.start_s - x.end_s), 6) AS pause, round(-abs((x.end_s + y.start_s) / 2 - (u.start_s + v.end_s) / 2), 6) AS central FROM al JOIN ov USING (movie_id, chunk) JOIN cu x ON x.movie_id = al.movie_id AND x.cue_ord = "at" JOIN cu y ON y.movie_id = al.movie_id AND y.cue_ord = "at" + 1 JOIN cu u ON u.movie_id = al.movie_id AND u.cue_ord = lo JOIN cu v ON v.movie_id = al.movie_id AND v.cue_ord = hi)
SELECT movie_id, chunk, "at" AS seam, CASE WHEN fb THEN 'midpoint_fallback' WHEN both_ THEN 'consensus_boundary' WHEN near_ THEN 'near_consensus_boundary' ELSE 'narrative_boundary' END || CASE WHEN nw THEN '+new_interaction' ELSE '' END AS reason
FROM sc QUALIFY row_number() OVER (PARTITION BY movie_id, chunk ORDER BY nw DESC, both_ DESC, near_ DESC, pause DESC, central DESC, "at") = 1"""))
def g11_seam_choice(spark: SparkSession, d: str) -> DataFrame:
    cues = fx.cues(spark, d)
    return seam_choice(cues, nv.chunk_cues(cues, 60.0, 10.0))


def seam_choice(cues: DataFrame, c: DataFrame) -> DataFrame:
    """Seams between the chunks c (movie_id, chunk, cue_ord) of cues, by what a model might have answered for each chunk."""
    b = c.groupBy("movie_id", "chunk", F.floor((F.col("cue_ord") + F.col("chunk")) / 5).alias("n")).agg(F.min("cue_ord").alias("f"), F.max("cue_ord").alias("at"))
    b = b.select("movie_id", "chunk", "at", (F.col("f") % 4 == 0).alias("new"))
    span = c.groupBy("movie_id", "chunk").agg(F.min("cue_ord").alias("lo"), F.max("cue_ord").alias("hi"))
    after = span.select("movie_id", (F.col("chunk") - 1).alias("chunk"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    o = span.join(after, ["movie_id", "chunk"]).select("movie_id", "chunk", F.greatest("lo", "lo2").alias("low"), F.least("hi", "hi2").alias("high"))
    return rv.choose_seams(b, o, cues)


@query(with_("SELECT movie_id, min(c) AS next FROM (SELECT DISTINCT movie_id, unnest(range(1, (SELECT count(*) FROM sh b WHERE b.movie_id = a.movie_id) + 2)) AS c FROM sh a) WHERE (movie_id, c) NOT IN (SELECT movie_id, shot_ord FROM sh WHERE k % 9 <> 0) GROUP BY movie_id", "sh"))
def w12_next_free_number(spark: SparkSession, d: str) -> DataFrame:
    return rv.next_free_number(fx.shots(spark, d).where("k % 9 <> 0"), "movie_id", "shot_ord")


@query(_with_scores("SELECT movie_id, 50.0::DOUBLE AS threshold, CASE WHEN a = 0 THEN 'LIKELY_TRUE_LONG_TAKE' WHEN a - b >= 2 THEN 'TOO_CONSERVATIVE' ELSE 'INCONCLUSIVE' END AS take FROM (SELECT movie_id, count(*) FILTER (score >= 20) AS a, count(*) FILTER (score >= 150) AS b FROM sc GROUP BY movie_id)"))
def a22_take_class(spark: SparkSession, d: str) -> DataFrame:
    return rv.take_class(sh.threshold_sweep(_scores(spark, d), [20, 50, 150]).where("movie_id is not null"))


@query("SELECT asset, CASE WHEN s = 'PASS' OR g = 'face_priority' OR f IN ('SOURCE_LIMIT', 'AMBIGUOUS', 'ERROR') THEN NULL WHEN r THEN 'face_priority' WHEN g = 'subject_focus' THEN 'interaction_aware' END AS next FROM (SELECT p_partkey AS asset, ['subject_focus', 'interaction_aware', 'face_priority'][p_partkey % 3 + 1] AS g, CASE WHEN p_size % 2 = 1 THEN 'PASS' ELSE 'REVIEW' END AS s, ['PASS', 'REPAIR', 'SOURCE_LIMIT', 'AMBIGUOUS'][p_partkey % 4 + 1] AS f, p_partkey % 5 = 0 AS r FROM part)")
def b18_next_strategy(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("asset")
    return fx.assets(spark, d).select("asset", rv.next_strategy(fx.pick(("subject_focus", "interaction_aware", "face_priority"), n % 3), F.col("vertical"), fx.pick(("PASS", "REPAIR", "SOURCE_LIMIT", "AMBIGUOUS"), n % 4), n % 5 == 0).alias("next"))


_DECISIONS = ("APPROVED", "REJECTED", "APPROVED")


@query("WITH d AS (SELECT l_partkey AS asset, epoch_us(l_shipdate) AS ts_us, ['APPROVED', 'REJECTED', 'APPROVED'][l_linenumber % 3 + 1] AS decision FROM lineitem), f AS (SELECT asset, arg_min(decision, (ts_us, decision)) AS first FROM d GROUP BY asset) SELECT asset, first AS decision, count(*) FILTER (decision <> first) AS conflicts FROM d JOIN f USING (asset) GROUP BY ALL".replace("first", "fst"))
def l03_first_decisions(spark: SparkSession, d: str) -> DataFrame:
    x = fx.table(spark, d, "lineitem").select(F.col("l_partkey").alias("asset"), fx.micros("l_shipdate").alias("ts_us"), fx.pick(_DECISIONS, F.col("l_linenumber") % 3).alias("decision"))
    return rv.first_decisions(x)


@query(with_("SELECT movie_id, count(*) AS attempts, count(*) FILTER (http <> 200) AS failed, greatest(0, 40 - count(*) FILTER (http <> 200)) AS \"left\" FROM rq GROUP BY movie_id", "rq"))
def p19_retry_allowance(spark: SparkSession, d: str) -> DataFrame:
    return rv.retry_allowance(fx.requests(spark, d).select("movie_id", (F.col("http") == 200).alias("ok")), 40)


@query(_with_edges(""", e AS (SELECT * FROM edge WHERE (movie_id + CAST(substr(shot_id, 11) AS BIGINT)) % 6 <> 0), g AS (SELECT movie_id, (shot_ord - 1) // 3 AS event, shot_id, lead(shot_id) OVER (PARTITION BY movie_id, (shot_ord - 1) // 3 ORDER BY shot_ord) AS nx, count(*) OVER (PARTITION BY movie_id, (shot_ord - 1) // 3) AS n FROM sh)
SELECT movie_id, event, CASE WHEN n <= 1 OR m = n - 1 THEN 'PASS' WHEN kn = 0 THEN 'LEGACY_UNVERIFIED' ELSE 'SPLIT_REQUIRED' END AS status FROM (SELECT g.movie_id, event, n, count(*) FILTER (e.shot_id IS NOT NULL) AS kn, count(*) FILTER (len(e.breaks) = 0) AS m FROM g LEFT JOIN e ON e.movie_id = g.movie_id AND e.shot_id = g.shot_id AND e.n_shot_id = nx GROUP BY ALL)"""))
def v21_event_coherence(spark: SparkSession, d: str) -> DataFrame:
    x = fx.shots(spark, d).groupBy("movie_id", F.floor((F.col("shot_ord") - 1) / 3).alias("event")).agg(F.transform(F.sort_array(F.collect_list(F.struct("shot_ord", "shot_id"))), lambda s: s["shot_id"]).alias("shot_ids"))
    edges = sh.adjacent_edges(_shots_with_context(spark, d)).where((F.col("movie_id") + F.substring("shot_id", 11, 9).cast("bigint")) % 6 != 0)
    return rv.coherence(x, edges)


@query(with_("SELECT", "sh").removesuffix("\nSELECT") + """, it AS (SELECT movie_id, (shot_ord - 1) // 12 AS run, (shot_ord - 1) % 12 + 1 AS p, start_s, end_s, k FROM sh),
sc AS (SELECT a.movie_id, a.run, a.p AS i, b.p AS j, CAST((b.k * 7 + a.k * 3 + (b.p - a.p) * 11) % 50 - 5 AS DOUBLE) AS s FROM it a JOIN it b ON a.movie_id = b.movie_id AND a.run = b.run AND b.p >= a.p AND (b.p = a.p OR b.end_s - a.start_s <= 20)),
n AS (SELECT movie_id, run, max(p) AS n FROM it GROUP BY ALL),
f(movie_id, run, e, best) AS (SELECT movie_id, run, 0::BIGINT, [{'t': 0.0::DOUBLE, 'i': 0::BIGINT}] FROM n
 UNION ALL SELECT f.movie_id, f.run, f.e + 1, list_append(f.best, (SELECT arg_min(struct_pack(t := f.best[sc.i].t + sc.s, i := sc.i), (-(f.best[sc.i].t + sc.s), sc.i)) FROM sc WHERE sc.movie_id = f.movie_id AND sc.run = f.run AND sc.j = f.e + 1)) FROM f JOIN n ON n.movie_id = f.movie_id AND n.run = f.run AND f.e < n.n),
g(movie_id, run, i, j) AS (SELECT f.movie_id, f.run, f.best[n.n + 1].i, n.n FROM f JOIN n ON n.movie_id = f.movie_id AND n.run = f.run AND f.e = n.n
 UNION ALL SELECT g.movie_id, g.run, f.best[g.i].i, g.i - 1 FROM g JOIN n ON n.movie_id = g.movie_id AND n.run = g.run JOIN f ON f.movie_id = g.movie_id AND f.run = g.run AND f.e = n.n WHERE g.i > 1)
SELECT movie_id, run, i AS part_start, j AS part_end FROM g""")
def g09_optimal_partition(spark: SparkSession, d: str) -> DataFrame:
    it = fx.shots(spark, d).select("movie_id", F.floor((F.col("shot_ord") - 1) / 12).alias("run"), ((F.col("shot_ord") - 1) % 12 + 1).alias("p"), "start_s", "end_s", "k")
    a = it.select("movie_id", "run", F.col("p").alias("i"), F.col("start_s").alias("a"), F.col("k").alias("ka"))
    b = it.select("movie_id", "run", F.col("p").alias("j"), F.col("end_s").alias("b"), F.col("k").alias("kb"))
    pairs = a.join(b, ["movie_id", "run"]).where((F.col("j") >= F.col("i")) & ((F.col("j") == F.col("i")) | (F.col("b") - F.col("a") <= 20)))
    scores = pairs.select("movie_id", "run", "i", "j", ((F.col("kb") * 7 + F.col("ka") * 3 + (F.col("j") - F.col("i")) * 11) % 50 - 5).cast("double").alias("score"))
    return rv.optimal_partition(it, scores)


@query("SELECT p_partkey AS asset, CASE WHEN p_partkey % 6 = 0 THEN 'NEW' WHEN p_partkey % 5 = 0 OR p_partkey % 7 = 0 THEN 'STALE' ELSE 'FRESH' END AS state FROM part")
def p17_fingerprint_staleness(spark: SparkSession, d: str) -> DataFrame:
    now = fx.assets(spark, d).select("asset", "name", "size")
    then = now.where("asset % 6 <> 0").withColumn("size", F.when(F.col("asset") % 5 == 0, F.col("size") + 1).otherwise(F.col("size"))).withColumn("name", F.when(F.col("asset") % 7 == 0, F.lit(None)).otherwise(F.col("name")))
    return rv.stale_fingerprints(now, then, ["asset"], ["name", "size"])


@query(with_("SELECT movie_id, batch, count(*) AS open FROM (SELECT DISTINCT movie_id, event_id, event_id % 40 AS batch FROM lg) e WHERE NOT EXISTS (SELECT 1 FROM lg WHERE lg.movie_id = e.movie_id AND lg.event_id = e.event_id AND status IN ('COMPLETE', 'FAILED_FINAL')) GROUP BY ALL", "lg"))
def l09_requeue_batches(spark: SparkSession, d: str) -> DataFrame:
    log = fx.stage_log(spark, d)
    return rv.requeue_batches(log.select("movie_id", "event_id", (F.col("event_id") % 40).alias("batch")).distinct(), log, ["COMPLETE", "FAILED_FINAL"])


@query(with_("SELECT asset, CASE WHEN asset % 13 = 0 OR n IS NULL THEN 'STALE' ELSE 'REPAIR' END AS state FROM ass LEFT JOIN (SELECT asset AS n FROM fil WHERE name = 'vertical.mp4') f ON n = asset WHERE size % 3 = 0", "ass", "fil"))
def l12_repair_list(spark: SparkSession, d: str) -> DataFrame:
    audits = fx.assets(spark, d).where("size % 3 = 0").select("asset", F.lit("REPAIR").alias("decision"), F.when(F.col("asset") % 13 == 0, F.lit("x")).otherwise(F.sha2(F.concat(F.col("asset").cast("string"), F.lit("vertical.mp4")).cast("binary"), 256)).alias("sha"))
    return rv.repair_list(audits, fx.asset_files(spark, d).where("name = 'vertical.mp4'"))


@query(with_("SELECT movie_id, CASE WHEN f = 'PASS' AND p <> 'PASS' THEN 'AMBIGUOUS' ELSE coalesce(f, p) END AS decision, count(*) AS n FROM (SELECT movie_id, CASE WHEN size % 5 = 0 THEN NULL WHEN size % 2 = 0 THEN 'PASS' ELSE 'REPAIR' END AS f, CASE WHEN size % 3 = 0 THEN 'RETRY' ELSE 'PASS' END AS p FROM ass) GROUP BY ALL", "ass"))
def b21_combined_audit(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("size")
    x = fx.assets(spark, d).select("movie_id", F.when(s % 5 != 0, F.when(s % 2 == 0, "PASS").otherwise("REPAIR")).alias("face"), F.when(s % 3 == 0, "RETRY").otherwise("PASS").alias("person"))
    return rv.combined_audit(x)


@query(with_("SELECT a.movie_id, cached, missing, records, v1, temporal_v2, visual_reuse FROM (SELECT movie_id, count(*) FILTER (h) AS cached, count(*) FILTER (NOT h) AS missing FROM (SELECT movie_id, event_id IN (SELECT event_id FROM rec WHERE valid) AS h FROM ob) GROUP BY movie_id) a LEFT JOIN (SELECT movie_id, count(*) AS records, count(*) FILTER (contract = 'v1') AS v1, count(*) FILTER (contract = 'temporal_v2') AS temporal_v2, count(*) FILTER (contract = 'visual_reuse') AS visual_reuse FROM rec GROUP BY movie_id) b USING (movie_id)", "ob", "rec"))
def a23_observation_status(spark: SparkSession, d: str) -> DataFrame:
    return rv.observation_status(fx.observations(spark, d).select("movie_id", "event_id"), fx.records(spark, d))


@query(with_("SELECT movie_id, event_id, shot_ord AS ord, label, CASE WHEN k % 10 IN (1, 3) THEN printf('ACT_%03d', movie_id * 10 + k % 10) ELSE printf('NEW_%03d', shot_ord) END AS id FROM (SELECT *, CASE WHEN k % 2 = 0 THEN ' Act ' ELSE 'aCT ' END || k % 10 || ' ' AS label FROM sh)", "sh"))
def j12_evidence_binding(spark: SparkSession, d: str) -> DataFrame:
    s = fx.shots(spark, d)
    m = s.select("movie_id", "event_id", F.col("shot_ord").alias("ord"), F.concat(F.when(F.col("k") % 2 == 0, " Act ").otherwise("aCT "), (F.col("k") % 10).cast("string"), F.lit(" ")).alias("label"))
    c = s.select("movie_id").distinct().select("movie_id", F.explode(F.array(F.lit(1), F.lit(3))).alias("n")).select("movie_id", F.concat(F.lit("ACT "), F.col("n").cast("string")).alias("label"), F.format_string("ACT_%03d", F.col("movie_id") * 10 + F.col("n")).alias("id"))
    return rv.bind_labels(m, c, "NEW")


@query("SELECT event_id, CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 4 = 0 THEN ['color_palette', 'shot_scale'] WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 4 = 1 THEN ['shot_scale'] ELSE []::VARCHAR[] END AS found FROM events")
def v06_forbidden_keys(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint") % 4)
    deep = F.when(F.col("k") == 0, F.lit('{"a":[{"shot_scale":1,"b":{"color_palette" :null}}]}')).when(F.col("k") == 1, F.lit('{"x":{"shot_scale":"color_palette"}}')).otherwise(F.col("props"))
    return rv.forbidden_keys(e.withColumn("j", deep), "j", ["shot_scale", "color_palette"]).select("event_id", "found")
