"""Queries over shots, their signals, edges and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.functions.columns import rounded
from cutlight.operators import geometry as geo
from cutlight.operators import intervals as iv
from cutlight.operators import shots as sh
from cutlight.registry import query
from cutlight.session import cut, shuffled

_r = lambda c: F.round(c, 4).alias(c)
#: Means of few values lie on the edge of rounding; both engines are moved off it.
_OFF = 1e-7


def _scores(spark: SparkSession, d: str) -> DataFrame:
    """Frame scores: the highest value at each first frame of a shot."""
    return fx.shots(spark, d).groupBy("movie_id", F.col("start_frame").alias("frame")).agg(F.max("value").alias("score"))


_SC = ", sc AS (SELECT movie_id, start_frame AS frame, max(value) AS score FROM sh GROUP BY ALL)\n"


def _with_scores(body: str) -> str:
    return with_("SELECT", "sh").removesuffix("\nSELECT") + _SC + body


@query(with_("""SELECT movie_id, count(*) AS n, round(count(*) * 60 / sum(end_s - start_s), 4) AS per_minute, round(min(end_s - start_s), 4) AS min_s, round(median(end_s - start_s), 4) AS median_s, round(avg(end_s - start_s), 4) AS mean_s,
 round(quantile_disc(end_s - start_s, 0.9), 4) AS p90_s, round(max(end_s - start_s), 4) AS max_s, count(*) FILTER (end_s - start_s < 0.5) AS below_half, count(*) FILTER (end_s - start_s < 1) AS below_1, count(*) FILTER (end_s - start_s > 15) AS above_15, count(*) FILTER (end_s - start_s > 30) AS above_30 FROM sh GROUP BY movie_id""", "sh"))
def a02_shot_metrics(spark: SparkSession, d: str) -> DataFrame:
    x = sh.shot_metrics(fx.shots(spark, d), ["movie_id"])
    return x.select("movie_id", "n", *[_r(c) for c in ("per_minute", "min_s", "median_s", "mean_s", "p90_s", "max_s")], "below_half", "below_1", "above_15", "above_30")


@query(_with_scores("SELECT t AS threshold, movie_id, CAST(sum(c) AS BIGINT) AS n_cuts, CAST(sum(c + 1) AS BIGINT) AS n_shots FROM (SELECT t, movie_id, count(*) FILTER (score >= t) AS c FROM sc, unnest([5.0::DOUBLE, 20.0, 50.0, 100.0]) q(t) GROUP BY ALL) GROUP BY GROUPING SETS ((t, movie_id), (t))"))
def a03_threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return sh.threshold_sweep(_scores(spark, d), [5, 20, 50, 100])


@query(_with_scores("SELECT movie_id, count(*) FILTER (score >= 20) AS at_low, count(*) FILTER (score >= 50) AS at_high, count(*) FILTER (score >= 20 AND score < 50) AS only_low FROM sc GROUP BY movie_id"))
def a04_cut_difference(spark: SparkSession, d: str) -> DataFrame:
    return sh.cut_difference(_scores(spark, d), 20, 50)


@query(with_("""SELECT s.movie_id, s.shot_id, CASE WHEN g.n IS NOT NULL THEN 'COMPLETE' WHEN last AND dur < 0.25 THEN 'SKIPPED' ELSE 'FAILED' END AS status, round(m, 4) AS mean, CASE WHEN m IS NOT NULL THEN round(sqrt(greatest(0, q - m * m)), 4) END AS std, round(nb, 4) AS near_black, round(sharp, 4) AS sharpness, round(mo, 4) AS motion
FROM (SELECT movie_id, shot_id, end_s - start_s AS dur, lead(shot_id) OVER (PARTITION BY movie_id ORDER BY start_s, shot_id) IS NULL AS last FROM sh) s
LEFT JOIN (SELECT movie_id, shot_id, count(*) AS n, sum(s1) / sum(n) AS m, sum(s2) / sum(n) AS q, sum(dark) / sum(n) AS nb, avg(laplacian) AS sharp, coalesce(avg(diff_prev), 0) AS mo FROM fs GROUP BY ALL) g USING (movie_id, shot_id)""", "fs"))
def a07_shot_signals(spark: SparkSession, d: str) -> DataFrame:
    x = sh.shot_signals(fx.shots(spark, d), fx.frame_stats(spark, d))
    return x.select("movie_id", "shot_id", "status", *[_r(c) for c in ("mean", "std", "near_black", "sharpness", "motion")])


@query("SELECT label, vec_id, n FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM embeddings) WHERE r = n // 2 + 1")
def a08_middle_sample(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "embeddings").select("label", "vec_id")
    n = e.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return sh.middle_sample(e, ["label"], "vec_id").join(n, "label").select("label", "vec_id", "n")


@query("""SELECT movie_id, CAST(CASE WHEN s THEN 0 ELSE t END AS BIGINT) AS top, CAST(CASE WHEN s THEN 0 ELSE t END AS BIGINT) AS bottom, CAST(CASE WHEN s THEN 0 ELSE l END AS BIGINT) AS "left", 0::BIGINT AS "right", CASE WHEN s THEN 'FULL_FRAME' ELSE 'CROPPED' END AS status
FROM (SELECT *, 800 - 2 * t < 0.55 * 800 OR 1920 - l < 0.55 * 1920 AS s FROM (SELECT movie_id, CASE WHEN ts[i] >= 24 THEN ts[i] ELSE 0 END AS t, CASE WHEN ls[i] >= 24 THEN ls[i] ELSE 0 END AS l
 FROM (SELECT user_id AS movie_id, list_sort(list(CASE WHEN k < 15 THEN 0 ELSE 60 + user_id % 7 END)) AS ts, list_sort(list(CASE WHEN k < 50 THEN 30 ELSE 0 END)) AS ls, count(*) - CAST(ceil(count(*) * 0.78::DOUBLE) AS BIGINT) + 1 AS i FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY user_id)))""")
def a09_picture_bounds(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    top = F.when(F.col("k") < 15, 0).otherwise(60 + F.col("user_id") % 7)
    runs = e.select(F.col("user_id").alias("movie_id"), top.alias("top"), top.alias("bottom"), F.when(F.col("k") < 50, 30).otherwise(0).alias("left"), F.lit(0).alias("right"))
    return sh.picture_bounds(runs, 1920, 800)


@query(with_("SELECT movie_id, event_id AS event, CAST(sum(hit) AS BIGINT) AS samples, CASE WHEN sum(hit) >= 3 THEN 'REJECT' ELSE 'PASS' END AS decision FROM (SELECT movie_id, event_id, sample, max(CASE WHEN (k + sample) % 10 / 100 >= 0.05 AND k % 100 / 100 >= 0.55 THEN 1 ELSE 0 END) AS hit FROM bx GROUP BY ALL) GROUP BY ALL", "bx"))
def a10_persistent_overlay(spark: SparkSession, d: str) -> DataFrame:
    b = fx.boxes(spark, d)
    regions = b.select("movie_id", F.col("event_id").alias("event"), "sample", ((F.col("k") + F.col("sample")) % 10 / 100).alias("area"), (F.col("k") % 100 / 100).alias("y"))
    return geo.persistent_overlay(regions)


@query(_with_scores(""", f AS (SELECT movie_id, 0 AS ws, max(end_frame) AS we FROM sh GROUP BY movie_id), c AS (SELECT f.movie_id, frame FROM sc JOIN f ON f.movie_id = sc.movie_id AND score >= 50 AND frame > ws AND frame < we UNION SELECT movie_id, ws FROM f UNION SELECT movie_id, we FROM f)
SELECT movie_id, 0::BIGINT AS window_start, row_number() OVER w AS n, printf('SHOT_%04d', row_number() OVER w) AS shot_id, frame AS start_frame, nx AS end_frame, round(frame / 24, 4) AS start_s, round(nx / 24, 4) AS end_s FROM (SELECT *, lead(frame) OVER (PARTITION BY movie_id ORDER BY frame) AS nx FROM c) WHERE nx IS NOT NULL WINDOW w AS (PARTITION BY movie_id ORDER BY frame)"""))
def w03_shots_from_cuts(spark: SparkSession, d: str) -> DataFrame:
    w = fx.shots(spark, d).groupBy("movie_id").agg(F.lit(0).cast("bigint").alias("start_frame"), F.max("end_frame").alias("end_frame"))
    x = sh.build_shots(w, sh.cuts(_scores(spark, d), 50), fx.FPS)
    return x.select("movie_id", "window_start", "n", "shot_id", "start_frame", "end_frame", _r("start_s"), _r("end_s"))


@query(_with_scores("SELECT movie_id, frame, round(score, 4) AS score FROM sc WHERE score >= 50"))
def w04_cut_frames(spark: SparkSession, d: str) -> DataFrame:
    return sh.cuts(_scores(spark, d), 50).select("movie_id", "frame", _r("score"))


@query(_with_scores("SELECT movie_id, rank, frame, score FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY score DESC, frame) AS rank FROM (SELECT *, lag(score) OVER w AS b, lead(score) OVER w AS a FROM sc WINDOW w AS (PARTITION BY movie_id ORDER BY frame)) WHERE score > 0 AND (b IS NULL OR score >= b) AND (a IS NULL OR score >= a)) WHERE rank <= 15"))
def w05_local_peaks(spark: SparkSession, d: str) -> DataFrame:
    return sh.local_peaks(_scores(spark, d))


@query(with_("SELECT movie_id, shot_id, part, start_frame + part * (f // p) + least(part, f % p) AS unit_start, start_frame + part * (f // p) + least(part, f % p) + f // p + CASE WHEN part < f % p THEN 1 ELSE 0 END AS unit_end FROM (SELECT *, end_frame - start_frame AS f, CAST(ceil((end_frame - start_frame) / 432) AS BIGINT) AS p FROM sh WHERE end_frame > start_frame), unnest(range(0, p)) q(part)", "sh"))
def w06_analysis_units(spark: SparkSession, d: str) -> DataFrame:
    return sh.analysis_units(fx.shots(spark, d), fx.FPS)


@query(with_("SELECT movie_id, event_id, printf('VE_%06d', row_number() OVER (PARTITION BY movie_id ORDER BY start_s, end_s, event_id)) AS visual_event_id FROM sh", "sh"))
def w07_timeline_numbers(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("movie_id").orderBy("start_s", "end_s", "event_id"))
    return fx.shots(spark, d).select("movie_id", "event_id", F.format_string("VE_%06d", n).alias("visual_event_id"))


@query(with_("SELECT movie_id, event_id, r AS rank, (r - 1) // 8 AS batch FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY value DESC, start_s, event_id) AS r FROM sh)", "sh"))
def w08_priority_batches(spark: SparkSession, d: str) -> DataFrame:
    return sh.priority_batches(fx.shots(spark, d), 8, "value")


@query(with_("SELECT movie_id, shot_id, count(*) AS samples, list(f ORDER BY f) AS frames FROM (SELECT DISTINCT movie_id, shot_id, start_frame + CAST(floor((end_frame - start_frame) * (0.12::DOUBLE + 0.76::DOUBLE * i / 6) + 0.5) AS BIGINT) AS f FROM sh, unnest(range(0, 7)) q(i)) GROUP BY ALL", "sh"))
def w14_sample_frames(spark: SparkSession, d: str) -> DataFrame:
    at = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.col("start_frame") + F.floor((F.col("end_frame") - F.col("start_frame")) * (0.12 + F.lit(0.76) * i / 6) + 0.5))
    x = fx.shots(spark, d).select("movie_id", "shot_id", F.array_sort(F.array_distinct(at)).alias("frames"))
    return x.select("movie_id", "shot_id", F.size("frames").cast("bigint").alias("samples"), "frames")


@query(with_("SELECT", "sh").removesuffix("\nSELECT") + """, wn AS (SELECT *, (shot_ord - 1) // 10 AS window_id, movie_id + (shot_ord - 1) // 10 AS n FROM sh),
wi AS (SELECT movie_id, window_id, min(start_frame) - CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END AS a, max(end_frame) + CASE WHEN n % 7 = 0 THEN 1 ELSE 0 END AS b FROM wn GROUP BY movie_id, window_id, n),
vs AS (SELECT *, CASE WHEN k = 50 THEN end_s ELSE (start_s + end_s) / 2 END AS rep, (end_frame - start_frame) / 24 + CASE WHEN k = 51 THEN 0.1::DOUBLE ELSE 0 END AS dur FROM wn WHERE k <> 60 AND n % 11 <> 0),
vb AS (SELECT *, lag(end_frame) OVER (PARTITION BY movie_id, window_id ORDER BY start_s, shot_id) AS before FROM vs),
vg AS (SELECT movie_id, window_id, arg_min(start_frame, (start_s, shot_id)) AS f, arg_max(end_frame, (start_s, shot_id)) AS l, count(*) FILTER (start_frame <> before) AS gaps, count(*) FILTER (end_frame <= start_frame) AS non_positive, count(*) FILTER (NOT (start_s <= rep AND rep < end_s)) AS outside, count(*) FILTER (abs(dur - (end_frame - start_frame) / 24) > 1e-8) AS mismatches FROM vb GROUP BY ALL)
SELECT wi.movie_id, wi.window_id, f IS NULL AS no_shots, coalesce(f <> a, false) AS bad_first, coalesce(l <> b, false) AS bad_last, coalesce(gaps, 0) AS gaps, coalesce(non_positive, 0) AS non_positive, coalesce(outside, 0) AS outside, coalesce(mismatches, 0) AS mismatches FROM wi LEFT JOIN vg ON vg.movie_id = wi.movie_id AND vg.window_id = wi.window_id""")
def v08_shot_contract(spark: SparkSession, d: str) -> DataFrame:
    """Windows of ten shots; some windows are wider than their shots or have none, some shots are missing or at odds with their frames."""
    s = fx.shots(spark, d).withColumn("window_id", F.floor((F.col("shot_ord") - 1) / 10))
    n, k = F.col("movie_id") + F.col("window_id"), F.col("k")
    windows = s.groupBy("movie_id", "window_id").agg(F.min("start_frame").alias("a"), F.max("end_frame").alias("b"))
    windows = windows.select("movie_id", "window_id", (F.col("a") - F.when(n % 5 == 0, 1).otherwise(0)).alias("start_frame"), (F.col("b") + F.when(n % 7 == 0, 1).otherwise(0)).alias("end_frame"))
    rep = F.when(k == 50, F.col("end_s")).otherwise((F.col("start_s") + F.col("end_s")) / 2)
    length = (F.col("end_frame") - F.col("start_frame")) / fx.FPS + F.when(k == 51, 0.1).otherwise(0.0)
    x = s.where((k != 60) & (n % 11 != 0)).withColumn("representative_s", rep).withColumn("duration_s", length)
    return sh.validate_shots(x, windows, fx.FPS)


@query(with_("SELECT movie_id, count(*) FILTER (abs(start_s - b) > 0.05) AS jumps, round(min(start_s), 4) AS first_s, round(max(end_s), 4) AS last_s FROM (SELECT *, lag(end_s) OVER (PARTITION BY movie_id ORDER BY start_s, shot_id) AS b FROM sh WHERE k % 10 <> 0) GROUP BY movie_id", "sh"))
def v09_shot_continuity(spark: SparkSession, d: str) -> DataFrame:
    x = sh.continuity_errors(fx.shots(spark, d).where("k % 10 <> 0"))
    return x.select("movie_id", "jumps", _r("first_s"), _r("last_s"))


def _pair_sql() -> str:
    return """, hs AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS h FROM embeddings),
hm AS (SELECT vec_id, h, list_sum(h) / len(h) AS m FROM hs),
hc AS (SELECT vec_id, list_transform(h, lambda x: x - m) AS c FROM hm),
sim AS (SELECT a.vec_id, b.vec_id AS other, greatest(0, least(1, (CASE WHEN list_dot_product(a.c, a.c) * list_dot_product(b.c, b.c) > 0 THEN list_dot_product(a.c, b.c) / sqrt(list_dot_product(a.c, a.c) * list_dot_product(b.c, b.c)) ELSE 1 END + 1) / 2)) AS s FROM hc a JOIN hc b ON b.vec_id = a.vec_id + 1)
"""


@query("WITH one AS (SELECT 1)" + _pair_sql() + "SELECT vec_id, other, round(s, 4) AS similarity FROM sim")
def g01_histogram_similarity(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("h"))
    o = e.select(F.col("vec_id").alias("other"), F.col("h").alias("g"))
    return e.join(o, F.col("other") == F.col("vec_id") + 1).select("vec_id", "other", F.round(sh.histogram_similarity(F.col("h"), F.col("g")), 4).alias("similarity"))


def _shots_with_context(spark: SparkSession, d: str) -> DataFrame:
    x = iv.occupancy(fx.shots(spark, d), fx.cues(spark, d), ["shot_id"])
    return x.withColumn("occupancy", F.coalesce("occupancy", F.lit(0.0)))


def _hists(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("hist"))


def _with_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Shots with occupancy and the number of the vector at their event's number, counted round all vectors."""
    n = fx.table(spark, d, "embeddings").count()
    return _shots_with_context(spark, d).withColumn("vec_id", F.col("event_id") % max(1, n)).withColumn("alone", F.col("k") == 7)


_EDGE_COLUMNS = ", ".join(f"{{a}}.{c} AS {{n}}{c}" for c in (*sh.EDGE_COLUMNS, "vec_id"))


def _edge_sql(name: str, pairs: str) -> str:
    """CTEs that end in one of this name: the continuity of the rows of pairs, with all their columns."""
    given = "lambda x: x IS NOT NULL"
    same = lambda c: f"coalesce({c} = n_{c}, false)"
    other = lambda c: f"coalesce({c} <> n_{c}, false)"
    return f"""{name}_r AS (SELECT *, occupancy + n_occupancy >= 0.45 AS dialogue, list_filter([CASE WHEN {same("interaction_id")} OR (reverse_shot AND n_reverse_shot) THEN 'same_interaction' END, CASE WHEN reverse_shot AND n_reverse_shot THEN 'validated_shot_reverse_shot' END,
  CASE WHEN {same("action_id")} THEN 'continuous_action' END, CASE WHEN {same("scene_id")} THEN 'same_scene' END, CASE WHEN {same("establishing_id")} THEN 'establishing_or_insert_continuity' END,
  CASE WHEN setting_id = n_setting_id AND {same("participants")} THEN 'stable_setting_and_participants' WHEN setting_id = n_setting_id AND {same("subject_id")} THEN 'stable_setting_and_shared_subject' END], {given}) AS reasons FROM ({pairs})),
{name}_b AS (SELECT *, list_filter([CASE WHEN scene_break_after OR n_scene_break_before THEN 'explicit_scene_or_time_break' END, CASE WHEN {other("setting_id")} THEN 'setting_or_location_discontinuity' END, CASE WHEN {other("participants")} THEN 'participant_set_discontinuity' END,
  CASE WHEN greatest(cut_score, n_cut_score) >= 0.65 AND len(reasons) = 0 THEN 'strong_scene_change_without_continuity' END, CASE WHEN {other("composition")} AND len(reasons) = 0 AND NOT dialogue THEN 'major_composition_change_without_interaction' END,
  CASE WHEN {other("subject_id")} AND len(reasons) = 0 AND NOT dialogue THEN 'major_subject_identity_change_without_interaction' END], {given}) AS breaks FROM {name}_r),
{name} AS (SELECT p.*, greatest(0, least(1, (CASE WHEN a.q * b.q > 0 THEN list_dot_product(a.c, b.c) / sqrt(a.q * b.q) ELSE 1 END + 1) / 2)) AS similarity, len(breaks) = 0 AS merge,
  len(breaks) = 0 AND (greatest(0, least(1, (CASE WHEN a.q * b.q > 0 THEN list_dot_product(a.c, b.c) / sqrt(a.q * b.q) ELSE 1 END + 1) / 2)) >= 0.12 OR dialogue OR len(reasons) > 0) AS joined FROM {name}_b p JOIN hc a ON a.vec_id = p.vec_id JOIN hc b ON b.vec_id = p.n_vec_id)"""


_CTX = f""", hm AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS h FROM embeddings),
hl AS (SELECT vec_id, h, list_sum(h) / len(h) AS m FROM hm),
hx AS (SELECT vec_id, list_transform(h, lambda x: x - m) AS c FROM hl),
hc AS (SELECT vec_id, c, list_dot_product(c, c) AS q FROM hx),
occ AS (SELECT sh.movie_id, shot_id, coalesce(least(1, CASE WHEN any_value(sh.end_s) > any_value(sh.start_s) THEN sum(CASE WHEN cu.cue_id IS NULL THEN 0 ELSE greatest(0, least(sh.end_s, cu.end_s) - greatest(sh.start_s, cu.start_s)) END) / (any_value(sh.end_s) - any_value(sh.start_s)) END), 0) AS occupancy
  FROM sh LEFT JOIN cu ON cu.movie_id = sh.movie_id AND sh.start_s < cu.end_s AND cu.start_s < sh.end_s GROUP BY sh.movie_id, shot_id),
ctx AS MATERIALIZED (SELECT sh.*, occupancy, event_id % (SELECT count(*) FROM embeddings) AS vec_id FROM sh JOIN occ USING (movie_id, shot_id)),
{_edge_sql("edge", f"SELECT a.movie_id, {_EDGE_COLUMNS.format(a='a', n='')}, {_EDGE_COLUMNS.format(a='b', n='n_')} FROM ctx a JOIN ctx b ON b.movie_id = a.movie_id AND b.shot_ord = a.shot_ord + 1")}
"""


def _with_edges(body: str) -> str:
    return with_("SELECT", "sh", "cu").removesuffix("\nSELECT") + _CTX + body


@query(_with_edges("SELECT movie_id, shot_id, n_shot_id AS next_id, merge, reasons, breaks, dialogue FROM edge"))
def g02_adjacent_continuity(spark: SparkSession, d: str) -> DataFrame:
    return sh.adjacent_edges(_shots_with_context(spark, d)).drop("similarity")


@query(_with_edges("SELECT movie_id, shot_id, n_shot_id AS next_id, merge, joined, round(similarity, 4) AS similarity FROM edge"))
def g03_baseline_join(spark: SparkSession, d: str) -> DataFrame:
    return sh.baseline_join(sh.adjacent_edges(_with_vectors(spark, d), _hists(spark, d))).select("movie_id", "shot_id", "next_id", "merge", "joined", F.round("similarity", 4).alias("similarity"))


_GROUPS = f""", seq AS MATERIALIZED (SELECT ctx.movie_id, ctx.shot_ord AS i, ctx.shot_id, end_s - start_s AS d, k = 7 AS alone, coalesce(joined, false) AS joined, NOT coalesce(dialogue, false) AND coalesce(len(reasons), 0) = 0 AS quiet FROM ctx LEFT JOIN edge ON edge.movie_id = ctx.movie_id AND edge.shot_id = ctx.shot_id),
g4 AS (SELECT movie_id, i, shot_id, d AS own, alone, 1 AS no, d, quiet, NOT joined OR alone OR (d >= 5 AND quiet) AS closed FROM seq WHERE i = 1
 UNION ALL SELECT movie_id, i, shot_id, own, alone, CASE WHEN f THEN no + 1 ELSE no END, total, quiet, NOT joined OR (NOT f AND total >= 15 AND before) OR (f AND (alone OR (own >= 5 AND quiet)))
 FROM (SELECT s.movie_id, s.i, s.shot_id, s.d AS own, s.alone, s.joined, s.quiet, g.no, g.quiet AS before, g.closed OR g.d + s.d > 18 AS f, CASE WHEN g.closed OR g.d + s.d > 18 THEN s.d ELSE g.d + s.d END AS total FROM g4 g JOIN seq s ON s.movie_id = g.movie_id AND s.i = g.i + 1)),
grp AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY first_ord) AS group_no FROM (SELECT movie_id, no, min(i) AS first_ord, max(i) AS last_ord, max(d) AS duration_s, bool_or(alone) AS alone, list(shot_id ORDER BY i) AS shot_ids FROM g4 GROUP BY ALL) WHERE duration_s >= 3 AND duration_s <= 18),
{_edge_sql("seam", f"SELECT x.movie_id, x.group_no, {_EDGE_COLUMNS.format(a='a', n='')}, {_EDGE_COLUMNS.format(a='b', n='n_')} FROM grp x JOIN grp y ON y.movie_id = x.movie_id AND y.group_no = x.group_no + 1 JOIN ctx a ON a.movie_id = x.movie_id AND a.shot_ord = x.last_ord JOIN ctx b ON b.movie_id = x.movie_id AND b.shot_ord = y.first_ord")},
gl AS MATERIALIZED (SELECT grp.*, coalesce(joined, false) AS link, lead(duration_s) OVER w AS next_d, lead(alone) OVER w AS next_alone, duration_s BETWEEN 3 AND 4.5 AND NOT alone AS orphan FROM (SELECT movie_id, group_no AS n, joined FROM seam) s RIGHT JOIN (SELECT movie_id AS m, * EXCLUDE (movie_id) FROM grp) g ON s.movie_id = g.m AND s.n = g.group_no WINDOW w AS (PARTITION BY m ORDER BY group_no)),
g5 AS (SELECT m, group_no, 1 AS no, duration_s AS d, alone, link, coalesce(orphan AND link AND NOT next_alone AND duration_s + next_d <= 18, false) AS take FROM gl WHERE group_no = 1
 UNION ALL SELECT m, group_no, CASE WHEN back THEN no ELSE no + 1 END, CASE WHEN back THEN d + own ELSE own END, CASE WHEN back THEN was ELSE alone END, link, NOT back AND coalesce(orphan AND link AND NOT next_alone AND own + next_d <= 18, false)
 FROM (SELECT s.m, s.group_no, s.duration_s AS own, s.alone, s.link, s.orphan, s.next_d, s.next_alone, g.no, g.d, g.alone AS was, g.take OR (s.orphan AND g.link AND NOT g.alone AND g.d + s.duration_s <= 18) AS back FROM g5 g JOIN gl s ON s.m = g.m AND s.group_no = g.group_no + 1)),
evt AS MATERIALIZED (SELECT g5.m AS movie_id, CAST(g5.no AS BIGINT) AS event_no, min(first_ord) AS first_ord, sum(gl.duration_s) AS duration_s, flatten(list(shot_ids ORDER BY g5.group_no)) AS shot_ids FROM g5 JOIN gl ON gl.m = g5.m AND gl.group_no = g5.group_no GROUP BY ALL)
""".replace("grp.*, coalesce(joined", "g.*, coalesce(joined")


def _with_groups(body: str) -> str:
    return _with_edges(_GROUPS + body)


def _groups(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(shots with context, bounded groups of them)."""
    x = cut(_with_vectors(spark, d), "shots")
    return x, cut(sh.bounded_groups(sh.grouping_rows(x, _hists(spark, d))), "groups")


@query(_with_groups("SELECT movie_id, group_no, round(duration_s, 4) AS duration_s, shot_ids FROM grp"))
def g04_bounded_groups(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d)[1].select("movie_id", "group_no", F.round("duration_s", 4).alias("duration_s"), "shot_ids")


@query(_with_groups("SELECT movie_id, event_no, round(duration_s, 4) AS duration_s, shot_ids FROM evt"))
def g05_rescued_groups(spark: SparkSession, d: str) -> DataFrame:
    x, groups = _groups(spark, d)
    return sh.rescue_orphans(groups, x, hists=_hists(spark, d)).select("movie_id", "event_no", F.round("duration_s", 4).alias("duration_s"), "shot_ids")


@query(_with_edges("SELECT movie_id, CAST(run AS BIGINT) AS run, count(*) AS n_shots, list(shot_id ORDER BY shot_ord) AS shot_ids FROM (SELECT ctx.movie_id, ctx.shot_id, ctx.shot_ord, sum(CASE WHEN coalesce(merge, false) THEN 0 ELSE 1 END) OVER (PARTITION BY ctx.movie_id ORDER BY ctx.shot_ord) AS run FROM ctx LEFT JOIN edge ON edge.movie_id = ctx.movie_id AND edge.n_shot_id = ctx.shot_id) GROUP BY ALL"))
def g06_scene_runs(spark: SparkSession, d: str) -> DataFrame:
    return sh.scene_runs(_shots_with_context(spark, d))


def _events(spark: SparkSession, d: str) -> DataFrame:
    """Bounded events after the rescue of orphans, rolled up and scored."""
    x, groups = _groups(spark, d)
    hists = _hists(spark, d)
    events = cut(sh.rescue_orphans(groups, x, hists=hists), "events")
    of = events.select("movie_id", F.col("event_no").alias("run"), F.posexplode("shot_ids").alias("at", "shot_id"))
    ids = iv.overlapped_ids(x, fx.segments(spark, d), ["shot_id"], "segment_id")
    # likeness is worked out for shots that have one before them in their event, with nothing but their keys, and comes back to where shots meet
    by = Window.partitionBy("movie_id", "run").orderBy("at")
    pairs = of.join(shuffled(x.select("movie_id", "shot_id", F.col("vec_id").alias("n_vec_id"))), ["movie_id", "shot_id"]).withColumn("vec_id", F.lag("n_vec_id").over(by)).where("at > 0")
    like = sh.similarities(pairs.select("movie_id", "shot_id", "vec_id", "n_vec_id"), hists)
    x = x.select("movie_id", "shot_id", "shot_ord", "start_s", "end_s", "brightness", "sharpness", "motion", "near_black", "occupancy")
    # of and like go by shuffle: they are exploded from a small file
    x = x.join(shuffled(of.drop("at")), ["movie_id", "shot_id"]).join(ids, ["movie_id", "shot_id"]).join(shuffled(like), ["movie_id", "shot_id"], "left")
    return sh.score_events(sh.event_rollup(x, "run"))


_RUN = _GROUPS + """, sho AS (SELECT movie_id, event_no, unnest(shot_ids) AS shot_id, generate_subscripts(shot_ids, 1) AS nth FROM evt),
rn AS (SELECT ctx.*, event_no AS run, nth, lag(vec_id) OVER (PARTITION BY ctx.movie_id, event_no ORDER BY nth) AS was FROM ctx JOIN sho ON sho.movie_id = ctx.movie_id AND sho.shot_id = ctx.shot_id),
rs AS (SELECT rn.*, greatest(0, least(1, (CASE WHEN a.q * b.q > 0 THEN list_dot_product(a.c, b.c) / sqrt(a.q * b.q) ELSE 1 END + 1) / 2)) AS similarity FROM rn LEFT JOIN hc b ON b.vec_id = rn.vec_id AND nth > 1 LEFT JOIN hc a ON a.vec_id = rn.was),
roll AS (SELECT movie_id, run, min(start_s) AS start_s, max(end_s) AS end_s, count(*) AS n_shots, avg(brightness) AS brightness, avg(sharpness) AS sharpness, avg(motion) AS motion, avg(near_black) AS near_black, avg(occupancy) AS occupancy, coalesce(avg(CASE WHEN nth > 1 THEN similarity END), 1) AS continuity, list(shot_id ORDER BY shot_ord) AS shot_ids FROM rs GROUP BY ALL),
nar AS (SELECT rn.movie_id, run, count(DISTINCT segment_id) AS n_nar FROM rn LEFT JOIN sg ON sg.movie_id = rn.movie_id AND rn.start_s < sg.end_s AND sg.start_s < rn.end_s GROUP BY ALL),
ev2 AS (SELECT roll.*, n_nar, end_s - start_s AS d, CASE WHEN n_shots > 1 AND occupancy >= 0.22 THEN 'conversation' WHEN n_shots > 1 THEN 'interaction' ELSE 'action' END AS kind FROM roll JOIN nar USING (movie_id, run)),
fit AS (SELECT *, CASE WHEN kind = 'action' THEN 4 ELSE 7 END AS lo, CASE WHEN kind = 'action' THEN 9 ELSE 15 END AS hi, CASE WHEN kind = 'action' THEN 12 ELSE 18 END AS al FROM ev2),
parts AS (SELECT *, round(greatest(0, least(100, CASE WHEN d >= lo AND d <= hi THEN 25 WHEN d < lo THEN 25 * (0.45::DOUBLE + 0.55::DOUBLE * d / lo) WHEN d <= al THEN 25 * (1 - 0.35::DOUBLE * (d - hi) / (al - hi)) ELSE greatest(0, 25 * 0.65::DOUBLE * (1 - (d - al) / greatest(8, al))) END)), 2) AS p_duration,
  round(greatest(0, least(100, 25 * (0.45::DOUBLE * least(1, sharpness / 150) + 0.35::DOUBLE * (1 - abs(brightness - 110) / 145) + 0.20::DOUBLE * (1 - near_black)))), 2) AS p_quality,
  round(greatest(0, least(100, 20 * (0.6::DOUBLE * continuity + 0.4::DOUBLE * (1 - least(1, occupancy))))), 2) AS p_continuity, round(greatest(0, least(100, 15 * (1 - least(1, abs(motion - 12) / 20)))), 2) AS p_motion,
  round(greatest(0, least(100, 15 * (1 / (1 + 0.18::DOUBLE * (n_shots - 1))))), 2) AS p_simple FROM fit),
scored AS (SELECT *, round(p_duration + p_quality + p_continuity + p_motion + p_simple, 2) AS total FROM parts)
"""


def _with_runs(body: str) -> str:
    return with_("SELECT", "sh", "cu", "sg").removesuffix("\nSELECT") + _CTX + _RUN + body


@query(_with_runs("SELECT movie_id, CAST(run AS BIGINT) AS run, kind, n_shots, round(d + 1e-7, 3) AS duration_s, round(brightness + 1e-7, 3) AS brightness, round(sharpness + 1e-7, 3) AS sharpness, round(motion + 1e-7, 3) AS motion, round(occupancy + 1e-7, 3) AS occupancy, list_filter(['technical_shot_continuity', CASE WHEN n_shots > 1 THEN 'camera_cut_not_treated_as_asset_boundary' END, CASE WHEN n_nar = 1 THEN 'same_narrative_segment' END, CASE WHEN occupancy >= 0.22 THEN 'subtitle_continuity' END], lambda x: x IS NOT NULL) AS reasons FROM ev2"))
def a06_event_rollup(spark: SparkSession, d: str) -> DataFrame:
    x = _events(spark, d)
    return x.select("movie_id", "run", "kind", "n_shots", *[F.round(F.col(c) + _OFF, 3).alias(c) for c in ("duration_s", "brightness", "sharpness", "motion", "occupancy")], "reasons")


@query(_with_runs("SELECT movie_id, CAST(run AS BIGINT) AS run, round(total, 1) AS total, CASE WHEN total >= 70 THEN 'KEEP' WHEN total >= 50 THEN 'REVIEW' ELSE 'REJECT' END AS structural FROM scored"))
def p02_event_scores(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select("movie_id", "run", rounded(F.col("total"), 1).alias("total"), "structural")


@query(with_("SELECT movie_id, shot_id, round(CASE WHEN d >= lo AND d <= hi THEN 25 WHEN d < lo THEN 25 * (0.45::DOUBLE + 0.55::DOUBLE * d / lo) WHEN d <= al THEN 25 * (1 - 0.35::DOUBLE * (d - hi) / (al - hi)) ELSE greatest(0, 25 * 0.65::DOUBLE * (1 - (d - al) / greatest(8, al))) END, 4) AS fit FROM (SELECT movie_id, shot_id, end_s - start_s AS d, [3, 4, 7, 5][event_id % 4 + 1] AS lo, [7, 9, 15, 10][event_id % 4 + 1] AS hi, [10, 12, 18, 15][event_id % 4 + 1] AS al FROM sh)", "sh"))
def p01_duration_fit(spark: SparkSession, d: str) -> DataFrame:
    kind = fx.pick(("reaction", "action", "Conversation", "mixed"), F.col("event_id") % 4)
    return fx.shots(spark, d).select("movie_id", "shot_id", F.round(sh.duration_fit(F.col("end_s") - F.col("start_s"), kind), 4).alias("fit"))


@query(_with_runs("SELECT CASE WHEN d < 3 THEN 'below_3' WHEN d < 5 THEN '3_to_5' WHEN d < 10 THEN '5_to_10' WHEN d <= 18 THEN '10_to_18' ELSE 'above_18' END AS bucket, count(*) AS events, count(*) FILTER (n_shots > 1) AS multi_shot, round(median(d) + 1e-7, 3) AS median_s, round(avg(d) + 1e-7, 3) AS mean_s FROM ev2 GROUP BY 1"))
def a11_event_health(spark: SparkSession, d: str) -> DataFrame:
    x = sh.event_health(_events(spark, d))
    return x.select("bucket", "events", "multi_shot", F.round(F.col("median_s") + _OFF, 3).alias("median_s"), F.round(F.col("mean_s") + _OFF, 3).alias("mean_s"))


@query(_with_runs("""SELECT movie_id, decision, structural, count(*) AS events, round(avg(total) + 1e-7, 1) AS mean_total FROM (SELECT scored.movie_id, CASE WHEN len(flags) > 0 THEN 'REJECT' WHEN utility IN ('generic_dialogue_only', 'generic_presence_only') AND signal NOT IN ('clear_reaction', 'strong_body_language', 'physical_interaction', 'concrete_activity', 'useful_environment_or_composition') THEN 'REJECT'
 WHEN utility = 'unclear' OR complete = 'unclear' OR context = 'unclear' THEN 'REVIEW' WHEN context = 'high' THEN 'REJECT' WHEN complete = 'false' THEN 'REJECT' WHEN utility IN ('concrete_action', 'object_activity') AND n_actions = 0 THEN 'REVIEW' ELSE 'KEEP' END AS decision, CASE WHEN total >= 70 THEN 'KEEP' WHEN total >= 50 THEN 'REVIEW' ELSE 'REJECT' END AS structural, total
 FROM scored JOIN sh ON sh.movie_id = scored.movie_id AND sh.shot_id = shot_ids[1] JOIN ob USING (event_id)) GROUP BY ALL""").replace("WITH RECURSIVE ", "WITH RECURSIVE ob AS (" + fx.CTE["ob"][1].replace("FROM ev", "FROM (" + fx.CTE["ev"][1] + ")") + "),\n", 1))
def flagship_event_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Per title: events by what the policy decides and by structural score; an event has the observation of its first shot."""
    from cutlight.operators.policy import decide

    first = _events(spark, d).select("movie_id", F.get("shot_ids", 0).alias("shot_id"), "total", "structural")
    keyed = first.join(fx.shots(spark, d).select("movie_id", "shot_id", "event_id"), ["movie_id", "shot_id"]).drop("movie_id")
    x = decide(fx.observations(spark, d)).join(keyed, "event_id")
    return x.groupBy("movie_id", "decision", "structural").agg(F.count(F.lit(1)).alias("events"), F.round(F.avg("total") + _OFF, 1).alias("mean_total"))
