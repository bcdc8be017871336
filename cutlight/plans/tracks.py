"""Queries over persons followed through a shot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import tracks as tr
from cutlight.registry import query

WIDTH = 1920.0


def _samples(spark: SparkSession, d: str, looked: Column | None = None) -> DataFrame:
    """Five samples of every shot, or of those looked at; where k is 77, the fourth one has the time of the third."""
    s = fx.dealt_shots(spark, d)
    s = (s if looked is None else s.where(looked)).select("movie_id", "shot_id", "k", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("sample"))
    return s.select("movie_id", "shot_id", "sample", F.when((F.col("k") == 77) & (F.col("sample") == 3), 2.0).otherwise(F.col("sample").cast("double")).alias("t"))


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    """The detected persons, with what goes wrong: nobody in sample 3, a second person close to the first in sample 1, a person much larger, or much wider, in sample 4, two boxes that fall together in sample 4."""
    k, s, p = F.col("k"), F.col("sample"), F.col("person")
    b = fx.boxes(spark, d).where(~((k % 10 == 1) & (s == 3)) & ~((k % 25 == 9) & (s == 2)))
    near = (k % 10 == 4) & (s == 1) & (p == 2)
    x = F.when(near, F.col("x") - 90).when((k % 10 == 8) & (s == 4) & (p == 2), F.col("x") - 95).otherwise(F.col("x"))
    large, wide = (k % 10 == 5) & (s == 4), (k % 10 == 6) & (s == 4)
    w = F.when(large, F.col("w") * 3).when(wide, F.col("w") * 2).otherwise(F.col("w"))
    h = F.when(large, F.col("h") * 3).when(wide, F.col("h") / 2).otherwise(F.col("h"))
    return b.select("movie_id", "shot_id", "k", "sample", "person", x.alias("x"), "y", w.alias("w"), h.alias("h"), "confidence")


_TB = """,
tb_b AS MATERIALIZED (SELECT movie_id, shot_id, k, sample, person, CASE WHEN k % 10 = 4 AND sample = 1 AND person = 2 THEN x - 90 WHEN k % 10 = 8 AND sample = 4 AND person = 2 THEN x - 95 ELSE x END AS x, y,
  CASE WHEN k % 10 = 5 AND sample = 4 THEN w * 3 WHEN k % 10 = 6 AND sample = 4 THEN w * 2 ELSE w END AS w, CASE WHEN k % 10 = 5 AND sample = 4 THEN h * 3 WHEN k % 10 = 6 AND sample = 4 THEN h / 2 ELSE h END AS h, confidence
  FROM bx WHERE NOT (k % 10 = 1 AND sample = 3) AND NOT (k % 25 = 9 AND sample = 2)),
tb AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY movie_id, shot_id, sample ORDER BY x + w / 2, y, confidence DESC, person) AS label FROM tb_b),
tc AS (SELECT a.movie_id, a.shot_id, a.sample, a.label, u.step, b.label AS dest, CASE WHEN b.label IS NOT NULL THEN least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x) END AS ix, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y) AS iy,
  a.w * a.h AS aa, b.w * b.h AS ba, abs((b.x + b.w / 2) - (a.x + a.w / 2)) / 1920 AS center, abs(ln((b.w * b.h) / (a.w * a.h))) AS area, abs(ln((b.w / b.h) / (a.w / a.h))) AS aspect
  FROM (SELECT *, unnest([1, -1]) AS step FROM tb) u JOIN tb a ON a.movie_id = u.movie_id AND a.shot_id = u.shot_id AND a.sample = u.sample AND a.label = u.label
  LEFT JOIN tb b ON b.movie_id = a.movie_id AND b.shot_id = a.shot_id AND b.sample = a.sample + u.step WHERE a.sample + u.step BETWEEN 0 AND 4),
ti AS (SELECT *, CASE WHEN ix > 0 AND iy > 0 THEN ix * iy / (aa + ba - ix * iy) ELSE 0 END AS iou FROM tc),
tk AS (SELECT *, (1 - iou) * 0.5::DOUBLE + center * 1.75::DOUBLE + least(area, 2) * 0.18::DOUBLE + least(aspect, 2) * 0.1::DOUBLE AS cost FROM ti),
tn AS (SELECT *, row_number() OVER (PARTITION BY movie_id, shot_id, sample, label, step ORDER BY cost, dest) AS o, lead(cost) OVER (PARTITION BY movie_id, shot_id, sample, label, step ORDER BY cost, dest) AS second FROM tk),
te AS MATERIALIZED (SELECT *, CASE WHEN dest IS NULL THEN 'no_person_candidates' WHEN second - cost < 0.05::DOUBLE THEN 'ambiguous_identity_continuity' WHEN NOT ((iou >= 0.01 OR center <= 0.18) AND area <= 1.4 AND aspect <= 0.9) THEN 'identity_discontinuity' ELSE 'geometry_continuity' END AS reason FROM tn WHERE o = 1)
"""
_HEAD = with_("SELECT", "bx").removesuffix("\nSELECT") + _TB
# two walks along the continuations, from each label of the middle sample on
_WALKED = """, wf(movie_id, shot_id, target, sample, label, step, reason, cost) AS (
 SELECT movie_id, shot_id, label, 2, label, 1, NULL::VARCHAR, NULL::DOUBLE FROM tb WHERE sample = 2
 UNION ALL SELECT w.movie_id, w.shot_id, w.target, w.sample + 1, CASE WHEN e.reason = 'geometry_continuity' THEN e.dest END, 1, e.reason, CASE WHEN e.reason IN ('geometry_continuity', 'identity_discontinuity') THEN e.cost END
 FROM wf w JOIN te e ON e.movie_id = w.movie_id AND e.shot_id = w.shot_id AND e.sample = w.sample AND e.label = w.label AND e.step = 1),
wb(movie_id, shot_id, target, sample, label, step, reason, cost) AS (
 SELECT movie_id, shot_id, label, 2, label, -1, NULL::VARCHAR, NULL::DOUBLE FROM tb WHERE sample = 2
 UNION ALL SELECT w.movie_id, w.shot_id, w.target, w.sample - 1, CASE WHEN e.reason = 'geometry_continuity' THEN e.dest END, -1, e.reason, CASE WHEN e.reason IN ('geometry_continuity', 'identity_discontinuity') THEN e.cost END
 FROM wb w JOIN te e ON e.movie_id = w.movie_id AND e.shot_id = w.shot_id AND e.sample = w.sample AND e.label = w.label AND e.step = -1),
wk AS MATERIALIZED (SELECT * FROM wf UNION ALL SELECT * FROM wb WHERE sample < 2),
wr AS MATERIALIZED (SELECT w.movie_id, w.shot_id, w.target, w.sample, CASE WHEN k = 77 AND w.sample = 3 THEN 2 ELSE w.sample END AS t, x, y, w.w, h FROM (SELECT wk.*, tb.k, x, y, tb.w, h FROM wk JOIN tb ON tb.movie_id = wk.movie_id AND tb.shot_id = wk.shot_id AND tb.sample = wk.sample AND tb.label = wk.label) w)
"""
_WALK = _WALKED + """,
tg AS MATERIALIZED (SELECT movie_id, shot_id, k, unnest(CASE WHEN k % 3 = 2 THEN [1, 2] WHEN k % 3 = 1 THEN [1, 2, 2] ELSE [1] END) AS target, generate_subscripts(CASE WHEN k % 3 = 2 THEN [1, 2] WHEN k % 3 = 1 THEN [1, 2, 2] ELSE [1] END, 1) AS nth FROM sh),
td AS MATERIALIZED (SELECT g.movie_id, g.shot_id, g.k, g.nth, g.target, (SELECT count(*) FROM wr WHERE wr.movie_id = g.movie_id AND wr.shot_id = g.shot_id AND wr.target = g.target) AS n,
 (SELECT arg_min(reason, (-step, abs(sample - 2))) FROM wk WHERE wk.movie_id = g.movie_id AND wk.shot_id = g.shot_id AND wk.target = g.target AND reason <> 'geometry_continuity') AS failure FROM tg g)
"""


@query(_HEAD + "SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, 'P' || label AS label, step, CASE WHEN reason = 'geometry_continuity' THEN 'P' || dest END AS \"to\", reason, CASE WHEN reason IN ('geometry_continuity', 'identity_discontinuity') THEN round(cost + 1e-7, 4) END AS cost FROM te")
def b05_track_continuity(spark: SparkSession, d: str) -> DataFrame:
    x = tr.continuations(_samples(spark, d), tr.bound_boxes(_boxes(spark, d)), WIDTH)
    return x.select("movie_id", "shot_id", "sample", "label", "step", "to", "reason", F.round(F.col("cost") + 1e-7, 4).alias("cost"))


def _targets(spark: SparkSession, d: str) -> DataFrame:
    p = lambda *n: F.array(*[F.lit(f"P{i}") for i in n])
    k = F.col("k")
    return fx.dealt_shots(spark, d).select("movie_id", "shot_id", F.when(k % 3 == 2, p(1, 2)).when(k % 3 == 1, p(1, 2, 2)).otherwise(p(1)).alias("targets"))


@query(_HEAD + _WALK + """SELECT movie_id, shot_id, 'P' || target AS target, n = 5 AS complete, CASE WHEN n = 0 THEN 'target_not_found_at_reference_sample' ELSE failure END AS reason, CAST(n AS INTEGER) AS found,
 coalesce((SELECT list(round(x, 4) ORDER BY sample) FROM wr WHERE wr.movie_id = td.movie_id AND wr.shot_id = td.shot_id AND wr.target = td.target), []) AS xs,
 coalesce((SELECT list(step || ':' || sample || ':' || reason ORDER BY -step, abs(sample - 2)) FROM wk WHERE wk.movie_id = td.movie_id AND wk.shot_id = td.shot_id AND wk.target = td.target AND reason IS NOT NULL), []) AS steps
FROM (SELECT DISTINCT movie_id, shot_id, target, n, failure FROM td) td""")
def b06_bidirectional_track(spark: SparkSession, d: str) -> DataFrame:
    targets = _targets(spark, d).select("movie_id", "shot_id", F.explode("targets").alias("target")).distinct()
    x = tr.tracks(_samples(spark, d), _boxes(spark, d), targets, WIDTH)
    steps = F.transform("steps", lambda s: F.concat_ws(":", s["step"].cast("string"), s["sample"].cast("string"), s["reason"]))
    return x.select("movie_id", "shot_id", "target", "complete", "reason", F.size("track").alias("found"), F.transform("track", lambda r: F.round(r["x"], 4)).alias("xs"), steps.alias("steps"))


@query(_HEAD + _WALK + """, ja AS (SELECT movie_id, shot_id, count(*) AS wanted, bool_and(n = 5) AS whole, arg_min('P' || target, nth) FILTER (n < 5) AS failed, arg_min(CASE WHEN n = 0 THEN 'target_not_found_at_reference_sample' ELSE failure END, nth) FILTER (n < 5) AS failure FROM td GROUP BY ALL),
jb AS MATERIALIZED (SELECT g.movie_id, g.shot_id, g.nth, r.sample, r.t, r.x, r.y, r.w, r.h FROM tg g JOIN wr r ON r.movie_id = g.movie_id AND r.shot_id = g.shot_id AND r.target = g.target),
jt AS (SELECT movie_id, shot_id, t, count(*) AS n, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM jb GROUP BY ALL),
js AS (SELECT ja.movie_id, ja.shot_id, bool_or(n <> wanted) AS short FROM ja JOIN jt USING (movie_id, shot_id) GROUP BY ALL),
jc AS (SELECT DISTINCT movie_id, shot_id FROM (SELECT a.movie_id, a.shot_id, a.w * a.h AS aa, b.w * b.h AS ba, greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS i
 FROM jb a JOIN jb b ON a.movie_id = b.movie_id AND a.shot_id = b.shot_id AND a.t = b.t AND (a.nth, a.sample) < (b.nth, b.sample)) WHERE i / (aa + ba - i) >= 0.95),
jr AS (SELECT ja.*, CASE WHEN NOT whole THEN failure WHEN short THEN 'incomplete_multi_person_tracking' WHEN jc.movie_id IS NOT NULL THEN 'required_participants_collapsed' END AS reason FROM ja LEFT JOIN js ON js.movie_id = ja.movie_id AND js.shot_id = ja.shot_id LEFT JOIN jc ON jc.movie_id = ja.movie_id AND jc.shot_id = ja.shot_id)
SELECT movie_id, shot_id, reason IS NULL AS complete, reason, failed, CASE WHEN reason IS NULL THEN (SELECT list([round(x + 1e-7, 3), round(y + 1e-7, 3), round(w + 1e-7, 3), round(h + 1e-7, 3)] ORDER BY t) FROM jt WHERE jt.movie_id = jr.movie_id AND jt.shot_id = jr.shot_id) ELSE [] END AS boxes FROM jr""")
def b07_joint_tracks(spark: SparkSession, d: str) -> DataFrame:
    x = tr.joint_tracks(_samples(spark, d), _boxes(spark, d), _targets(spark, d), WIDTH)
    boxes = F.transform("track", lambda r: F.array(*[F.round(r[c] + 1e-7, 3) for c in ("x", "y", "w", "h")]))
    return x.select("movie_id", "shot_id", "complete", "reason", "failed", boxes.alias("boxes"))
