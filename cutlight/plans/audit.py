"""Queries over the audit of rendered pictures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import audit as au
from cutlight.operators.crops import NEEDS, SUBJECTS
from cutlight.registry import query
from cutlight.session import cut, tasks

_KEYS = ["movie_id", "asset", "shot_id"]
FACES = ("PASS", "REPAIR", "AMBIGUOUS", "SOURCE_LIMIT", "PASS")


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plans, frames and persons: crops of 600 shown at 300 x 400 that move or stand; frames that do not decode, detectors that fail, persons who are lost, small, large, at the edge, or somewhere else."""
    k, e = F.col("k"), F.col("event_id")
    asset = F.floor((F.col("shot_ord") - 1) / 3).alias("asset")
    # written once; the boxes of a shot are made in tasks of about 10,000 shots, dealt by what the tables below meet by
    s = cut(fx.shots(spark, d).select("movie_id", asset, "shot_id", "k", "event_id", "value"), "shots")
    b = fx.boxes_of(s.repartition(tasks(s, 10_000), *_KEYS), "asset")
    one = b.where("person = 1")
    # the crop is planned around the first person of the first sample, or beside it
    left = s.join(one.where("sample = 0").select(*_KEYS, F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1320.0), F.col("x") + F.col("w") / 2 - 300 + e % 4 * 90))).alias("left")), _KEYS)
    track = one.groupBy(*_KEYS).agg(F.sort_array(F.collect_list(F.struct(F.col("sample").cast("double").alias("t"), "x", "y", "w", "h"))).alias("targets"))
    anchor = lambda t, x: F.struct(F.lit(t).alias("t"), x.cast("double").alias("x"))
    plans = left.join(track, _KEYS).select(
        *_KEYS, fx.pick(SUBJECTS[:3], e % 3).alias("subject"), fx.pick(NEEDS, F.floor(k / 4) % 4).alias("need"), (k % 15 != 2).alias("person"), F.when(k % 6 != 1, k % 14 != 3).alias("bound"), F.when(k % 10 < 4, 900.0).otherwise(200.0).alias("focus_w"),
        F.lit(600.0).alias("crop"), F.lit(300.0).alias("width"), F.lit(400.0).alias("height"), F.when(k % 3 == 0, F.array(anchor(0.0, F.col("left")))).otherwise(F.array(anchor(0.0, F.col("left")), anchor(4.0, F.col("left") + k % 3 * 42))).alias("anchors"),
        F.when(k % 6 != 1, F.col("targets")).alias("targets"), F.lit(0.0).alias("start"), F.lit(5.0).alias("end"), F.lit(0).alias("first"), F.lit(50).alias("last"),
    )
    n = F.col("sample")
    frames = s.where(k % 37 != 8).select(*_KEYS, "k", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("sample")).select(*_KEYS, (n * 10 + 2).alias("frame"), (~(((k + n) % 10 == 3) | ((k % 12 == 5) & (n >= 2)))).alias("decoded"), ((k % 31 == 6) & (n == 3)).alias("failed"))
    gone = ((k % 9 == 1) & (n >= 1)) | ((k % 9 == 2) & (n >= 3)) | ((k % 9 == 5) & (F.col("person") == 1) & (n != 2))
    size = F.when(k % 7 == 4, 0.2).when((k % 8 == 3) & (F.col("person") == 2), 1.6).when(k % 29 == 11, 0.002).otherwise(1.0)
    drift = F.when(k % 5 == 3, n * 150).when(k % 5 == 4, n % 2 * 260).otherwise(0)
    p = b.join(left.select(*_KEYS, "left"), _KEYS).where(~gone)
    people = p.select(*_KEYS, (n * 10 + 2).alias("frame"), "person", ((F.col("x") + drift - F.col("left")) / 2).alias("x"), (F.col("y") / 2).alias("y"), (F.col("w") * size / 2).alias("w"), (F.col("h") * size / 2).alias("h"))
    return plans, frames, people


_HEAD = with_("SELECT", "bx").removesuffix("\nSELECT") + f""",
ua AS MATERIALIZED (SELECT s.movie_id, (s.shot_ord - 1) // 3 AS asset, s.shot_id, s.k, s.event_id, floor(greatest(0, least(1320, b.x + b.w / 2 - 300 + s.event_id % 4 * 90))) AS "left" FROM sh s JOIN bx b ON b.movie_id = s.movie_id AND b.shot_id = s.shot_id AND b.sample = 0 AND b.person = 1),
up AS MATERIALIZED (SELECT b.movie_id, b.shot_id, b.sample, b.person, (b.x + CASE WHEN b.k % 5 = 3 THEN b.sample * 150 WHEN b.k % 5 = 4 THEN b.sample % 2 * 260 ELSE 0 END - u."left") / 2 AS x, b.w * z / 2 AS w, b.h * z / 2 AS h
  FROM (SELECT *, CASE WHEN k % 7 = 4 THEN 0.2 WHEN k % 8 = 3 AND person = 2 THEN 1.6 WHEN k % 29 = 11 THEN 0.002 ELSE 1 END::DOUBLE AS z FROM bx) b JOIN ua u ON u.movie_id = b.movie_id AND u.shot_id = b.shot_id
  WHERE NOT ((b.k % 9 = 1 AND b.sample >= 1) OR (b.k % 9 = 2 AND b.sample >= 3) OR (b.k % 9 = 5 AND b.person = 1 AND b.sample <> 2)) AND b.w * z / 2 > 1 AND b.h * z / 2 > 1),
uf AS MATERIALIZED (SELECT u.*, s.sample, NOT ((k + s.sample) % 10 = 3 OR (k % 12 = 5 AND s.sample >= 2)) AS decoded, k % 31 = 6 AND s.sample = 3 AS failed, (s.sample * 10 + 2) / 50 * 5 AS t FROM ua u, unnest(range(0, 5)) s(sample) WHERE k % 37 <> 8),
ux AS (SELECT f.*, b.w / 2 AS tw, CASE WHEN f.k % 6 = 1 THEN 150 ELSE (b.x + b.w / 2 - round_even(CASE WHEN f.k % 3 = 0 THEN f."left" WHEN t <= 4 THEN f."left" + f.k % 3 * 42 * t / 4 ELSE f."left" + f.k % 3 * 42 END, 0)) * 300 / 600 END AS spot FROM uf f JOIN bx b ON b.movie_id = f.movie_id AND b.shot_id = f.shot_id AND b.sample = f.sample AND b.person = 1),
un AS MATERIALIZED (SELECT x.*, p.person, p.x, p.w, p.h, row_number() OVER (PARTITION BY x.movie_id, x.shot_id, x.sample ORDER BY abs(p.x + p.w / 2 - spot), p.person) AS o FROM ux x LEFT JOIN up p ON x.decoded AND p.movie_id = x.movie_id AND p.shot_id = x.shot_id AND p.sample = x.sample),
uq AS (SELECT movie_id, asset, shot_id, sample, decoded, failed, count(person) AS n, max(w * h) AS most, coalesce(bool_or(x < 180 AND x + w > 120), false) AS covered, any_value(k) AS k, any_value(spot) AS spot, any_value(tw) AS tw FROM un GROUP BY ALL),
us AS (SELECT q.*, b.x, b.w, b.h, b.person IS NOT NULL AND (q.k % 6 = 1 OR abs(b.x + b.w / 2 - q.spot) <= greatest(300 * 0.28::DOUBLE, q.tw * 0.9::DOUBLE)) AS seen FROM uq q JOIN un b ON b.movie_id = q.movie_id AND b.shot_id = q.shot_id AND b.sample = q.sample AND b.o = 1),
ul AS (SELECT *, lead(x + w / 2) OVER (PARTITION BY movie_id, shot_id ORDER BY sample) AS next FROM us WHERE seen),
um AS (SELECT movie_id, shot_id, count(*) AS hit, count(*) FILTER (x <= 12 OR x + w >= 288) AS edge, count(*) FILTER (most > w * h * 1.15::DOUBLE) AS rival, count(*) FILTER (abs(x + w / 2 - 150) / 300 <= 0.33) AS centered, median(w * h / 120000) AS occ, median(abs(x + w / 2 - 150) / 300) AS off, count(*) FILTER (abs(next - (x + w / 2)) / 300 > 0.38) AS leaps FROM ul GROUP BY ALL),
uc AS (SELECT movie_id, shot_id, count(*) AS samples, count(*) FILTER (decoded) AS dec, count(*) FILTER (n > 0) AS pres, count(*) FILTER (n >= 2) AS tog, count(*) FILTER (n >= 2 AND NOT covered) AS hol, bool_or(failed) AS failed FROM us GROUP BY ALL),
uz AS (SELECT a.movie_id, a.asset, a.shot_id, a.k, {fx._list(SUBJECTS[:3])}[a.event_id % 3 + 1] AS subject, {fx._list(NEEDS)}[a.k // 4 % 4 + 1] AS need, coalesce(samples, 0) AS samples, failed, dec / samples AS decoded, pres / samples AS present, tog / samples AS together, coalesce(centered, 0) / samples AS centered,
  round(coalesce(hit, 0) / samples, 4) AS visible, round(greatest(0, (coalesce(hit, 0) - coalesce(leaps, 0)) / samples), 4) AS stable, round(coalesce(edge, 0) / greatest(1, coalesce(hit, 0)), 4) AS edge, round(coalesce(rival, 0) / greatest(1, coalesce(hit, 0)), 4) AS rival, round(hol / greatest(1, dec), 4) AS hollow, round(coalesce(occ, 0), 4) AS occupancy, round(off, 4) AS off_center
  FROM ua a LEFT JOIN uc c ON c.movie_id = a.movie_id AND c.shot_id = a.shot_id LEFT JOIN um m ON m.movie_id = a.movie_id AND m.shot_id = a.shot_id),
ud AS MATERIALIZED (SELECT *, CASE WHEN k % 15 = 2 THEN 'PASS person_audit_not_applicable' WHEN k % 6 <> 1 AND k % 14 = 3 THEN 'RETRY semantic_target_binding_unresolved' WHEN samples = 0 THEN 'AMBIGUOUS no_render_samples' WHEN failed THEN 'AMBIGUOUS post_render_detector_error' WHEN decoded < 0.8 THEN 'AMBIGUOUS insufficient_render_decode'
   WHEN subject = 'multiple_people' AND together < 0.6 THEN CASE WHEN need = 'simultaneous' THEN 'RETRY required_people_not_visible_together' ELSE 'AMBIGUOUS multiple_people_not_reliably_observed' END WHEN subject = 'multiple_people' THEN 'PASS rendered_subject_present_and_usable'
   WHEN present < 0.6 THEN CASE WHEN k % 10 < 4 THEN 'AMBIGUOUS close_up_person_detection_inconclusive' ELSE 'RETRY focused_person_lost_in_render' END WHEN visible < 0.6 THEN 'AMBIGUOUS intended_target_not_reliably_visible' WHEN stable < 0.6 THEN 'AMBIGUOUS target_binding_unstable'
   WHEN edge >= 0.6 THEN 'RETRY focused_person_persistently_at_crop_edge' WHEN need <> 'simultaneous' AND hollow >= 0.4 THEN 'AMBIGUOUS crop_centered_between_competing_subjects' WHEN need <> 'simultaneous' AND rival >= 0.4 AND edge >= 0.4 THEN 'AMBIGUOUS competing_subject_dominates_target'
   WHEN occupancy < 0.025 THEN 'AMBIGUOUS target_too_small_for_editorial_use' WHEN k % 6 = 1 AND together >= 0.4 THEN 'AMBIGUOUS legacy_multi_person_identity_unbound' ELSE 'PASS rendered_subject_present_and_usable' END AS said FROM uz)
"""


@query(_HEAD + """SELECT movie_id, asset, shot_id, split_part(said, ' ', 1) AS decision, split_part(said, ' ', 2) AS reason, CASE WHEN k % 15 = 2 OR (k % 6 <> 1 AND k % 14 = 3) THEN 0 ELSE samples END AS samples, round(decoded, 4) AS decoded, round(present, 4) AS present, round(centered, 4) AS centered, round(together, 4) AS together,
 visible, stable, CASE WHEN samples > 0 THEN edge END AS edge, CASE WHEN samples > 0 THEN rival END AS rival, hollow FROM ud""")
def b16_shot_audit(spark: SparkSession, d: str) -> DataFrame:
    x = au.shot_audit(*_inputs(spark, d))
    r = lambda c: F.round(c, 4).alias(c)
    return x.select(*_KEYS, "decision", "reason", F.col("samples").cast("bigint").alias("samples"), *[r(c) for c in ("decoded", "present", "centered", "together", "visible", "stable", "edge", "rival", "hollow")])


@query(_HEAD + f""", uh AS (SELECT movie_id, asset, bool_or(said LIKE 'RETRY%') AS again, bool_or(said LIKE 'AMBIGUOUS%') AS unsure, CASE WHEN asset % 6 <> 5 THEN {fx._list(FACES)}[asset % 5 + 1] ELSE 'PASS' END AS face FROM ud GROUP BY ALL)
SELECT movie_id, asset, CASE WHEN again OR face = 'REPAIR' THEN 'RETRY' WHEN unsure OR face <> 'PASS' THEN 'AMBIGUOUS' ELSE 'PASS' END AS decision,
 CASE WHEN face <> 'PASS' THEN 'face_safe_' || lower(face) WHEN again THEN 'one_or_more_shots_need_reframe' WHEN unsure THEN 'one_or_more_shots_need_semantic_or_identity_review' ELSE 'all_rendered_shots_pass' END AS reason, CASE WHEN face = 'REPAIR' THEN 'face_priority' END AS strategy FROM uh""")
def b16_asset_audit(spark: SparkSession, d: str) -> DataFrame:
    plans, frames, people = _inputs(spark, d)
    faces = plans.select("movie_id", "asset").distinct().where("asset % 6 <> 5").select("movie_id", "asset", fx.pick(FACES, F.col("asset") % 5).alias("face"))
    return au.asset_audit(au.shot_audit(plans, frames, people), faces)
