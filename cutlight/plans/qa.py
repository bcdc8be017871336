"""Queries over the checks of rendered assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import qa
from cutlight.registry import query

REASONS = (
    "vertical_unreadable", "insufficient_render_decode", "required_people_not_visible_together", "focused_person_lost_in_render", "intended_target_not_reliably_visible", "target_binding_unstable", "no_render_samples", "all_good",
    "intended_target_not_reliably_visible", "competing_subject_dominates_target", "post_render_detector_error",
)
FACES = ("PASS", "REPAIR", "AMBIGUOUS", "SOURCE_LIMIT")


def _assets(spark: SparkSession, d: str) -> DataFrame:
    """Every part as an asset with up to four shots and audits; flags that are true, false or not there."""
    p = fx.table(spark, d, "part").select(F.col("p_partkey").alias("asset"), F.col("p_size").cast("bigint").alias("z"))
    a, z = F.col("asset"), F.col("z")
    three = lambda n, m, r: F.when(n % m == r, False).when(n % m == r + 1, True)

    def shot(i):
        n = a * 3 + i * 7 + z
        return F.struct(
            F.when(n % 3 != 0, "person").alias("focus_requirement"), three(n, 11, 2).alias("focus_subject_present"), three(n + 1, 9, 3).alias("critical_focus_clipping"), three(n, 13, 5).alias("introduced_subject_clipping"), three(n, 17, 4).alias("crop_stable"),
            three(n, 19, 6).alias("action_preserved"), three(n, 23, 8).alias("interaction_preserved"), three(n, 5, 1).alias("full_bbox_clipping"), three(n, 29, 3).alias("focus_directive_available"),
        )

    def audit(i):
        n = a * 5 + i * 3 + z
        return F.struct(F.when(n % 4 != 3, fx.pick(REASONS, n % len(REASONS))).alias("reason"), F.when(n % 5 != 4, n % 10 / 20).alias("visibility"), F.when(n % 7 != 6, n % 8 / 8).alias("dominance"))

    shots, audits = F.sequence(F.lit(1), z % 4), F.sequence(F.lit(1), a % 4)
    return p.select(
        "asset", three(a, 37, 5).alias("file_exists"), F.when(a % 31 == 3, 0).when(a % 31 != 4, a % 50 + 1).alias("frame_count"), F.when(a % 41 != 7, F.when(a % 41 == 8, 0).otherwise(600)).alias("width"), F.when(a % 43 != 9, 800).alias("height"),
        F.when(a % 10 == 0, "9:16").when(a % 10 != 1, "3:4").alias("aspect_ratio"), three(a, 12, 1).alias("duration_valid"), three(a + 1, 14, 2).alias("black_bars"), three(a, 15, 6).alias("crop_plan_valid"),
        F.when(z % 4 > 0, F.transform(shots, shot)).alias("shots"), F.when(a % 4 > 0, F.transform(audits, audit)).alias("audit"), F.when(z % 5 != 4, fx.pick(FACES, (a + z) % 4)).alias("face"),
    )


def _three(n: str, m: int, r: int) -> str:
    return f"CASE ({n}) % {m} WHEN {r} THEN false WHEN {r + 1} THEN true END"


_WARN = fx._list(qa.WARNINGS)


@query(f"""WITH p AS (SELECT p_partkey AS asset, CAST(p_size AS BIGINT) AS z FROM part),
s0 AS (SELECT asset, i, asset * 3 + i * 7 + z AS n FROM p, unnest(range(1, 4)) t(i) WHERE i <= z % 4),
s1 AS (SELECT *, n % 3 <> 0 AS person, {_three("n", 11, 2)} AS present, coalesce({_three("n + 1", 9, 3)}, false) AS crit, coalesce({_three("n", 13, 5)}, false) AS intro, {_three("n", 17, 4)} AS stable, {_three("n", 19, 6)} AS act, {_three("n", 23, 8)} AS inter, coalesce({_three("n", 5, 1)}, false) AS box, {_three("n", 29, 3)} AS dir FROM s0),
s2 AS (SELECT asset, list([CASE WHEN person AND present = false THEN 'primary_subject_missing' END, CASE WHEN person AND (crit OR intro) THEN 'primary_subject_materially_clipped' END, CASE WHEN stable = false THEN 'severe_reframe_instability' END, CASE WHEN act = false THEN 'required_action_or_region_lost' END, CASE WHEN inter = false THEN 'required_multi_person_interaction_lost' END] ORDER BY i) AS h,
  list([CASE WHEN box AND NOT crit THEN 'noncritical_subject_edge_proximity' END, CASE WHEN dir = false THEN 'focus_directive_unavailable' END] ORDER BY i) AS w FROM s1 GROUP BY asset),
a0 AS (SELECT asset, i, asset * 5 + i * 3 + z AS n FROM p, unnest(range(1, 4)) t(i) WHERE i <= asset % 4),
a1 AS (SELECT asset, i, CASE WHEN n % 4 <> 3 THEN {fx._list(REASONS)}[n % {len(REASONS)} + 1] END AS reason, coalesce(CASE WHEN n % 5 <> 4 THEN n % 10 / 20 END, 1) AS vis, coalesce(CASE WHEN n % 7 <> 6 THEN n % 8 / 8 END, 0) AS dom FROM a0),
a2 AS (SELECT asset, list(CASE WHEN reason IN ('vertical_unreadable', 'insufficient_render_decode') THEN 'vertical_render_unreadable' WHEN reason = 'required_people_not_visible_together' THEN 'required_multi_person_interaction_lost' WHEN reason = 'focused_person_lost_in_render' THEN 'primary_subject_lost_in_render'
   WHEN reason = 'intended_target_not_reliably_visible' AND vis < 0.2 AND dom >= 0.6 THEN 'wrong_subject_or_region_followed' END ORDER BY i) AS h, list(CASE WHEN list_contains({_WARN}, reason) AND NOT (reason = 'intended_target_not_reliably_visible' AND vis < 0.2 AND dom >= 0.6) THEN reason END ORDER BY i) AS w FROM a1 GROUP BY asset),
f AS (SELECT *, CASE WHEN asset % 41 <> 7 THEN CASE WHEN asset % 41 = 8 THEN 0 ELSE 600 END END AS width, CASE WHEN asset % 43 <> 9 THEN 800 END AS height, CASE WHEN z % 5 <> 4 THEN {fx._list(FACES)}[(asset + z) % 4 + 1] END AS face FROM p),
g AS (SELECT f.asset, list_concat(list_concat(list_concat([CASE WHEN {_three("f.asset", 37, 5)} = false THEN 'vertical_render_missing' END, CASE WHEN f.asset % 31 = 3 THEN 'vertical_render_unreadable' END, CASE WHEN coalesce(width, 0) <= 0 OR coalesce(height, 0) <= 0 THEN 'vertical_dimensions_invalid' WHEN f.asset % 10 <= 1 THEN 'vertical_aspect_ratio_invalid' END,
   CASE WHEN {_three("f.asset", 12, 1)} = false THEN 'vertical_duration_invalid' END, CASE WHEN {_three("f.asset + 1", 14, 2)} = true THEN 'severe_black_bars_or_corruption' END, CASE WHEN {_three("f.asset", 15, 6)} = false THEN 'crop_plan_invalid' END], coalesce(flatten(s2.h), [])), coalesce(a2.h, [])), [CASE WHEN face = 'REPAIR' THEN 'important_face_or_head_materially_clipped' END]) AS h,
  list_concat(list_concat(coalesce(flatten(s2.w), []), coalesce(a2.w, [])), [CASE WHEN face NOT IN ('PASS', 'REPAIR') THEN 'face_safe_' || lower(face) END]) AS w FROM f LEFT JOIN s2 ON s2.asset = f.asset LEFT JOIN a2 ON a2.asset = f.asset)
SELECT asset, list_filter(h, lambda x, i: x IS NOT NULL AND NOT list_contains(h[:i - 1], x)) AS hard, list_filter(w, lambda x, i: x IS NOT NULL AND NOT list_contains(w[:i - 1], x)) AS soft FROM g""")
def b17_qa_classes(spark: SparkSession, d: str) -> DataFrame:
    return qa.classify(_assets(spark, d)).select("asset", "hard", "soft")


def _rules(spark: SparkSession, d: str) -> DataFrame:
    """A planned crop for every shot, around its first person in the middle sample, by a rule that goes wrong in many ways."""
    k, e = F.col("k"), F.col("event_id")
    b = fx.boxes(spark, d).where("sample = 2 and person = 1")
    w = F.when(k % 9 == 4, F.col("w") * 5).otherwise(F.col("w"))
    at = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1320.0), F.col("x") + F.col("w") / 2 - 300 + e % 5 * 70 - 140)))
    box = lambda x, w: F.struct(x.cast("double").alias("x"), w.cast("double").alias("w"))
    face = F.struct(fx.pick(FACES, k % 4).alias("decision"), (k % 3 == 0).alias("limited"))
    return b.select(
        "movie_id", "shot_id", F.lit(600.0).alias("crop"), at.cast("double").alias("x"), F.lit(1920.0).alias("source"), F.when(k % 13 != 5, box(F.col("x"), w)).alias("focus"), (k % 3 != 2).alias("person"), F.when(k % 6 == 2, "environment").when(k % 6 == 5, "action_region").alias("subject"),
        (k % 7 == 3).alias("together"), (k % 14 == 3).alias("review"), F.when(k % 8 == 1, e % 2 == 0).alias("bound"), F.when(k % 17 != 4, k % 17 != 5).alias("directive"), F.when(k % 19 == 6, False).alias("keeps_action"),
        F.when(k % 5 == 2, F.array(box(at + 10, F.lit(100)), box(at + k * 7, F.lit(60)))).alias("regions"), F.when(k % 4 == 1, F.array(at, at + e % 3 * 60, at)).alias("anchors").cast("array<double>"), F.when(k % 10 == 7, F.array(face)).alias("faces"),
    )


@query(with_("SELECT", "bx").removesuffix("\nSELECT") + f""",
r0 AS (SELECT movie_id, shot_id, k, event_id, x AS fx, CASE WHEN k % 9 = 4 THEN w * 5 ELSE w END AS fw, floor(greatest(0, least(1320, x + w / 2 - 300 + event_id % 5 * 70 - 140))) AS x, k % 13 <> 5 AS has, k % 3 <> 2 AS person, k % 7 = 3 AS tog FROM bx WHERE sample = 2 AND person = 1),
r1 AS (SELECT *, CASE WHEN tog THEN fx WHEN fw >= 900 THEN fx + fw * 0.4::DOUBLE ELSE fx + fw * 0.3::DOUBLE END AS cx, CASE WHEN tog THEN fw WHEN fw >= 900 THEN fw * 0.22::DOUBLE ELSE fw * 0.4::DOUBLE END AS cw, has AND (fx <= 1 OR fx + fw >= 1919) AS edge, CASE WHEN k % 10 = 7 THEN {fx._list(FACES)}[k % 4 + 1] = 'REPAIR' END AS face FROM r0),
r2 AS (SELECT *, has AND NOT (fx >= x + 48 AND fx + fw <= x + 552) AS full_, has AND NOT (cx >= x + 48 AND cx + cw <= x + 552) AND NOT edge AS clip FROM r1),
r3 AS (SELECT *, coalesce(face, clip) AS crit, coalesce(face, clip AND person) AS intro, coalesce(face, clip AND person AND abs(cx + cw / 2 - (x + 300)) > 120) AS gap, CASE WHEN face IS NOT NULL THEN k % 3 = 0 ELSE edge END AS exception, NOT tog OR k % 14 <> 3 AS inter,
  k % 19 <> 6 AND (k % 5 <> 2 OR (k * 7 + 60 <= 600)) AS act, k % 4 <> 1 OR event_id % 3 * 60 <= 109 AS stable FROM r2)
SELECT movie_id, shot_id, CASE WHEN person THEN 'person' WHEN k % 6 = 2 THEN 'environment' WHEN k % 6 = 5 THEN 'action' ELSE 'none' END AS requirement, CASE WHEN person THEN has END AS present, full_ AS full_bbox_clipping, crit AS critical_focus_clipping, intro AS introduced_subject_clipping, exception AS source_edge_exception, gap AS empty_space_while_clipped,
 inter AS interaction_preserved, act AS action_preserved, stable AS crop_stable, CASE WHEN k % 17 <> 5 AND (NOT person OR has) AND (NOT person OR k % 8 <> 1 OR event_id % 2 = 0) AND NOT intro AND NOT gap AND stable AND inter AND act THEN 'PASS' ELSE 'FAIL' END AS status FROM r3""")
def b15_shot_geometry(spark: SparkSession, d: str) -> DataFrame:
    x = qa.shot_geometry(_rules(spark, d))
    return x.select(
        "movie_id", "shot_id", "requirement", "present", "full_bbox_clipping", "critical_focus_clipping", "introduced_subject_clipping", "source_edge_exception", "empty_space_while_clipped", "interaction_preserved", "action_preserved", "crop_stable", "status",
    )
