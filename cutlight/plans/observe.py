"""Queries over observations, records and decisions, and over detection boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import geometry as geo
from cutlight.operators import intervals as iv
from cutlight.operators import policy as po
from cutlight.registry import query

_r = lambda c: F.round(F.col(c) + 1e-7, 4).alias(c)

_USEFUL = "('clear_reaction', 'strong_body_language', 'physical_interaction', 'concrete_activity', 'useful_environment_or_composition')"
_DECIDE = f"""CASE WHEN len(flags) > 0 THEN 'REJECT' WHEN utility IN ('generic_dialogue_only', 'generic_presence_only') AND signal NOT IN {_USEFUL} THEN 'REJECT' WHEN utility = 'unclear' OR complete = 'unclear' OR context = 'unclear' THEN 'REVIEW'
 WHEN context = 'high' THEN 'REJECT' WHEN complete = 'false' THEN 'REJECT' WHEN utility IN ('concrete_action', 'object_activity') AND n_actions = 0 THEN 'REVIEW' ELSE 'KEEP' END"""
_REASONS = f"""CASE WHEN len(flags) > 0 THEN list_transform(flags, lambda f: 'hard_exclusion:' || f) WHEN utility IN ('generic_dialogue_only', 'generic_presence_only') AND signal NOT IN {_USEFUL} THEN ['generic_dialogue_or_presence_without_independent_visual_signal'] WHEN utility = 'unclear' OR complete = 'unclear' OR context = 'unclear' THEN ['insufficient_observation']
 WHEN context = 'high' THEN ['high_context_dependency'] WHEN complete = 'false' THEN ['incomplete_moment_without_reusable_state'] WHEN utility IN ('concrete_action', 'object_activity') AND n_actions = 0 THEN ['action_utility_without_canonical_action_evidence']
 ELSE list_filter(['useful_visual_utility:' || utility, CASE WHEN signal IN {_USEFUL} THEN 'independent_conversation_signal:' || signal END], lambda x: x IS NOT NULL) END"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    return fx.records(spark, d).withColumn("fingerprint", F.sha2(F.concat_ws(":", F.col("event_id").cast("string"), F.col("r").cast("string")).cast("binary"), 256))


@query(with_(f"SELECT movie_id, event_id, {_DECIDE} AS decision, {_REASONS} AS reasons FROM ob", "ob"))
def p03_policy_v1(spark: SparkSession, d: str) -> DataFrame:
    return po.decide(fx.observations(spark, d))


@query(with_("SELECT movie_id, event_id, r, contract, created_us FROM rec WHERE valid QUALIFY row_number() OVER (PARTITION BY movie_id, event_id ORDER BY CASE contract WHEN 'visual_reuse' THEN 1 WHEN 'temporal_v2' THEN 2 ELSE 3 END, created_us DESC) = 1", "rec"))
def w09_latest_record(spark: SparkSession, d: str) -> DataFrame:
    return po.latest_records(_records(spark, d)).select("movie_id", "event_id", F.col("r").cast("bigint").alias("r"), "contract", "created_us")


@query(with_("SELECT movie_id, event_id FROM ob WHERE NOT EXISTS (SELECT 1 FROM rec WHERE rec.event_id = ob.event_id AND valid)", "ob", "rec"))
def j10_events_without_record(spark: SparkSession, d: str) -> DataFrame:
    return po.without_valid_record(fx.observations(spark, d).select("movie_id", "event_id"), fx.records(spark, d))


@query(with_("SELECT movie_id, CASE WHEN rich THEN 'COMPLETED' WHEN anyv THEN 'RESOLVED' ELSE 'PAID' END AS bucket, count(*) AS n FROM (SELECT movie_id, event_id, bool_or(valid AND contract <> 'v1') AS rich, bool_or(valid) AS anyv FROM rec GROUP BY ALL) GROUP BY ALL", "rec"))
def p14_enrichment_plan(spark: SparkSession, d: str) -> DataFrame:
    return po.enrichment_plan(fx.observations(spark, d), fx.records(spark, d))


@query(with_(f"SELECT old_decision, new_decision, count(*) AS n, list(event_id ORDER BY event_id) AS event_ids FROM (SELECT event_id, {_DECIDE} AS old_decision FROM ob) JOIN (SELECT event_id, {_DECIDE} AS new_decision FROM (SELECT * REPLACE (CASE WHEN context = 'unclear' THEN 'low' ELSE context END AS context) FROM ob)) USING (event_id) GROUP BY ALL", "ob"))
def a12_transition_matrix(spark: SparkSession, d: str) -> DataFrame:
    ob = fx.observations(spark, d)
    return po.transitions(po.decide(ob), po.decide(ob.withColumn("context", F.when(F.col("context") == "unclear", "low").otherwise(F.col("context")))))


@query(with_("SELECT movie_id, event_id, list_filter([CASE WHEN utility IS NULL THEN 'missing:utility' WHEN utility = 'unclear' THEN 'unknown:utility' END, CASE WHEN context IS NULL THEN 'missing:context' END], lambda x: x IS NOT NULL) AS errors FROM (SELECT movie_id, event_id, CASE WHEN k <> 44 THEN utility END AS utility, CASE WHEN k <> 45 THEN context END AS context FROM ob)", "ob"))
def v14_observation_contract(spark: SparkSession, d: str) -> DataFrame:
    ob = fx.observations(spark, d).withColumn("utility", F.when(F.col("k") != 44, F.col("utility"))).withColumn("context", F.when(F.col("k") != 45, F.col("context")))
    known = tuple(u for u in fx.UTILITIES if u != "unclear")
    return ob.select("movie_id", "event_id", po.observation_errors(known, fx.SIGNALS, ("true", "false", "unclear"), ("low", "medium", "high", "unclear")).alias("errors"))


@query(with_(f"SELECT movie_id, event_id, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 9 = 0 THEN 'REVIEW' ELSE {_DECIDE} END AS effective FROM ob", "ob"))
def v13_effective_decision(spark: SparkSession, d: str) -> DataFrame:
    ob = fx.observations(spark, d)
    x = po.decide(ob).join(ob.select("event_id", "k"), "event_id")
    proposed = F.when(F.col("k") % 17 != 0, F.col("decision"))
    wrong = F.when(F.col("k") % 9 == 0, F.array(F.lit("invalid"))).otherwise(F.array().cast("array<string>"))
    return x.select("movie_id", "event_id", po.effective_decision(proposed, wrong).alias("effective"))


@query(with_("SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, CAST(person AS INTEGER) AS person, 'P' || row_number() OVER (PARTITION BY movie_id, shot_id, sample ORDER BY x + w / 2, y + h / 2, confidence DESC, person) AS label FROM bx", "bx"))
def b01_person_numbers(spark: SparkSession, d: str) -> DataFrame:
    return geo.number_persons(fx.boxes(spark, d)).select("movie_id", "shot_id", "sample", "person", "label")


@query(with_("SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, CAST(person AS INTEGER) AS person, round((x + w / 2) / 1920 + 1e-7, 4) AS cx, CASE WHEN (x + w / 2) / 1920 < 0.4 THEN 'left' WHEN (x + w / 2) / 1920 > 0.6 THEN 'right' ELSE 'center' END AS \"where\" FROM bx", "bx"))
def b02_position(spark: SparkSession, d: str) -> DataFrame:
    return geo.position(fx.boxes(spark, d), 1920.0).select("movie_id", "shot_id", "sample", "person", _r("cx"), "where")


# the boxes of a frame as one list, whose pairs are unnested: no join of the table with itself
@query(with_("SELECT", "bx").removesuffix("\nSELECT") + """,
fr AS (SELECT movie_id, shot_id, sample, list(struct_pack(p := person, x := x, y := y, w := w, h := h) ORDER BY person) AS bs FROM bx GROUP BY movie_id, shot_id, sample HAVING count(*) > 1),
pa AS (SELECT movie_id, shot_id, sample, unnest(flatten(list_transform(bs, lambda a: list_transform(list_filter(bs, lambda b: b.p > a.p), lambda b: struct_pack(a := a, b := b))))) AS q FROM fr),
ov AS (SELECT movie_id, shot_id, sample, q.a.p AS pa, q.b.p AS pb, greatest(0, least(q.a.x + q.a.w, q.b.x + q.b.w) - greatest(q.a.x, q.b.x)) * greatest(0, least(q.a.y + q.a.h, q.b.y + q.b.h) - greatest(q.a.y, q.b.y)) AS i, q.a.w * q.a.h + q.b.w * q.b.h AS u FROM pa)
SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, CAST(pa AS INTEGER) AS person_a, CAST(pb AS INTEGER) AS person_b, round(i / (u - i) + 1e-7, 4) AS iou FROM ov WHERE i / (u - i) >= 0.2""")
def b04_box_overlap(spark: SparkSession, d: str) -> DataFrame:
    return geo.overlapping_pairs(fx.boxes(spark, d), 0.2).select("movie_id", "shot_id", "sample", "person_a", "person_b", _r("iou"))


@query(with_("""SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, round(least(lo, 1320) + 1e-7, 4) AS low, round(greatest(hi, 0) + 1e-7, 4) AS high, lo > hi OR x - m < 0 OR x + w + m > 1920 AS limited FROM (SELECT *, greatest(0, x + w + m - 600) AS lo, least(1320, x - m) AS hi FROM (SELECT *, greatest(w * 0.12::DOUBLE, 8) AS m FROM bx))""", "bx"))
def b12_crop_interval(spark: SparkSession, d: str) -> DataFrame:
    b = fx.boxes(spark, d)
    x = b.withColumn("i", geo.crop_interval(F.col("x"), F.col("w"), geo.required_margin(F.col("w")), 600.0, 1920.0))
    return x.select("movie_id", "shot_id", "sample", F.round(F.col("i.low") + 1e-7, 4).alias("low"), F.round(F.col("i.high") + 1e-7, 4).alias("high"), F.col("i.limited").alias("limited"))


@query(with_("SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, 600::BIGINT AS crop, CAST(floor(greatest(0, least(1320, x + w / 2 - 300)) + 0.5::DOUBLE) AS BIGINT) AS crop_x FROM bx", "bx"))
def b20_crop_position(spark: SparkSession, d: str) -> DataFrame:
    b = fx.boxes(spark, d)
    crop = geo.crop_width(F.lit(800), F.lit(1920))
    return b.select("movie_id", "shot_id", "sample", crop.cast("bigint").alias("crop"), geo.crop_start(F.col("x") + F.col("w") / 2, crop, F.lit(1920)).cast("bigint").alias("crop_x"))


@query(with_("SELECT movie_id, shot_id, state, reasons FROM (SELECT movie_id, shot_id, ['PASS', 'SOURCE_LIMIT', 'AMBIGUOUS', 'REPAIR', 'ERROR'][max(s) + 1] AS state, list_sort(list_distinct(list('code_' || s) FILTER (s > 0))) AS r FROM (SELECT movie_id, shot_id, CASE WHEN k = 3 THEN 4 ELSE (event_id + sample * k) % 4 END AS s FROM bx) GROUP BY ALL) t, (SELECT 1) WHERE true".replace("state, reasons FROM", "state, coalesce(r, []::VARCHAR[]) AS reasons FROM"), "bx"))
def a17_worst_severity(spark: SparkSession, d: str) -> DataFrame:
    b = fx.boxes(spark, d)
    s = F.when(F.col("k") == 3, 4).otherwise((F.col("event_id") + F.col("sample") * F.col("k")) % 4)
    x = b.select("movie_id", "shot_id", fx.pick(geo.SEVERITY, s).alias("state"), F.when(s > 0, F.array(F.concat(F.lit("code_"), s.cast("string")))).otherwise(F.array().cast("array<string>")).alias("reasons"))
    return geo.worst(x, ["movie_id", "shot_id"])


@query(with_("SELECT movie_id, shot_id, CAST(person AS INTEGER) AS person, t, CAST(arg_min(sample, (abs(t - st), sample)) AS INTEGER) AS sample, round(arg_min(x, (abs(t - st), sample)) + 1e-7, 4) AS x FROM (SELECT movie_id, shot_id, person, sample, x, sample * 1.0::DOUBLE AS st, event_id % 9 / 2 AS t FROM bx) GROUP BY ALL", "bx"))
def j08_nearest_sample(spark: SparkSession, d: str) -> DataFrame:
    b = fx.boxes(spark, d).withColumn("st", F.col("sample").cast("double"))
    points = b.select("movie_id", "shot_id", "person", (F.col("event_id") % 9 / 2).alias("t")).distinct()
    x = iv.nearest(points, b.select("movie_id", "shot_id", "person", "sample", "st", "x"), ["movie_id", "shot_id", "person"], "t", "st", ["sample"])
    return x.select("movie_id", "shot_id", "person", "t", "sample", _r("x"))


@query(with_("""SELECT movie_id, shot_id, CAST(person AS INTEGER) AS person, round(t, 4) AS t, round(x0 + (coalesce(x1, x0) - x0) * (t - s) + 1e-7, 4) AS x FROM (SELECT movie_id, shot_id, person, sample, event_id % 9 / 2 AS t, floor(event_id % 9 / 2) AS s, x AS x0, lead(x) OVER (PARTITION BY movie_id, shot_id, person ORDER BY sample) AS x1 FROM bx) WHERE sample = s""", "bx"))
def b10_anchor_interpolation(spark: SparkSession, d: str) -> DataFrame:
    b = fx.boxes(spark, d).select("movie_id", "shot_id", "person", "event_id", F.col("sample").cast("double").alias("t"), "x")
    points = b.select("movie_id", "shot_id", "person", (F.col("event_id") % 9 / 2).alias("t")).distinct()
    return iv.value_at(points, b, ["movie_id", "shot_id", "person"]).select("movie_id", "shot_id", "person", _r("t"), _r("x"))


@query(with_("SELECT", "bx").removesuffix("\nSELECT") + """, a AS MATERIALIZED (SELECT movie_id, shot_id, person, sample, k, x + k * sample * 7 % 90 AS p, greatest(0, x - 200) AS lo, x + 100 AS hi, 600 + 200 * (k % 2) AS crop FROM bx),
g AS (SELECT movie_id, shot_id, person, any_value(k) AS k, any_value(crop) AS crop, max(greatest(lo, least(hi, p))) - min(greatest(lo, least(hi, p))) AS spread, max(lo) AS cl, min(hi) AS ch, median(greatest(lo, least(hi, p))) AS med FROM a GROUP BY ALL),
m AS MATERIALIZED (SELECT *, spread < crop * 0.06::DOUBLE AND cl <= ch AS still FROM g),
f AS (SELECT movie_id, shot_id, person, sample, greatest(lo, least(hi, p)) AS x, lo, hi FROM a WHERE sample = 0
 UNION ALL SELECT a.movie_id, a.shot_id, a.person, a.sample, greatest(a.lo, least(a.hi, greatest(f.x - crop * 0.08::DOUBLE, least(f.x + crop * 0.08::DOUBLE, CASE WHEN abs(greatest(a.lo, least(a.hi, p)) - f.x) < crop * 0.06::DOUBLE THEN f.x ELSE greatest(a.lo, least(a.hi, p)) END)))), a.lo, a.hi
 FROM f JOIN a ON a.movie_id = f.movie_id AND a.shot_id = f.shot_id AND a.person = f.person AND a.sample = f.sample + 1),
fm AS (SELECT f.*, k FROM f JOIN m ON m.movie_id = f.movie_id AND m.shot_id = f.shot_id AND m.person = f.person AND NOT still)
SELECT movie_id, shot_id, CAST(person AS INTEGER) AS person, t, round(x + 1e-7, 4) AS x FROM (SELECT movie_id, shot_id, person, CASE WHEN k % 2 = 0 THEN -0.5 ELSE 0 END AS t, greatest(cl, least(ch, med)) AS x FROM m WHERE still
 UNION ALL SELECT movie_id, shot_id, person, sample, x FROM fm UNION ALL SELECT movie_id, shot_id, person, -0.5, x FROM fm WHERE sample = 0 AND k % 2 = 0 UNION ALL SELECT movie_id, shot_id, person, 5, greatest(lo, least(hi, x)) FROM fm WHERE sample = 4 AND k % 3 = 0)""")
def b09_smoothed_anchors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    b = fx.boxes(spark, d).select(
        "movie_id", "shot_id", "person", F.col("sample").alias("t"), (F.col("x") + k * F.col("sample") * 7 % 90).alias("x"), F.greatest(F.lit(0.0), F.col("x") - 200).alias("low"), (F.col("x") + 100).alias("high"),
        (600 + 200 * (k % 2)).alias("crop"), F.when(k % 2 == 0, -0.5).alias("start"), F.when(k % 3 == 0, 5.0).alias("end"),
    )
    return geo.smooth_anchors(b, ["movie_id", "shot_id", "person"]).select("movie_id", "shot_id", "person", "t", _r("x"))


@query(with_("""SELECT movie_id, shot_id, CAST(person AS INTEGER) AS person, count(*) AS samples, round(avg(CASE WHEN x >= l AND x + w <= l + 600 THEN 1 ELSE 0 END) + 1e-7, 4) AS visible, round(median(abs(cx - 0.5::DOUBLE)) + 1e-7, 4) AS center, round(avg(w / 600) + 1e-7, 4) AS occupancy, count(*) FILTER (abs(cx - lag) > 0.15) AS jumps
FROM (SELECT *, lag(cx) OVER (PARTITION BY movie_id, shot_id, person ORDER BY sample) AS lag FROM (SELECT *, (x + w / 2 - l) / 600 AS cx FROM (SELECT *, event_id % 7 * 200 AS l FROM bx))) GROUP BY movie_id, shot_id, person""", "bx"))
def a18_editorial_geometry(spark: SparkSession, d: str) -> DataFrame:
    crop = fx.shots(spark, d).select("movie_id", "shot_id", (F.col("event_id") % 7 * 200).alias("left"), F.lit(600).alias("width"))
    x = geo.editorial_geometry(fx.boxes(spark, d), crop, ("movie_id", "shot_id", "person"))
    return x.select("movie_id", "shot_id", "person", "samples", _r("visible"), _r("center"), _r("occupancy"), "jumps")


@query(with_("SELECT", "sh").removesuffix("\nSELECT") + """, c AS MATERIALIZED (SELECT movie_id, event_id, start_s, setting_id, list_distinct(['door', ['open', 'shut'][k % 2 + 1], ['red', 'blue', 'green'][event_id % 3 + 1]]) AS tk, row_number() OVER (PARTITION BY movie_id ORDER BY value DESC, start_s, event_id) AS o FROM sh),
m AS MATERIALIZED (SELECT a.movie_id, a.o, b.o AS p FROM c a JOIN c b ON a.movie_id = b.movie_id AND b.o < a.o AND a.setting_id IS NOT DISTINCT FROM b.setting_id AND abs(a.start_s - b.start_s) <= 12 WHERE len(list_intersect(a.tk, b.tk)) / len(list_distinct(list_concat(a.tk, b.tk))) >= 0.55),
n AS (SELECT movie_id, max(o) AS n FROM c GROUP BY movie_id),
f(movie_id, o, kept) AS (SELECT movie_id, 0::BIGINT, []::BIGINT[] FROM n UNION ALL SELECT f.movie_id, f.o + 1, CASE WHEN EXISTS (SELECT 1 FROM m WHERE m.movie_id = f.movie_id AND m.o = f.o + 1 AND list_contains(f.kept, m.p)) THEN f.kept ELSE list_append(f.kept, f.o + 1) END FROM f JOIN n ON n.movie_id = f.movie_id AND f.o < n.n)
SELECT c.movie_id, event_id, list_contains(k, o) AS kept FROM c JOIN (SELECT f.movie_id, kept AS k FROM f JOIN n ON n.movie_id = f.movie_id AND f.o = n.n) q USING (movie_id)""")
def g14_scarcity(spark: SparkSession, d: str) -> DataFrame:
    words = F.array(F.lit("door"), fx.pick(("open", "shut"), F.col("k") % 2), fx.pick(("red", "blue", "green"), F.col("event_id") % 3))
    x = fx.shots(spark, d).select("movie_id", "event_id", "start_s", F.col("setting_id").alias("setting"), words.alias("tokens"), F.col("value").alias("priority"))
    return po.scarce(x)
