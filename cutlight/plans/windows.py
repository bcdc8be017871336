"""Queries over the windows of a title that are looked at, and over control events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import windows as wi
from cutlight.registry import query
from cutlight.session import cut, shared_dir

SUMMARIES = (
    "Two people talk at night", "A mother and daughter argue", "Una madre e hijo y su padre e hija", "The opening logo of the house", "Two siblings meet a romantic partner",
    "Créditos", "Los novios esperan", "A stranger comes to town", "The father and son leave",
)
OPPORTUNITIES = ("reaction", "gesture", "unknown", "movement", "establishing")


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _n():
    return F.floor((F.col("first_ord") - 1) / 5)


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """The segment maps with what a model says about each: summary, opportunities; some types, tones and functions unknown."""
    n = _n()
    unsure = lambda c, k, word: F.when(n % k == 2, F.lit(word)).otherwise(F.col(c)).alias(c)
    return fx.segments(spark, d).select(
        "movie_id", "segment_id", "first_ord", "start_s", "end_s", unsure("segment_type", 7, "unknown"), unsure("narrative_tone", 5, "unclear"), unsure("narrative_function", 6, "unknown"),
        fx.pick(SUMMARIES, (n * 5 + F.col("movie_id")) % len(SUMMARIES)).alias("summary"), F.array(fx.pick(OPPORTUNITIES, n % 5), fx.pick(OPPORTUNITIES, (n * 3 + 1) % 5)).alias("opportunities"),
    )


def _durations(segments: DataFrame) -> DataFrame:
    return segments.groupBy("movie_id").agg(F.max("end_s").alias("duration_s"))


def _registry(segments: DataFrame) -> DataFrame:
    """Windows looked at before: every sixth segment of most titles, with odd numbers; one title in seven has a selected one."""
    n, m = _n(), F.col("movie_id")
    kind = F.when((n % 12 == 3) & (m % 5 != 0), "TESTED").when((n % 12 == 9) & (m % 5 != 0), "LEGACY").when((n == 5) & (m % 7 == 3), "SELECTED")
    x = segments.withColumn("status", kind).where("status is not null")
    no = F.row_number().over(Window.partitionBy("movie_id").orderBy("first_ord")) * 2 - 1
    x = x.select("movie_id", F.format_string("SW_%02d", no).alias("window_id"), "start_s", (F.col("start_s") + 50).alias("end_s"), "status")
    x = x.join(wi.profiles(x, segments, ["window_id"]), ["movie_id", "window_id"])
    none = {"pilot_status": F.lit(None).cast("string"), "diversity_score": F.lit(None).cast("double"), "selection_reason": F.lit(None).cast("array<string>")}
    return x.withColumns(none)


_SX = f""",
sx AS MATERIALIZED (SELECT movie_id, segment_id, first_ord, (first_ord - 1) // 5 AS n, start_s, end_s, CASE WHEN (first_ord - 1) // 5 % 7 = 2 THEN 'unknown' ELSE segment_type END AS segment_type, CASE WHEN (first_ord - 1) // 5 % 5 = 2 THEN 'unclear' ELSE narrative_tone END AS narrative_tone,
  CASE WHEN (first_ord - 1) // 5 % 6 = 2 THEN 'unknown' ELSE narrative_function END AS narrative_function, lower({_list(SUMMARIES)}[((first_ord - 1) // 5 * 5 + movie_id) % {len(SUMMARIES)} + 1]) AS summary,
  [{_list(OPPORTUNITIES)}[(first_ord - 1) // 5 % 5 + 1], {_list(OPPORTUNITIES)}[((first_ord - 1) // 5 * 3 + 1) % 5 + 1]] AS opps FROM sg),
du AS MATERIALIZED (SELECT movie_id, max(end_s) AS dur FROM sx GROUP BY movie_id),
sr AS (SELECT *, list_filter([{", ".join("CASE WHEN " + " OR ".join(f"contains(summary, '{p}')" for p in ps) + f" THEN '{name}' END" for name, ps in wi.RELATIONS.items())}], lambda x: x IS NOT NULL) AS rel,
  list_filter(list_concat([CASE WHEN segment_type <> 'unknown' THEN segment_type END], opps), lambda x: x IS NOT NULL AND x <> 'unknown') AS hints FROM sx),
"""


def _profile(name: str, ranges: str) -> str:
    """SQL: name, the rows of ranges (movie_id, key, start_s, end_s) with their profiles."""
    sets = lambda c: f"list_sort(list_distinct(coalesce({c}, [])))"
    return f"""{name} AS MATERIALIZED (SELECT r.movie_id, r.key, list(segment_id ORDER BY s.start_s, segment_id) AS ids, {sets("list(narrative_function) FILTER (narrative_function <> 'unknown')")} AS ctx,
  {sets("list(narrative_tone) FILTER (narrative_tone <> 'unclear')")} AS tone, {sets("flatten(list(hints))")} AS hints, {sets("flatten(list(rel))")} AS rel
  FROM {ranges} r JOIN sr s ON s.movie_id = r.movie_id AND r.start_s < s.end_s AND s.start_s < r.end_s GROUP BY r.movie_id, r.key)"""


_REG = f"""rg0 AS MATERIALIZED (SELECT movie_id, printf('SW_%02d', row_number() OVER (PARTITION BY movie_id ORDER BY first_ord) * 2 - 1) AS key, start_s, start_s + 50 AS end_s, status FROM (SELECT *, CASE WHEN n % 12 = 3 AND movie_id % 5 <> 0 THEN 'TESTED' WHEN n % 12 = 9 AND movie_id % 5 <> 0 THEN 'LEGACY' WHEN n = 5 AND movie_id % 7 = 3 THEN 'SELECTED' END AS status FROM sx) WHERE status IS NOT NULL),
{_profile("rp0", "rg0")},
"""
_CAND = f"""ca0 AS (SELECT sx.movie_id, segment_id AS key, start_s AS l, end_s AS r, dur, summary, least(75, greatest(45, least(60, dur))) AS len FROM sx JOIN du USING (movie_id)),
ca1 AS (SELECT *, CASE WHEN r - l >= len THEN greatest(l, least((l + r) / 2 - len / 2, r - len)) ELSE greatest(0, least((l + r) / 2 - len / 2, greatest(0, dur - len))) END AS a FROM ca0),
ca2 AS (SELECT * EXCLUDE (a), greatest(0, least(dur, a + len) - len) AS a, least(dur, a + len) AS b FROM ca1),
ca AS MATERIALIZED (SELECT movie_id, key, dur, least(1, greatest(0, least(b, r) - greatest(a, l)) / greatest(b - a, 0.001)) AS coh, floor(a * 1000 + 0.5::DOUBLE) / 1000 AS start_s, floor(b * 1000 + 0.5::DOUBLE) / 1000 AS end_s FROM ca2
  WHERE floor(a * 1000 + 0.5::DOUBLE) / 1000 >= 30 AND floor(b * 1000 + 0.5::DOUBLE) / 1000 <= dur - 30 AND NOT ({" OR ".join(f"contains(summary, '{p}')" for p in wi.NO_STORY)})),
{_profile("cp", "ca")},
"""


def _choose(tag: str, registry: str, profiles: str) -> str:
    """SQL: nw_<tag>, the next windows for the registry (movie_id, key, start_s, end_s, status) with these profiles."""
    d = lambda c: f"CASE WHEN len(c.{c}) = 0 THEN 0 ELSE min(1 - len(list_intersect(c.{c}, p.{c})) / len(list_distinct(list_concat(c.{c}, p.{c})))) END"
    return f"""old_{tag} AS MATERIALIZED (SELECT * FROM {registry} JOIN {profiles} USING (movie_id, key) WHERE status IN ('TESTED', 'LEGACY')),
fr_{tag} AS MATERIALIZED (SELECT c.*, p.ids, p.ctx, p.tone, p.hints, p.rel FROM ca c JOIN cp p USING (movie_id, key) WHERE NOT EXISTS (SELECT 1 FROM {registry} g WHERE g.movie_id = c.movie_id AND status = 'SELECTED')
  AND NOT EXISTS (SELECT 1 FROM old_{tag} o WHERE o.movie_id = c.movie_id AND o.start_s < c.end_s AND c.start_s < o.end_s)),
ds_{tag} AS (SELECT c.movie_id, c.key, any_value(c.coh) AS coh, any_value(c.start_s) AS start_s, any_value(c.end_s) AS end_s, any_value(c.rel) AS rel, c.ids, c.ctx, c.tone, c.hints, count(p.key) AS n, {d("ids")} AS d_ids, {d("ctx")} AS d_ctx, {d("tone")} AS d_tone, {d("hints")} AS d_hints,
  least(1, min(abs((c.start_s + c.end_s) / 2 - (p.start_s + p.end_s) / 2) / greatest(c.dur * 0.25::DOUBLE, 1))) AS d_time FROM fr_{tag} c LEFT JOIN old_{tag} p ON p.movie_id = c.movie_id GROUP BY c.movie_id, c.key, c.ids, c.ctx, c.tone, c.hints),
sc_{tag} AS (SELECT *, floor((CASE WHEN n = 0 THEN 0.45::DOUBLE + 0.25::DOUBLE * coh ELSE 0.1::DOUBLE * d_time + 0.1::DOUBLE * coh + 0.28::DOUBLE * d_ids + 0.22::DOUBLE * d_ctx + 0.16::DOUBLE * d_tone + 0.14::DOUBLE * d_hints END) * 10000 + 0.5::DOUBLE) / 10000 AS score FROM ds_{tag}),
nw_{tag} AS MATERIALIZED (SELECT b.*, (SELECT min(u.i) FROM range(1, 100) u(i) WHERE NOT EXISTS (SELECT 1 FROM {registry} g WHERE g.movie_id = b.movie_id AND g.key = printf('SW_%02d', u.i))) AS no,
  CASE WHEN n = 0 THEN ['coherent_narrative_context'] ELSE list_filter(['different_narrative_segment', CASE WHEN d_ctx >= 0.5 THEN 'different_interaction_context' END, CASE WHEN d_tone >= 0.5 THEN 'different_tone' END, CASE WHEN d_time >= 0.5 THEN 'different_movie_region' END, CASE WHEN coh >= 0.75 THEN 'coherent_narrative_context' END], lambda x: x IS NOT NULL) END AS why
  FROM (SELECT * FROM sc_{tag} QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY score DESC, coh DESC, start_s, key DESC) = 1) b)"""


_HEAD = with_("SELECT", "sg").removesuffix("\nSELECT")


@query(_HEAD + _SX + _profile("sp", "(SELECT movie_id, segment_id AS key, start_s - 20 AS start_s, end_s + 20 AS end_s FROM sx)") + " SELECT movie_id, key AS segment_id, ids AS narrative_segment_ids, ctx AS interaction_context, tone, hints AS content_hints, rel AS relationship_hints FROM sp")
def a21_window_profile(spark: SparkSession, d: str) -> DataFrame:
    s = _segments(spark, d)
    return wi.profiles(s.select("movie_id", "segment_id", (F.col("start_s") - 20).alias("start_s"), (F.col("end_s") + 20).alias("end_s")), s, ["segment_id"])


@query(_HEAD + _SX + _REG + _CAND + _choose("a", "rg0", "rp0") + " SELECT movie_id, printf('SW_%02d', no) AS window_id, round(start_s, 3) AS start_s, round(end_s, 3) AS end_s, round(score, 4) AS diversity_score, why AS selection_reason, ids AS narrative_segment_ids, rel AS relationship_hints FROM nw_a")
def w11_next_window(spark: SparkSession, d: str) -> DataFrame:
    s = _segments(spark, d)
    x = wi.next_windows(s, _registry(s), _durations(s))
    return x.select("movie_id", "window_id", F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"), F.round("diversity_score", 4).alias("diversity_score"), "selection_reason", "narrative_segment_ids", "relationship_hints")


@query(
    _HEAD + _SX + _REG + _CAND + _choose("a", "rg0", "rp0") + """,
rg1 AS MATERIALIZED (SELECT movie_id, key, start_s, end_s, CASE WHEN movie_id % 3 = 0 AND status = 'SELECTED' THEN 'TESTED' ELSE status END AS status, CASE WHEN movie_id % 3 = 0 AND status = 'SELECTED' THEN 'COMPLETE' END AS pilot FROM (SELECT movie_id, key, start_s, end_s, status FROM rg0 UNION ALL SELECT movie_id, printf('SW_%02d', no), start_s, end_s, 'SELECTED' FROM nw_a)),
rp1 AS MATERIALIZED (SELECT * FROM rp0 UNION ALL SELECT movie_id, printf('SW_%02d', no), ids, ctx, tone, hints, rel FROM nw_a),
""" + _choose("b", "rg1", "rp1") + """
SELECT movie_id, key AS window_id, round(start_s, 3) AS start_s, round(end_s, 3) AS end_s, status, pilot AS pilot_status FROM rg1 UNION ALL SELECT movie_id, printf('SW_%02d', no), round(start_s, 3), round(end_s, 3), 'SELECTED', NULL FROM nw_b"""
)
def w18_window_registry(spark: SparkSession, d: str) -> DataFrame:
    """Select, select again, try the windows of one title in three, and select once more, all from disk."""
    s = cut(_segments(spark, d), "segments")  # each of the five steps below reads them several times
    registry = wi.WindowRegistry(spark, f"{shared_dir(spark)}/registry-{uuid.uuid4().hex}")
    registry.publish(_registry(s))
    registry.select(s, _durations(s))
    again = registry.select(s, _durations(s))
    registry.mark(again.where("movie_id % 3 = 0").select("movie_id", "window_id", F.lit("COMPLETE").alias("attempt")))
    registry.select(s, _durations(s))
    return registry.read().select("movie_id", "window_id", F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"), "status", "pilot_status")


ACTIONS = ("camina por la casa", "looking at a mirror", "apoya su cabeza", "touching a copa", "nothing at all", "lleva comida", "escucha", "un hombro y un cajón", "walking and looking", "GESTICULANDO")
# The controls of the second calibration.
CONTROLS = (
    ("ordinary_action", 2, "medical_examination"), ("ordinary_action", 21, "writing"), ("ordinary_action", 31, "object_activity_makeup"), ("ordinary_action", 41, "carrying_food"), ("ordinary_action", 51, "phone_use"),
    ("ordinary_action", 62, "steering_wheel"), ("ordinary_action", 67, "looking_at_bus"), ("ordinary_action", 72, "walking"), ("ordinary_action", 121, "resting_state"), ("ordinary_action", 122, "drawer_search"),
    *(("generic_dialogue_or_presence", n, "generic_dialogue_control") for n in (13, 54, 58, 81, 87, 91, 101, 106, 127, 141)),
    ("borderline_reaction_interaction", 32, "expressive_conversation"), ("borderline_reaction_interaction", 35, "physical_support"), ("borderline_reaction_interaction", 37, "listening_reaction"),
    ("borderline_reaction_interaction", 113, "off_camera_conversation"), ("borderline_reaction_interaction", 145, "close_dialogue"), ("hard_negative", 1, "black_or_text"), ("hard_negative", 23, "title_card"),
    ("hard_negative", 155, "credits"), ("hard_negative", 166, "logo"), ("hard_negative", 170, "credits_and_logo"),
)


def _events(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    return fx.shots(spark, d).select("movie_id", "event_id", F.when(k != 50, F.col("shot_ord")).alias("ordinal"), F.when(k % 4 != 3, "KEEP").otherwise("REJECT").alias("decision"), fx.pick(ACTIONS, (k * 3 + F.col("event_id")) % len(ACTIONS)).alias("text"))


_RULES = ",\n ".join(f"({i}, 'positive_control:{name}', [{', '.join(repr(t) for t in terms)}])" for i, (name, terms) in enumerate(wi.CONTROL_RULES))


@query(with_("SELECT", "sh").removesuffix("\nSELECT") + f""",
kp AS MATERIALIZED (SELECT movie_id, event_id, CASE WHEN k <> 50 THEN shot_ord ELSE 0 END AS ordinal, lower({_list(ACTIONS)}[(k * 3 + event_id) % {len(ACTIONS)} + 1]) AS text FROM sh WHERE k % 4 <> 3),
ru(rule, category, terms) AS (VALUES {_RULES}),
ht AS MATERIALIZED (SELECT movie_id, event_id, ordinal, rule FROM kp, ru WHERE len(list_filter(terms, lambda t: contains(text, t))) > 0),
fo(movie_id, rule, taken, kinds) AS (SELECT DISTINCT movie_id, 0, []::BIGINT[], []::INTEGER[] FROM kp
 UNION ALL SELECT movie_id, rule + 1, CASE WHEN nxt IS NULL THEN taken ELSE list_append(taken, nxt) END, CASE WHEN nxt IS NULL THEN kinds ELSE list_append(kinds, rule) END
 FROM (SELECT f.movie_id, f.rule, f.taken, f.kinds, arg_min(h.event_id, (h.ordinal, h.event_id)) FILTER (NOT list_contains(f.taken, h.event_id)) AS nxt FROM fo f LEFT JOIN ht h ON h.movie_id = f.movie_id AND h.rule = f.rule WHERE f.rule < 6 GROUP BY f.movie_id, f.rule, f.taken, f.kinds)),
en AS MATERIALIZED (SELECT movie_id, taken, kinds FROM fo WHERE rule = 6),
fi AS (SELECT k.movie_id, k.event_id, row_number() OVER (PARTITION BY k.movie_id ORDER BY ordinal, k.event_id) AS o, 6 - len(taken) AS room, len(taken) AS had FROM kp k JOIN en ON en.movie_id = k.movie_id WHERE NOT list_contains(taken, k.event_id)),
al AS (SELECT movie_id, p AS place, taken[p] AS event_id, ['positive_control:movement', 'positive_control:object_activity', 'positive_control:interaction', 'positive_control:reaction', 'positive_control:emotional_state', 'positive_control:action'][kinds[p] + 1] AS category FROM en, unnest(range(1, 7)) t(p) WHERE p <= len(taken)
 UNION ALL SELECT movie_id, had + o, event_id, 'positive_control:canonical_keep' FROM fi WHERE o <= room)
SELECT movie_id, CAST(place AS INTEGER) AS place, event_id, category, count(*) OVER (PARTITION BY movie_id) = 6 AS enough FROM al""")
def w16_positive_controls(spark: SparkSession, d: str) -> DataFrame:
    return wi.positive_controls(_events(spark, d))


@query(with_("SELECT", "sh").removesuffix("\nSELECT") + f""", rq(category, ordinal, label) AS (VALUES {", ".join(map(str, CONTROLS))})
SELECT t.movie_id, category, CAST(rq.ordinal AS BIGINT) AS ordinal, label, event_id FROM (SELECT DISTINCT movie_id FROM sh) t CROSS JOIN rq LEFT JOIN sh ON sh.movie_id = t.movie_id AND sh.shot_ord = rq.ordinal AND k <> 50""")
def w16_requested_controls(spark: SparkSession, d: str) -> DataFrame:
    return wi.requested_controls(_events(spark, d), list(CONTROLS), "ordinal")
