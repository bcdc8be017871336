"""Queries over answers about chunks and the maps made of them. A chunk is twenty cues; an answer parts it into segments of five."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import maps as mp
from cutlight.registry import query

SHOWN = ("conversation", "reaction", "movement", "unknown")
TONES = ("neutral", "tense", "warm", "mixed")


def _cues(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("cue_ord") - 1
    return fx.cues(spark, d).select("movie_id", F.floor(n / 20).alias("chunk"), (n % 20).alias("pos"), "cue_id", "start_s", "end_s")


def _parts(spark: SparkSession, d: str) -> DataFrame:
    """movie_id, chunk, segment, f (the chunk's fault), shape, first and last cue id, n (number of the segment in the title)."""
    c = _cues(spark, d).withColumn("segment", F.floor(F.col("pos") / 5) + 1)
    g = c.groupBy("movie_id", "chunk", "segment").agg(F.min("cue_id").alias("first"), F.max("cue_id").alias("last"), F.min("start_s").alias("a"), F.max("end_s").alias("b"))
    return g.withColumns({"f": (F.col("movie_id") * 7 + F.col("chunk")) % 26, "shape": (F.col("movie_id") + F.col("chunk")) % 3, "n": F.col("chunk") * 4 + F.col("segment")})


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """The answers as JSON in three shapes, many with one fault."""
    f, shape, seg = F.col("f"), F.col("shape"), F.col("segment")
    chunk = Window.partitionBy("movie_id", "chunk")
    at = lambda k, n=1: (f == k) & (seg == n)

    def said(name: str, value, es: bool = False, confidence=None, source="srt_llm"):
        key = F.when((shape == 2) & F.lit(es), f"{name}_es").otherwise(name)
        whole = F.concat(F.lit('{"value":"'), value, F.lit('","source":"'), source if not isinstance(source, str) else F.lit(source), F.lit('","confidence":'), confidence if confidence is not None else F.lit("0.8"), F.lit("}"))
        return F.concat(F.lit('"'), key, F.lit('":'), F.when(shape == 1, whole).otherwise(F.concat(F.lit('"'), value, F.lit('"'))))

    hint = fx.pick(SHOWN, F.col("n") % 4)
    hint = F.when(at(10), F.lit("dancing")).otherwise(hint)
    hints = F.when(shape == 1, F.concat(F.lit('[{"value":"'), hint, F.lit('","source":"srt_llm_hint","confidence":0.4}]'))).otherwise(F.concat(F.lit('["'), hint, F.lit('"]')))
    first = F.when(at(1, 2), "SRT_999999").when(at(3), F.col("last")).when(at(4, 2), F.lag("last").over(chunk.orderBy("segment"))).otherwise(F.col("first"))
    last = F.when(at(2), "nobody").when(at(3), F.col("first")).when(f == 20, F.max("last").over(chunk)).otherwise(F.col("last"))
    continuity = F.when(at(6), "later").otherwise(F.when(seg % 2 == 0, "new_interaction").otherwise("unknown"))
    text = lambda s: F.lit(s)
    fields = [
        F.concat(F.lit('"first_cue_id":"'), first, F.lit('"')), F.concat(F.lit('"last_cue_id":"'), last, F.lit('"')),
        F.concat(F.lit('"transition_reason_start":"'), F.when(at(5), "boredom").when(seg % 2 == 0, "conflict_begins").otherwise("call"), F.lit('"')), F.lit('"boundary_reason_end":"revelation"'),
        F.when(shape == 0, F.concat(F.lit('"continuity":{"previous":"unknown","next":"'), continuity, F.lit('"}'))).otherwise(F.concat(F.lit('"continuity_previous":"unknown","continuity_next":"'), continuity, F.lit('"'))),
        F.when(at(7), F.lit('"long_segment_reason":"because"')).when(f != 20, F.lit('"long_segment_reason":"continuous_action"')),
        F.when(at(9), F.lit('"possible_visual_opportunities":"reaction"')).when(~at(8), F.concat(F.lit('"possible_visual_opportunities":'), hints)),
        F.when(~at(11), said("situation", text("they talk"), True)), said("participants", text("two"), True), said("interaction_action", text("talk"), True), said("location_context", text("home"), True), said("continuity_rationale", text("same room"), True),
        said("segment_type", text("conversation"), confidence=F.when(at(12), "1.5").otherwise("0.9"), source=F.when(at(13), "guess").otherwise("srt_llm")), said("narrative_tone", F.when(at(14), "loud").otherwise(fx.pick(TONES, F.col("n") % 4))),
        said("narrative_function", text("conflict")), said("context_dependency", text("low")),
    ]
    one = F.when(at(19, 2), F.lit('"a segment"')).otherwise(F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*fields)), ","), F.lit("}")))
    p = _parts(spark, d).withColumn("json", one).where("f <> 20 or segment = 1")
    g = p.groupBy("movie_id", "chunk", "f", "shape").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", "json"))), lambda x: x["json"]), ",").alias("all"))
    f = F.col("f")
    body = F.when(f == 15, F.lit('"segments":[]')).when(f == 16, F.lit('"segments":"none"')).otherwise(F.concat(F.lit('"segments":['), F.col("all"), F.lit("]")))
    summary = F.when(f == 17, F.lit('"note":1')).when(F.col("shape") == 2, F.lit('"chunk_summary_es":"resumen"')).otherwise(F.lit('"chunk_summary":"summary"'))
    raw = F.when(f == 18, F.lit("I cannot do that")).otherwise(F.concat(F.lit("{"), summary, F.lit(","), body, F.lit("}")))
    return g.select("movie_id", "chunk", raw.alias("raw"))


_PARTS = with_("SELECT", "cu").removesuffix("\nSELECT") + """,
pc AS (SELECT movie_id, (cue_ord - 1) // 20 AS chunk, (cue_ord - 1) % 20 AS pos, cue_id, start_s, end_s FROM cu),
pf AS MATERIALIZED (SELECT movie_id, chunk, (movie_id * 7 + chunk) % 26 AS f, (movie_id + chunk) % 3 AS shape, max(end_s) - min(start_s) AS whole, count(*) AS n FROM pc GROUP BY movie_id, chunk),
pg AS (SELECT movie_id, chunk, CASE WHEN f = 20 THEN 1 ELSE pos // 5 + 1 END AS segment, f, shape, min(cue_id) AS first, min(start_s) AS a, max(end_s) AS b, list(cue_id ORDER BY pos) AS ids, sum(end_s - start_s) AS covered FROM pc JOIN pf USING (movie_id, chunk) GROUP BY ALL),
pj AS (SELECT *, max(segment) OVER (PARTITION BY movie_id, chunk) AS segs FROM pg),
rj AS MATERIALIZED (SELECT movie_id, chunk, segment, CASE f WHEN 15 THEN 'answer:no_segments' WHEN 16 THEN 'answer:no_segments' WHEN 17 THEN 'chunk_summary:missing' WHEN 18 THEN 'answer:no_object' WHEN 1 THEN 'first_cue_id:unknown' WHEN 2 THEN 'last_cue_id:unknown' WHEN 3 THEN 'range:reversed' WHEN 4 THEN 'range:overlaps'
  WHEN 5 THEN 'boundary_reason:unsupported' WHEN 6 THEN 'continuity:value' WHEN 7 THEN 'long_segment_reason:value' WHEN 8 THEN 'opportunities:missing' WHEN 9 THEN 'opportunities:no_array' WHEN 10 THEN 'opportunities:value' WHEN 11 THEN 'situation:missing' WHEN 12 THEN 'segment_type:confidence' WHEN 13 THEN 'segment_type:source'
  WHEN 14 THEN 'narrative_tone:value' WHEN 19 THEN 'segment:no_object' WHEN 20 THEN 'long_segment_reason:required' END AS code, f FROM pj
  WHERE (f BETWEEN 15 AND 18 AND segment = 1) OR (f IN (1, 4, 19) AND segment = 2) OR (f IN (2, 5, 6, 7, 8, 9, 10, 11, 14) AND segment = 1) OR (f = 3 AND segment = 1 AND len(ids) > 1) OR (f IN (12, 13) AND shape = 1 AND segment = 1) OR (f = 20 AND b - a > 120))
"""


@query(_PARTS + """SELECT p.movie_id, p.chunk, CAST(p.segment AS INTEGER) AS segment, printf('NARR_%04d_%03d', p.chunk, p.segment) AS segment_id, round(a, 4) AS start_s, round(b, 4) AS end_s, ids AS cue_ids, CASE WHEN covered / greatest(b - a, 0.001) < 0.10 THEN 'low' WHEN covered / greatest(b - a, 0.001) < 0.35 THEN 'medium' ELSE 'high' END AS density,
 ['neutral', 'tense', 'warm', 'mixed'][(p.chunk * 4 + p.segment) % 4 + 1] AS tone, CASE WHEN shape = 1 THEN 0.8 ELSE 0.5 END::DOUBLE AS tone_confidence, CASE WHEN p.segment % 2 = 0 THEN 'conflict_start' ELSE 'call' END AS reason, CASE WHEN p.segment % 2 = 0 THEN 'new_interaction' ELSE 'unknown' END AS continuity_next,
 CASE WHEN p.f <> 20 THEN 'continuous_action' END AS long_reason, ['conversation', 'reaction', 'movement', 'unknown'][(p.chunk * 4 + p.segment) % 4 + 1] AS hint, CASE WHEN shape = 1 THEN 0.4 ELSE 0.5 END::DOUBLE AS hint_confidence
FROM pj p WHERE NOT EXISTS (SELECT 1 FROM rj r WHERE r.movie_id = p.movie_id AND r.chunk = p.chunk)""")
def v27_normalised_answers(spark: SparkSession, d: str) -> DataFrame:
    x, _ = mp.normalise_answers(_answers(spark, d), _cues(spark, d))
    return x.select(
        "movie_id", "chunk", "segment", "segment_id", F.round("start_s", 4).alias("start_s"), F.round("end_s", 4).alias("end_s"), "cue_ids", "density", F.col("narrative_tone.value").alias("tone"), F.col("narrative_tone.confidence").alias("tone_confidence"),
        F.col("transition_reason_start").alias("reason"), "continuity_next", F.col("long_segment_reason").alias("long_reason"), F.get("opportunities", F.lit(0))["value"].alias("hint"), F.get("opportunities", F.lit(0))["confidence"].alias("hint_confidence"),
    )


@query(_PARTS + "SELECT movie_id, chunk, CAST(CASE WHEN f NOT BETWEEN 15 AND 18 THEN segment END AS INTEGER) AS segment, code FROM rj")
def v27_rejected_answers(spark: SparkSession, d: str) -> DataFrame:
    _, bad = mp.normalise_answers(_answers(spark, d), _cues(spark, d))
    return bad


def _maps(spark: SparkSession, d: str) -> DataFrame:
    """Segment maps with one fault in most segments."""
    c = _cues(spark, d).withColumn("segment", F.floor(F.col("pos") / 5) + 1)
    g = c.groupBy("movie_id", "chunk", "segment").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "cue_id"))), lambda x: x["cue_id"]).alias("ids"), F.min("start_s").alias("a"), F.max("end_s").alias("b"))
    chunk = Window.partitionBy("movie_id", "chunk")
    before = F.lag("ids").over(chunk.orderBy("segment"))
    rest = F.flatten(F.collect_list("ids").over(chunk.orderBy("segment").rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    g = g.withColumns({"k": (F.col("movie_id") * 11 + F.col("chunk") * 4 + F.col("segment")) % 27, "before": before, "rest": rest, "end": F.max("b").over(chunk)})
    k, none = F.col("k"), F.array().cast("array<string>")
    ids = F.when(k == 2, none).when(k == 3, F.concat("ids", F.array(F.lit("nobody")))).when(k == 4, F.reverse("ids")).when(k == 5, F.filter("ids", lambda x, i: i != 2)).when((k == 6) & F.col("before").isNotNull(), F.concat(F.array(F.element_at("before", -1)), F.col("ids"))).when(k == 25, F.col("rest")).otherwise(F.col("ids"))
    name = F.format_string("NARR_%04d_%03d", "chunk", F.when(k == 0, F.col("segment") - 1).otherwise(F.col("segment")))

    def said(value, source="srt_llm", confidence=0.5):
        lit = lambda v: v if not isinstance(v, (str, float)) else F.lit(v)
        return F.struct(lit(value).alias("value"), lit(source).alias("source"), lit(confidence).cast("double").alias("confidence"))

    hints = F.array(said(F.when(k == 21, "dancing").otherwise("reaction"), F.when(k == 22, "srt_llm").otherwise("srt_llm_hint"), 0.4))
    return g.select(
        "movie_id", "chunk", "segment", F.when(k == 1, "X").otherwise(name).alias("segment_id"), ids.alias("cue_ids"), (F.col("a") + F.when(k == 7, 1e-5).when(k == 8, 1e-7).otherwise(0.0)).alias("start_s"),
        F.when(k == 9, F.lit(float("nan"))).when(k == 25, F.col("end")).otherwise(F.col("b")).alias("end_s"), said(F.when(k == 10, "chatter").otherwise("conversation"), F.when(k == 11, "guess").otherwise("srt_llm"), F.when(k == 12, 1.5).otherwise(0.5)).alias("segment_type"),
        said("tense").alias("narrative_tone"), said("conflict").alias("narrative_function"), said("low").alias("context_dependency"), F.when(k != 13, said("they talk")).alias("situation"), said("two").alias("participants"), said("talk").alias("interaction_action"), said("home").alias("location_context"),
        said("same room", confidence=F.when(k == 26, F.lit(None).cast("double")).otherwise(F.lit(1.0))).alias("continuity_rationale"), said(F.when(k == 14, "thick").otherwise("high"), F.when(k == 15, "srt_llm").when(k == 16, "other").otherwise("derived_timeline"), 1.0).alias("density"),
        F.when(k != 17, "unknown").alias("continuity_previous"), F.lit("new_interaction").alias("continuity_next"), F.when(k == 18, "boredom").otherwise("call").alias("transition_reason_start"), F.lit("revelation").alias("boundary_reason_end"), F.when(k == 19, "because").alias("long_segment_reason"),
        F.when(k != 20, hints).alias("opportunities"), F.when(k == 23, F.array(F.lit(0.5), F.lit(2.0))).when(k == 24, F.array(F.lit(0.1), F.lit(0.9))).alias("boundary_confidence"),
    )


@query(with_("SELECT", "cu").removesuffix("\nSELECT") + """,
pc AS MATERIALIZED (SELECT movie_id, (cue_ord - 1) // 20 AS chunk, (cue_ord - 1) % 20 AS pos, (cue_ord - 1) % 20 // 5 + 1 AS segment, cue_id, start_s, end_s FROM cu),
ma AS (SELECT movie_id, chunk, segment, list(cue_id ORDER BY pos) AS ids, min(start_s) AS a, max(end_s) AS b, (movie_id * 11 + chunk * 4 + segment) % 27 AS k FROM pc GROUP BY movie_id, chunk, segment),
mb AS (SELECT *, lag(ids) OVER (PARTITION BY movie_id, chunk ORDER BY segment) AS bef, (SELECT list(cue_id ORDER BY pos) FROM pc WHERE pc.movie_id = ma.movie_id AND pc.chunk = ma.chunk AND pc.segment >= ma.segment) AS rest, max(b) OVER (PARTITION BY movie_id, chunk) AS whole FROM ma),
mc AS MATERIALIZED (SELECT movie_id, chunk, segment, k, CASE WHEN k = 1 THEN 'X' ELSE printf('NARR_%04d_%03d', chunk, CASE WHEN k = 0 THEN segment - 1 ELSE segment END) END AS sid, a + CASE WHEN k = 7 THEN 1e-5 WHEN k = 8 THEN 1e-7 ELSE 0 END AS st, CASE WHEN k = 9 THEN 'nan'::DOUBLE WHEN k = 25 THEN whole ELSE b END AS en,
  CASE WHEN k = 2 THEN [] WHEN k = 3 THEN list_append(ids, 'nobody') WHEN k = 4 THEN list_reverse(ids) WHEN k = 5 THEN list_filter(ids, lambda x, i: i <> 3) WHEN k = 6 AND bef IS NOT NULL THEN list_prepend(bef[-1], ids) WHEN k = 25 THEN rest ELSE ids END AS ids FROM mb),
md AS (SELECT m.movie_id, m.chunk, m.segment, i, p.pos, p.start_s, p.end_s FROM (SELECT *, unnest(ids) AS cid, generate_subscripts(ids, 1) AS i FROM mc) m LEFT JOIN pc p ON p.movie_id = m.movie_id AND p.chunk = m.chunk AND p.cue_id = m.cid),
me AS (SELECT movie_id, chunk, segment, count(*) AS n, count(*) FILTER (pos IS NULL) AS unknown, count(*) FILTER (pos <= prior) AS back, list(pos ORDER BY i) AS ps, list(start_s ORDER BY i)[1] AS fs, list(end_s ORDER BY i)[-1] AS le, count(DISTINCT pos - i) AS shifts
  FROM (SELECT *, last_value(pos IGNORE NULLS) OVER (PARTITION BY movie_id, chunk, segment ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM md) GROUP BY movie_id, chunk, segment),
mf AS (SELECT mc.*, me.* EXCLUDE (movie_id, chunk, segment), ps[1] AS p0, ps[-1] AS p1, row_number() OVER (PARTITION BY mc.movie_id, mc.chunk, sid ORDER BY mc.segment) > 1 AS again FROM mc LEFT JOIN me ON me.movie_id = mc.movie_id AND me.chunk = mc.chunk AND me.segment = mc.segment),
mg AS (SELECT *, max(CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL THEN p1 END) OVER (PARTITION BY movie_id, chunk ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM mf)
SELECT movie_id, chunk, segment, list_filter([CASE WHEN again THEN 'segment_id:repeated' END, CASE WHEN sid <> printf('NARR_%04d_%03d', chunk, segment) THEN 'segment_id:unexpected' END, CASE WHEN len(ids) = 0 THEN 'cue_ids:empty' END, CASE WHEN unknown > 0 THEN 'cue_ids:unknown' END, CASE WHEN back > 0 THEN 'cue_ids:order' END,
 CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL AND NOT (unknown = 0 AND shifts = 1 AND n = p1 - p0 + 1) THEN 'cue_ids:not_inclusive' END, CASE WHEN p0 <= reach AND p1 IS NOT NULL THEN 'range:overlaps' END, CASE WHEN fs IS NOT NULL AND NOT abs(st - fs) <= 1e-6 THEN 'start_s:not_its_cue' END, CASE WHEN le IS NOT NULL AND (isnan(en) OR NOT abs(en - le) <= 1e-6) THEN 'end_s:not_its_cue' END,
 CASE k WHEN 10 THEN 'segment_type:value' WHEN 11 THEN 'segment_type:source' WHEN 12 THEN 'segment_type:confidence' WHEN 13 THEN 'situation:missing' WHEN 26 THEN 'continuity_rationale:confidence' WHEN 14 THEN 'density:value' WHEN 16 THEN 'density:source' WHEN 17 THEN 'continuity_previous:value' WHEN 18 THEN 'transition_reason_start:value' WHEN 19 THEN 'long_segment_reason:value' END,
 CASE WHEN le - fs > 120 THEN 'long_segment_reason:required' END, CASE k WHEN 20 THEN 'opportunities:no_array' WHEN 21 THEN 'opportunities:value' WHEN 22 THEN 'opportunities:value' WHEN 23 THEN 'boundary:confidence' END], lambda x: x IS NOT NULL) AS errors FROM mg""")
def v05_map_contract(spark: SparkSession, d: str) -> DataFrame:
    return mp.map_errors(_maps(spark, d), _cues(spark, d))
