"""Answers of a model about a chunk of cues, made into segment maps, and the contract of such maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.functions.columns import errors
from cutlight.operators.narrative import boundary_reason

# The vocabulary of segment maps.
BOUNDARY_REASONS = (
    "chunk_start", "chunk_end", "continues_prior_situation", "conflict_start", "conflict_end", "interaction_change", "participant_change", "phase_change", "subject_change", "context_change", "new_action",
    "arrival", "departure", "call", "time_jump", "revelation", "unknown", "phone_call_arrival_departure",
)
ENUMS = {
    "segment_type": ("conversation", "monologue", "narration", "sparse_dialogue", "transition", "unknown"),
    "narrative_tone": ("neutral", "serious", "tense", "sad", "warm", "affectionate", "angry", "anxious", "humorous", "hopeful", "fearful", "reflective", "celebratory", "mixed", "unclear"),
    "narrative_function": ("exposition", "conversation", "conflict", "decision", "revelation", "setup", "transition", "resolution", "emotional_exchange", "everyday_interaction", "unknown"),
    "context_dependency": ("low", "medium", "high"),
}
DENSITIES = ("none", "low", "medium", "high")
CONTINUITY = ("same_interaction", "likely_same_interaction", "new_interaction", "outside_chunk", "unknown")
LONG_REASONS = ("long_continuous_conversation", "continuous_action", "continuous_therapy_exchange")
OPPORTUNITIES = ("conversation", "listening", "reaction", "pause", "gesture", "movement", "object_interaction", "physical_interaction", "establishing", "transition", "unknown")
#: Free texts of a segment; in some answers their names end in _es.
TEXTS = ("situation", "participants", "interaction_action", "location_context", "continuity_rationale")
LONGEST, TOLERANCE = 120.0, 1e-6
_ASSERTION = "struct<value: string, source: string, confidence: double>"


def _kind(v: Column) -> Column:
    """What a variant holds: OBJECT, ARRAY, STRING, ... ; null where there is nothing."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def _get(v: Column, *names: str) -> Column:
    """The first of these fields that an object has, even if it is null there."""
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", "variant") for n in names])


def _assertion(v: Column, source: str) -> Column:
    """struct(value, source, confidence): an object as it stands, a bare value wrapped once. A confidence that is no number is null."""
    wrapped = _kind(v) == "OBJECT"
    number = _kind(_get(v, "confidence")).isin("BIGINT", "DOUBLE", "DECIMAL")
    text = lambda x: F.when(~F.is_variant_null(x), F.try_variant_get(x, "$", "string"))
    given = F.struct(text(_get(v, "value")).alias("value"), F.try_variant_get(v, "$.source", "string").alias("source"), F.when(number, F.try_variant_get(v, "$.confidence", "double")).alias("confidence"))
    bare = F.struct(text(v).alias("value"), F.lit(source).alias("source"), F.lit(0.5).alias("confidence"))
    return F.when(v.isNotNull(), F.when(wrapped, given.cast(_ASSERTION)).otherwise(bare.cast(_ASSERTION)))


def assertion_errors(a: Column, label: str, allowed: tuple[str, ...] | None, source: Column | str) -> list[tuple[Column, str]]:
    """Rules for errors(): what is wrong with struct(value, source, confidence)."""
    source = F.lit(source) if isinstance(source, str) else source
    bad_value = ~F.coalesce(a["value"].isin(*allowed), F.lit(False)) if allowed else F.lit(False)
    confident = F.coalesce(a["confidence"].between(0.0, 1.0) & ~F.isnan(a["confidence"]), F.lit(False))
    here = a.isNotNull()
    return [(~here, f"{label}:missing"), (here & bad_value, f"{label}:value"), (here & ~a["source"].eqNullSafe(source), f"{label}:source"), (here & ~confident, f"{label}:confidence")]


def normalise_answers(answers: DataFrame, cues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, rejected): answers (movie_id, chunk, raw) about chunks of cues (movie_id, chunk, pos, cue_id, start_s, end_s).

    An answer may name its fields in either way, and give values bare or as objects with source and confidence. All that is taken from it
    about place is which cues a segment begins and ends with: ids, times, cues and density come from the chunk. An answer with anything wrong is rejected
    whole, for its first fault (rejected: movie_id, chunk, segment (null: the answer itself), code).
    segments: movie_id, chunk, segment, segment_id, start_s, end_s, cue_ids, density, the fields of ENUMS and TEXTS as struct(value,
    source, confidence), continuity_previous, continuity_next, transition_reason_start, boundary_reason_end, long_segment_reason,
    opportunities (array of such structs).
    """
    keys = ["movie_id", "chunk"]
    x = answers.select(*keys, F.try_parse_json("raw").alias("root"))
    parts = F.try_variant_get("root", "$.segments", "array<variant>")
    x = x.withColumns({"kind": _kind(F.col("root")), "listed": _kind(_get(F.col("root"), "segments")), "parts": parts, "summary": _get(F.col("root"), "chunk_summary", "chunk_summary_es")})
    known = cues.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cue_id").alias("ids"))
    x = x.join(known, keys, "left")
    summary = _assertion(F.col("summary"), "srt_llm")
    no_summary = F.col("summary").isNull() | F.is_variant_null("summary")
    whole = errors(
        (~F.coalesce(F.col("kind") == "OBJECT", F.lit(False)), "answer:no_object"), ((F.coalesce("listed", F.lit("")) != "ARRAY") | (F.coalesce(F.size("parts"), F.lit(0)) <= 0), "answer:no_segments"), (F.col("n").isNull(), "chunk:no_cues"),
        (F.col("n") != F.col("ids"), "chunk:repeated_cue_id"), (no_summary, "chunk_summary:missing"), *assertion_errors(summary, "chunk_summary", None, "srt_llm")[1:],
    )
    x = x.withColumn("wrong", whole)
    rejected = x.where(F.size("wrong") > 0).select(*keys, F.lit(None).cast("int").alias("segment"), F.get("wrong", F.lit(0)).alias("code"))
    s = x.where(F.size("wrong") == 0).select(*keys, F.posexplode("parts").alias("at", "v")).withColumn("segment", F.col("at") + 1).drop("at")
    text = lambda *n: F.when(_kind(_get(F.col("v"), *n)) == "STRING", F.try_variant_get(_get(F.col("v"), *n), "$", "string"))
    s = s.withColumns({"first": text("first_cue_id"), "last": text("last_cue_id")})
    for end in ("first", "last"):
        s = s.join(cues.select(*keys, F.col("cue_id").alias(end), F.col("pos").alias(f"{end}_pos"), F.col("start_s").alias(f"{end}_start"), F.col("end_s").alias(f"{end}_end")), [*keys, end], "left")
    nested = _kind(_get(F.col("v"), "continuity")) == "OBJECT"
    for side in ("previous", "next"):
        s = s.withColumn(f"continuity_{side}", F.when(nested, F.try_variant_get("v", f"$.continuity.{side}", "string")).otherwise(text(f"continuity_{side}")))
    reason = lambda n: boundary_reason(text(n), list(BOUNDARY_REASONS)).alias(n)
    long_ = _get(F.col("v"), "long_segment_reason")
    shown = _get(F.col("v"), "possible_visual_opportunities")
    s = s.select("*", reason("transition_reason_start"), reason("boundary_reason_end"), F.when(~F.is_variant_null(long_), F.try_variant_get(long_, "$", "string")).alias("long_segment_reason"), shown.alias("shown"))
    given = F.transform(F.try_variant_get("shown", "$", "array<variant>"), lambda o: _assertion(o, "srt_llm_hint"))
    s = s.withColumns({"opportunities": given} | {f: _assertion(_get(F.col("v"), f), "srt_llm") for f in ENUMS} | {f: _assertion(_get(F.col("v"), f, f"{f}_es"), "srt_llm") for f in TEXTS})
    by = Window.partitionBy(*keys).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    c, in_ = F.col, lambda col, values: F.coalesce(F.col(col).isin(*values), F.lit(False))
    a_list = F.coalesce(_kind(c("shown")) == "ARRAY", F.lit(False))
    bad_hint = F.exists("opportunities", lambda o: ~F.coalesce(o["value"].isin(*OPPORTUNITIES) & (o["source"] == "srt_llm_hint") & o["confidence"].between(0.0, 1.0), F.lit(False)))
    rules = [
        (_kind(c("v")) != "OBJECT", "segment:no_object"), (c("first_pos").isNull(), "first_cue_id:unknown"), (c("last_pos").isNull(), "last_cue_id:unknown"), (c("first_pos") > c("last_pos"), "range:reversed"),
        (c("first_pos") <= F.max("last_pos").over(by), "range:overlaps"), (c("transition_reason_start").isNull() | c("boundary_reason_end").isNull(), "boundary_reason:unsupported"),
        (~(in_("continuity_previous", CONTINUITY) & in_("continuity_next", CONTINUITY)), "continuity:value"), (c("long_segment_reason").isNotNull() & ~in_("long_segment_reason", LONG_REASONS), "long_segment_reason:value"),
        ((c("last_end") - c("first_start") > LONGEST) & c("long_segment_reason").isNull(), "long_segment_reason:required"), (c("shown").isNull(), "opportunities:missing"), (~a_list, "opportunities:no_array"), (bad_hint, "opportunities:value"),
    ]
    for f in ("situation", "segment_type", *TEXTS[1:], "narrative_tone", "narrative_function", "context_dependency"):
        rules += assertion_errors(c(f), f, ENUMS.get(f), "srt_llm")
    s = s.withColumn("wrong", errors(*rules))
    first = F.min(F.when(F.size("wrong") > 0, F.struct("segment", F.get("wrong", F.lit(0)).alias("code")))).alias("w")
    bad = s.groupBy(*keys).agg(first).where("w is not null").select(*keys, "w.segment", "w.code")
    good = s.join(bad.select(*keys), keys, "left_anti")
    met = good.select(*keys, "segment", F.explode(F.sequence("first_pos", "last_pos")).alias("pos")).join(cues, [*keys, "pos"])
    covered = F.sum(F.greatest(F.lit(0.0), F.col("end_s") - F.col("start_s")))
    per = met.groupBy(*keys, "segment").agg(F.sort_array(F.collect_list(F.struct("pos", "cue_id"))).alias("ids"), covered.alias("covered"))
    out = good.join(per, [*keys, "segment"])
    part = c("covered") / F.greatest(c("last_end") - c("first_start"), F.lit(0.001))
    segments = out.select(
        *keys, "segment", F.format_string("NARR_%04d_%03d", "chunk", "segment").alias("segment_id"), c("first_start").alias("start_s"), c("last_end").alias("end_s"), F.transform("ids", lambda i: i["cue_id"]).alias("cue_ids"),
        F.when(part < 0.10, "low").when(part < 0.35, "medium").otherwise("high").alias("density"), *ENUMS, *TEXTS, "continuity_previous", "continuity_next", "transition_reason_start", "boundary_reason_end", "long_segment_reason", "opportunities",
    )
    return segments, rejected.unionByName(bad)


def map_errors(segments: DataFrame, cues: DataFrame) -> DataFrame:
    """movie_id, chunk, segment, errors: what breaks the contract of segment maps, in the order of the rules.

    segments: as normalise_answers() gives them, density as struct(value, source, confidence), and boundary_confidence (array of doubles, or null); segment is
    the place in its map, from 1. cues: movie_id, chunk, pos, cue_id, start_s, end_s. Times must equal those of the first and last cue to within
    TOLERANCE; cue ids must be all from the first to the last, each in its place; ranges must not go back behind any range before.
    """
    keys, c = ["movie_id", "chunk"], F.col
    ids = segments.select(*keys, "segment", F.posexplode("cue_ids").alias("i", "cue_id"))
    met = ids.join(cues.select(*keys, "cue_id", "pos", c("start_s").alias("cue_start"), c("end_s").alias("cue_end")), [*keys, "cue_id"], "left")
    back = F.last("pos", ignorenulls=True).over(Window.partitionBy(*keys, "segment").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("back", c("pos") <= back)
    last = F.max_by(F.struct("pos", "cue_end"), "i")
    per = met.groupBy(*keys, "segment").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c("pos").isNull()).alias("unknown"), F.count_if("back").alias("back"), F.min_by(F.struct("pos", "cue_start"), "i").alias("a"), last.alias("b"),
        F.count_distinct(c("pos") - c("i")).alias("shifts"),
    )
    x = segments.join(per, [*keys, "segment"], "left")
    both = c("a.pos").isNotNull() & c("b.pos").isNotNull()
    inclusive = (c("unknown") == 0) & (c("shifts") == 1) & (c("n") == c("b.pos") - c("a.pos") + 1)
    before = Window.partitionBy(*keys).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(both, c("b.pos"))).over(before)
    again = F.row_number().over(Window.partitionBy(*keys, "segment_id").orderBy("segment")) > 1
    off = lambda mine, cue: c(cue).isNotNull() & ~F.coalesce((F.abs(c(mine) - c(cue)) <= TOLERANCE) & ~F.isnan(mine), F.lit(False))
    x = x.withColumns({"reach": reach, "again": again})
    in_ = lambda col, values: F.coalesce(F.col(col).isin(*values), F.lit(False))
    rules = [
        (c("again"), "segment_id:repeated"), (~c("segment_id").eqNullSafe(F.format_string("NARR_%04d_%03d", "chunk", "segment")), "segment_id:unexpected"), (F.coalesce(F.size("cue_ids"), F.lit(0)) <= 0, "cue_ids:empty"),
        (c("unknown") > 0, "cue_ids:unknown"), (c("back") > 0, "cue_ids:order"), (both & ~inclusive, "cue_ids:not_inclusive"), (both & (c("a.pos") <= c("reach")), "range:overlaps"), (off("start_s", "a.cue_start"), "start_s:not_its_cue"), (off("end_s", "b.cue_end"), "end_s:not_its_cue"),
    ]
    for f in ("segment_type", "narrative_tone", "narrative_function", "context_dependency", *TEXTS):
        rules += assertion_errors(c(f), f, ENUMS.get(f), "srt_llm")
    source = F.when(c("density.source").isin("srt_llm", "derived_timeline"), c("density.source")).otherwise("derived_timeline")
    rules += assertion_errors(c("density"), "density", DENSITIES, source)
    rules += [(~in_(f"continuity_{side}", CONTINUITY), f"continuity_{side}:value") for side in ("previous", "next")]
    rules += [(~in_(f, BOUNDARY_REASONS), f"{f}:value") for f in ("transition_reason_start", "boundary_reason_end")]
    long_ = in_("long_segment_reason", LONG_REASONS)
    hint = lambda o: F.coalesce(o["value"].isin(*OPPORTUNITIES) & (o["source"] == "srt_llm_hint") & o["confidence"].between(0.0, 1.0), F.lit(False))
    rules += [
        (c("long_segment_reason").isNotNull() & ~long_, "long_segment_reason:value"), ((c("b.cue_end") - c("a.cue_start") > LONGEST) & ~long_, "long_segment_reason:required"), (c("opportunities").isNull(), "opportunities:no_array"),
        (F.exists("opportunities", lambda o: ~hint(o)), "opportunities:value"), (F.exists("boundary_confidence", lambda v: ~F.coalesce(v.between(0.0, 1.0), F.lit(False))), "boundary:confidence"),
    ]
    return x.select(*keys, "segment", errors(*rules).alias("errors"))
