"""Answers in several shapes become segment maps, and what breaks their contract."""

import json

from cutlight.operators import maps as mp

CUES = [(1, 0, i, f"C{i}", float(i * 10), i * 10 + 4.0) for i in range(20)]
CUE = "movie_id bigint, chunk bigint, pos bigint, cue_id string, start_s double, end_s double"


def segment(first, last, **more):
    given = {
        "first_cue_id": first, "last_cue_id": last, "transition_reason_start": "call", "boundary_reason_end": "conflict_resolves", "continuity_previous": "unknown", "continuity_next": "unknown", "segment_type": "monologue",
        "narrative_tone": "sad", "narrative_function": "setup", "context_dependency": "high", "situation": "s", "participants": "p", "interaction_action": "i", "location_context": "l", "continuity_rationale": "c", "possible_visual_opportunities": ["pause"],
    } | more
    return {k: v for k, v in given.items() if v is not ...}


def run(spark, *answers):
    rows = [(1, 0, a if isinstance(a, str) or a is None else json.dumps(a)) for a in answers]
    cues = spark.createDataFrame(CUES, CUE)
    out = []
    for row in rows:
        good, bad = mp.normalise_answers(spark.createDataFrame([row], "movie_id bigint, chunk bigint, raw string"), cues)
        out.append((good.orderBy("segment").collect(), [(b.segment, b.code) for b in bad.collect()]))
    return out


def test_three_shapes_give_one_map(spark):
    object_ = lambda v, s="srt_llm": {"value": v, "source": s, "confidence": 1}
    texts = ("situation", "participants", "interaction_action", "location_context", "continuity_rationale")
    plain = segment("C0", "C4")
    nested = {k: object_(v) if k in (*texts, *mp.ENUMS) else v for k, v in plain.items()} | {"possible_visual_opportunities": [object_("pause", "srt_llm_hint")], "continuity": {"previous": "unknown", "next": "unknown"}, "continuity_next": "ignored"}
    spanish = {f"{k}_es" if k in texts else k: v for k, v in plain.items()} | {"unasked": [1, {"a": None}]}
    (a, no), (b, _), (c, _) = run(spark, {"chunk_summary": "x", "segments": [plain]}, {"chunk_summary": object_("x"), "segments": [nested]}, {"chunk_summary_es": "x", "segments": [spanish]})
    assert not no and len(a) == len(b) == len(c) == 1
    assert a[0] == c[0]
    assert (a[0].segment_id, a[0].start_s, a[0].end_s, a[0].cue_ids, a[0].density, a[0].boundary_reason_end) == ("NARR_0000_001", 0.0, 44.0, ["C0", "C1", "C2", "C3", "C4"], "high", "conflict_end")
    assert (a[0].situation.value, a[0].situation.confidence, b[0].situation.confidence, b[0].opportunities[0].source) == ("s", 0.5, 1.0, "srt_llm_hint")


def test_the_first_fault_rejects_an_answer(spark):
    ok, whole = segment("C0", "C4"), lambda *s: {"chunk_summary": "x", "segments": list(s)}
    faults = [
        (None, (None, "answer:no_object")), ("[1]", (None, "answer:no_object")), ("{", (None, "answer:no_object")), ({"segments": []}, (None, "answer:no_segments")), ({"segments": [ok]}, (None, "chunk_summary:missing")),
        ({"chunk_summary": {"value": "x", "source": "srt_llm", "confidence": "high"}, "segments": [ok]}, (None, "chunk_summary:confidence")), (whole(ok, 7), (2, "segment:no_object")), (whole(segment(5, "C4")), (1, "first_cue_id:unknown")),
        (whole(ok, segment("C4", "C6"), segment("C1", "zz")), (2, "range:overlaps")), (whole(segment("C0", "C15")), (1, "long_segment_reason:required")), (whole(segment("C0", "C4", narrative_tone=None)), (1, "narrative_tone:value")),
        (whole(segment("C0", "C4", participants=...)), (1, "participants:missing")), (whole(segment("C0", "C4", possible_visual_opportunities=[{"value": "pause", "source": "srt_llm", "confidence": 1}])), (1, "opportunities:value")),
    ]
    for (good, bad), (_, want) in zip(run(spark, *[f for f, _ in faults]), faults, strict=True):
        assert (good, bad) == ([], [want])
    ((good, bad),) = run(spark, whole(segment("C0", "C15", long_segment_reason="continuous_action", situation=None)))
    assert not bad and len(good[0].cue_ids) == 16 and good[0].situation.value is None


def test_a_normalised_map_keeps_its_contract(spark):
    from pyspark.sql import functions as F

    cues = spark.createDataFrame(CUES, CUE)
    raw = json.dumps({"chunk_summary": "x", "segments": [segment("C0", "C4"), segment("C5", "C9")]})
    good, _ = mp.normalise_answers(spark.createDataFrame([(1, 0, raw)], "movie_id bigint, chunk bigint, raw string"), cues)
    good = good.withColumn("density", F.struct(F.col("density").alias("value"), F.lit("derived_timeline").alias("source"), F.lit(1.0).alias("confidence"))).withColumn("boundary_confidence", F.lit(None).cast("array<double>"))
    assert [r.errors for r in mp.map_errors(good, cues).collect()] == [[], []]
    moved = good.withColumn("start_s", F.col("start_s") + 2e-6).withColumn("cue_ids", F.array(F.lit("C5"), F.lit("C4"), F.lit("C6")))
    got = {r.segment: r.errors for r in mp.map_errors(moved, cues).collect()}
    assert got[1] == ["cue_ids:order", "cue_ids:not_inclusive", "start_s:not_its_cue", "end_s:not_its_cue"]
    assert got[2] == ["cue_ids:order", "cue_ids:not_inclusive", "range:overlaps", "start_s:not_its_cue", "end_s:not_its_cue"]
