"""Moments that can be used again: their contracts, the policy over them, and what earlier records are worth under it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutlight.functions.columns import errors, let, let_all
from cutlight.operators.review import asset_windows

# Classes of visual utility, older names of some of them, and hard exclusions in the order they are reported.
UTILITY_CLASSES = (
    "conversation_scene", "therapy_or_session", "discussion_or_argument", "meditation_or_stillness", "reaction", "sustained_emotional_state", "physical_interaction",
    "nonverbal_interaction", "walking_or_movement", "concrete_action", "object_interaction", "useful_state", "environment_or_composition", "establishing_visual",
)
ALIASES = {"clear_reaction": "reaction", "movement": "walking_or_movement", "object_activity": "object_interaction", "environment": "environment_or_composition", "strong_nonverbal_interaction": "nonverbal_interaction"}

_TEXTS = "array<string>"


def _none() -> Column:
    return F.array().cast(_TEXTS)


def moment_errors(start: Column, end: Column, event_start: Column, event_end: Column, kind: Column, complete: Column, begin: Column, middle: Column, finish: Column, ids: Column, continuity: Column, samples: Column, shots: Column) -> Column:
    """Codes of what is wrong with a moment of an event.

    samples: array of struct(sample_id, frame, shot_id), what the event was looked at; shots: array of struct(shot_id,
    start_frame, end_frame), both bounded by an event's sample plan. Unknown or repeated citations hide all later rules.
    """
    return let_all({"start": start, "end": end, "kind": kind, "complete": complete, "begin": begin, "middle": middle, "finish": finish, "ids": ids, "samples": samples, "shots": shots}, lambda **g: _moment_errors(event_start, event_end, continuity, **g))


def _moment_errors(event_start: Column, event_end: Column, continuity: Column, start: Column, end: Column, kind: Column, complete: Column, begin: Column, middle: Column, finish: Column, ids: Column, samples: Column, shots: Column) -> Column:
    known = F.transform(samples, lambda s: s["sample_id"])
    bad_ids = (F.size(F.array_distinct(ids)) < F.size(ids)) | (F.size(F.array_except(ids, known)) > 0)
    frame_of = lambda i: F.get(F.transform(F.filter(samples, lambda s: s["sample_id"] == i), lambda s: s["frame"]), 0)
    inside = F.filter(shots, lambda s: (s["start_frame"] < end) & (s["end_frame"] > start))
    inside = F.transform(inside, lambda s: s["shot_id"])
    action = kind == "complete_action"
    ordered = (frame_of(begin) == start) & (frame_of(finish) == end - 1) & F.forall(middle, lambda m: let(frame_of(m), lambda f: (f > start) & (f < end - 1)))
    parts = (complete == "true") & F.array_contains(ids, begin) & F.array_contains(ids, finish) & (F.size(middle) > 0) & (F.size(F.array_except(middle, ids)) == 0)
    outside = errors((~((event_start <= start) & (start < end) & (end <= event_end)), "moment_outside_event"))

    def rest(rows: Column, frames: Column, inside: Column, parts: Column) -> Column:
        return errors(
            ((F.size(F.array_distinct(frames)) < 2) | F.exists(frames, lambda f: (f < start) | (f >= end)), "insufficient_local_temporal_support"),
            ((F.size(rows) > 0) & ((F.array_min(frames) > start) | (F.array_max(frames) < end - 1)), "moment_bounds_without_visual_support"),
            (action & ~F.coalesce(parts, F.lit(False)), "local_action_requires_begin_development_completion"), (action & parts & ~ordered, "local_action_temporal_order"),
            ((kind == "sustained_state") & (complete == "true"), "sustained_state_cannot_claim_action_completion"),
            (F.size(F.array_except(inside, F.transform(rows, lambda s: s["shot_id"]))) > 0, "missing_moment_shot_support"), ((F.size(inside) > 1) & (continuity != "supported"), "multishot_continuity_unproven"),
        )

    cited = F.filter(samples, lambda s: F.array_contains(ids, s["sample_id"]))
    judged = let(cited, lambda rows: let_all({"frames": F.transform(rows, lambda s: s["frame"]), "inside": inside, "parts": parts}, lambda **v: rest(rows, **v)))
    return F.concat(outside, F.when(bad_ids, F.array(F.lit("invalid_moment_sample_ids"))).otherwise(judged))


def temporal_errors(same_event: Column, shots: Column, expected_shots: Column, support: Column, status: Column, complete: Column, utility: Column, states: Column, first: Column, last: Column, samples: Column, directives: Column, local: bool = False) -> Column:
    """Codes of what is wrong with an observation over time.

    samples: array of struct(sample_id, frame, role); first, last: the event's end frames; directives: the shots that have a
    focus directive. local: complete actions are judged by their moments, so the rule on the event's ends falls away.
    """
    known = F.transform(samples, lambda s: s["sample_id"])
    rows = F.filter(samples, lambda s: F.array_contains(support, s["sample_id"]))
    frames, roles = F.array_distinct(F.transform(rows, lambda s: s["frame"])), F.transform(rows, lambda s: s["role"])
    unknown = F.size(F.array_except(support, known)) > 0
    supported = (F.size(F.array_distinct(support)) == F.size(support)) & ~unknown & (F.size(frames) >= 2)
    has = lambda r: F.array_contains(roles, r)
    whole = (complete == "true") & (F.size(frames) >= 3) & has("begin") & has("end") & (has("middle") | has("development")) & (F.array_min(frames) == first) & (F.array_max(frames) == last)
    same_set = lambda a, b: (F.size(a) == F.size(b)) & (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    return errors(
        (~same_event, "event_id"), (~same_set(shots, expected_shots), "represented_shot_ids"), (unknown, "unknown_temporal_sample_id"), ((status != "unclear") & ~supported, "insufficient_temporal_support"),
        ((status == "complete_action") & ~F.coalesce(whole, F.lit(False)) & F.lit(not local), "complete_action_requires_begin_development_end"),
        ((status == "incomplete_action") & (complete != "false"), "incomplete_action_completeness"),
        ((status == "reusable_state") & (complete == "true"), "reusable_state_raw_action_completeness_must_be_false_or_unclear"),
        ((status == "reusable_state") & (utility != "useful_state"), "reusable_state_requires_useful_state_utility"),
        ((status == "reusable_state") & ~F.exists(states, lambda s: F.trim(s) != ""), "reusable_state_requires_visible_state"),
        ((status == "unclear") & (complete == "true"), "unclear_moment_cannot_claim_complete_action"), (~same_set(directives, expected_shots), "one_focus_directive_per_technical_shot"),
    )


def reuse_errors(base: Column, status: Column, moments: Column, each: Column) -> Column:
    """base (temporal_errors with local) and the rules over moments: array of struct(moment_id, kind); each: their own codes, flattened."""
    ids = F.transform(moments, lambda m: m["moment_id"])
    more = errors(((status == "complete_action") & ~F.exists(moments, lambda m: m["kind"] == "complete_action"), "complete_action_requires_local_moment"), (F.size(F.array_distinct(ids)) < F.size(ids), "duplicate_moment_id"))
    return F.concat(base, more, each)


def utility_errors(judgments: Column, known: Column, moments: Column, reusable: Column, assessed: Column, sustained: Column) -> Column:
    """Codes of what is wrong with an assessment of all classes.

    judgments: array of struct(cls, assessment, ids); moments: array of struct(cls, kind, useful), useful: strong and usable; reusable and sustained: true,
    false or unclear; assessed: was everything looked at?
    """
    classes = F.array(*[F.lit(c) for c in sorted(UTILITY_CLASSES)])
    useful = F.filter(moments, lambda m: m["useful"])
    says = lambda c, a: F.exists(judgments, lambda j: (j["cls"] == c) & (j["assessment"] == a))
    open_ = F.exists(judgments, lambda j: j["assessment"].isin("useful", "unclear"))
    return errors(
        (F.array_sort(F.transform(judgments, lambda j: j["cls"])) != classes, "one_assessment_per_utility_class"),
        (F.exists(judgments, lambda j: (F.size(F.array_except(j["ids"], known)) > 0) | (F.size(F.array_distinct(j["ids"])) < F.size(j["ids"]))), "invalid_utility_citations"),
        (F.exists(judgments, lambda j: j["assessment"].isin("useful", "weak") & (F.size(j["ids"]) == 0)), "utility_judgment_requires_visual_citations"),
        (F.exists(useful, lambda m: ~says(m["cls"], "useful")), "moment_utility_assessment_contradiction"), ((reusable == "true") & (F.size(useful) == 0), "reusable_requires_supported_moment"),
        ((reusable == "false") & ((F.size(useful) > 0) | ~assessed | open_), "negative_reuse_requires_complete_resolved_assessment"),
        ((sustained == "false") & F.exists(moments, lambda m: m["kind"] == "sustained_state"), "sustained_state_contradiction"),
    )


def replayed_moment(temporal: Column, utility: Column, context: Column, status: Column, frames: Column, shots: Column, carried: Column) -> Column:
    """struct(reason, utility_class, kind, start_frame, end_frame): the moment that an older observation proves, or the first reason why none.

    frames: cited frames; shots: number of shots from the first to the last of them; carried: edges between these shots with an action, an interaction or a sequence in common.
    """
    alias = F.create_map(*[F.lit(x) for p in ALIASES.items() for x in p])
    cls = F.coalesce(alias[utility], utility)
    reason = (
        F.when(~temporal, "missing_temporal_visual_moments").when(~cls.isin(*UTILITY_CLASSES), "legacy_generic_class_did_not_assess_visual_reuse").when(context.isin("high", "unclear"), "visual_vs_narrative_context_unresolved")
        .when(~status.isin("reusable_state", "complete_action"), "local_moment_or_state_usability_unresolved").when(F.size(F.array_distinct(frames)) < 2, "insufficient_temporal_visual_support")
        .when((shots > 1) & (carried < shots - 1), "asset_cut_continuity_requires_visual_assessment")
    )
    kind = F.when(status == "reusable_state", "sustained_state").otherwise("complete_action")

    def said(reason: Column, cls: Column) -> Column:
        ok = lambda c: F.when(reason.isNull(), c)
        return F.struct(reason.alias("reason"), ok(cls).alias("utility_class"), ok(kind).alias("kind"), ok(F.array_min(frames)).alias("start_frame"), ok(F.array_max(frames) + 1).alias("end_frame"))

    return let_all({"reason": reason, "cls": cls}, said)


def compatibility_projection(temporal: Column, utility: Column, conversation: Column, context: Column, status: Column, complete: Column, states: Column, ids: Column, samples: Column, shots: Column, event_start: Column, event_end: Column, replayed: Column) -> Column:
    """What an older observation supports of a visual moment: struct(fields, missing, utility_class, kind, start_frame, end_frame, ids, saved).

    fields: array of struct(name, value, derived_from, source_fields), each value with where it comes from; missing: what is not there, or the
    reason of replayed (as replayed_moment() gives it) why all that is there makes no moment; the rest is the moment, null where something
    is missing. Of a state across cuts without proof of continuity the longest cited span inside one shot stands (saved), the earlier of equal
    ones, if it keeps the contract of moments. A conversation names a category, never strength or length. samples: array of
    struct(sample_id, frame, shot_id); shots: array of struct(shot_id, start_frame, end_frame), in order.
    """
    alias = F.create_map(*[F.lit(x) for p in ALIASES.items() for x in p])
    cls = F.when((utility == "generic_dialogue_only") & (conversation == "true"), "conversation_scene").otherwise(F.coalesce(alias[utility], utility))
    state = temporal & (status == "reusable_state") & (utility == "useful_state") & (F.size(states) > 0) & complete.isin("false", "unclear")
    action = temporal & (status == "complete_action") & (complete == "true")
    # each step names what the one before it has worked out
    first = {"cls": cls, "state": state, "kind": F.when(state, "sustained_state").when(action, "complete_action"), "origin": F.when(temporal, "temporal_v2").otherwise("existing_observation"), "ids": ids, "samples": samples, "shots": shots, "replayed": replayed}
    return let_all(first, lambda **v: _projection(context, status, complete, event_start, event_end, **v))


def _projection(context: Column, status: Column, complete: Column, event_start: Column, event_end: Column, cls: Column, state: Column, kind: Column, origin: Column, ids: Column, samples: Column, shots: Column, replayed: Column) -> Column:
    at = lambda rs: F.transform(rs, lambda s: s["frame"])
    names = lambda rs: F.transform(rs, lambda s: s["sample_id"])
    known, clear = F.coalesce(cls.isin(*UTILITY_CLASSES), F.lit(False)), F.coalesce(context.isin("low", "medium"), F.lit(False))
    asked = F.coalesce((replayed["reason"] == "asset_cut_continuity_requires_visual_assessment") & (status == "reusable_state"), F.lit(False))

    def span_of(shot: Column, rows: Column) -> Column:
        span = lambda own, low: F.struct((F.array_max(at(own)) - low).alias("length"), (-low).alias("early"), names(own).alias("ids"))
        return let(F.filter(rows, lambda s: s["shot_id"] == shot["shot_id"]), lambda own: let(F.array_min(at(own)), lambda low: span(own, low)))

    def looked(rows: Column) -> Column:
        support = (F.size(F.array_distinct(ids)) == F.size(ids)) & (F.size(F.array_except(ids, names(samples))) == 0) & (F.size(F.array_distinct(at(rows))) >= 2)
        # the longest cited span inside one shot, where it can be wanted
        spans = F.transform(shots, lambda shot: span_of(shot, rows))
        span = F.when(asked, F.array_max(F.filter(spans, lambda g: g["length"] > 0)))
        return let_all({"support": F.coalesce(support, F.lit(False)), "span": span}, lambda support, span: saving(rows, support, span))

    def saving(rows: Column, support: Column, span: Column) -> Column:
        a, b = -span["early"], span["length"] - span["early"] + 1
        none = F.lit(None).cast("string")
        wrong = moment_errors(a, b, event_start, event_end, F.lit("sustained_state"), complete, none, _none(), none, span["ids"], F.lit("supported"), samples, shots)
        saved = F.when(asked & span.isNotNull(), F.size(wrong) == 0).otherwise(F.lit(False))
        absent = errors((~known, "missing_moment_utility_category"), (~support, "missing_temporal_support"), (~clear, "missing_context_dependency_interpretation"), (kind.isNull(), "missing_action_or_sustained_state_assessment"))
        return let_all({"saved": F.coalesce(saved, F.lit(False)), "absent": absent}, lambda saved, absent: lacking(rows, support, span, a, b, saved, absent))

    def lacking(rows: Column, support: Column, span: Column, a: Column, b: Column, saved: Column, absent: Column) -> Column:
        missing = F.when(F.size(absent) > 0, absent).when(replayed["reason"].isNull() | saved, _none()).otherwise(F.array(replayed["reason"]))
        return let(missing, lambda m: said(rows, support, span, a, b, saved, m))

    def field(name: str, value: Column, holds: Column, *paths: str, source: Column = origin) -> Column:
        told = F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), source.alias("derived_from"), F.array(*[F.lit(x) for x in paths]).alias("source_fields"))
        return F.when(F.coalesce(holds, F.lit(False)), told)

    def said(rows: Column, support: Column, span: Column, a: Column, b: Column, saved: Column, missing: Column) -> Column:
        there = F.size(missing) == 0
        kind_from = F.when(state, F.array(F.lit("moment_status"), F.lit("visible_states"), F.lit("visual_utility_kind"))).otherwise(F.array(F.lit("moment_status")))
        usable = F.when(kind.isNotNull(), F.struct(F.lit("moment_usability").alias("name"), F.lit("usable").alias("value"), origin.alias("derived_from"), kind_from.alias("source_fields")))
        fields = F.array_compact(F.array(
            field("utility_class", cls, known, "visual_utility_kind", "conversation_present"), field("visual_context_dependency", context, clear, "context_dependency"),
            field("temporal_support", F.array_join(ids, ","), support, "temporal_support_sample_ids", "input_evidence.samples"), usable, field("moment_kind", kind, kind.isNotNull(), "moment_status"),
            field("asset_window_eligibility", F.lit("true"), there, "event.technical_shots", "temporal_support_sample_ids", source=F.lit("deterministic_event_evidence")),
        ))
        ok = lambda v, w: F.when(there, F.when(saved, w).otherwise(v))
        return F.struct(
            fields.alias("fields"), missing.alias("missing"), ok(replayed["utility_class"], cls).alias("utility_class"), ok(replayed["kind"], F.lit("sustained_state")).alias("kind"), ok(replayed["start_frame"], a).alias("start_frame"), ok(replayed["end_frame"], b).alias("end_frame"),
            ok(names(rows), span["ids"]).alias("ids"), (there & saved).alias("saved"),
        )

    return let(F.filter(samples, lambda s: F.array_contains(ids, s["sample_id"])), looked)


def decide_reuse(observations: DataFrame, moments: DataFrame, fps: int) -> DataFrame:
    """movie_id, event_id, decision, reasons, windows (number), again (is another look wanted?).

    observations: movie_id, event_id, known (is there a valid one?), flags (hard exclusions), same_event, errors, replay (the reasons why an older
    one has no moments; none: empty or null), assessed, blocked (did the provider refuse this input?). moments: movie_id, ord (a title's order), event_id, moment and
    what asset_windows reads. Windows of earlier events suppress later ones; only events that no rule has
    settled take part. A blocked event that wants another look is PROVIDER_BLOCKED instead.
    """
    if observations.schema["replay"].dataType.typeName() == "string":
        observations = observations.withColumn("replay", F.array_compact(F.array("replay")))
    settled = (
        F.when(~F.col("known"), "missing").when(F.size("flags") > 0, "flags").when(~F.col("same_event"), "mismatch").when(F.size("errors") > 0, "errors").when(F.size("replay") > 0, "replay")
    )
    x = observations.withColumn("settled", settled)
    open_ = moments.join(x.where("settled is null").select("movie_id", "event_id"), ["movie_id", "event_id"], "left_semi")
    planned = asset_windows(open_.drop("event_id"), fps).join(moments.select("movie_id", "moment", "event_id"), ["movie_id", "moment"])
    n = planned.groupBy("movie_id", "event_id").agg(*[F.count_if(F.col("state") == s).alias(s.lower()) for s in ("WINDOW", "REVIEW", "SUPPRESSED")])
    x = x.join(n, ["movie_id", "event_id"], "left").na.fill(0, ["window", "review", "suppressed"])
    one = lambda t: F.array(F.lit(t))
    unsure = (F.col("review") > 0) | ((F.col("suppressed") == 0) & ~F.col("assessed"))
    rules = [
        (F.col("settled") == "missing", "REVIEW", one("missing_valid_observation")), (F.col("settled") == "flags", "REJECT", F.transform("flags", lambda f: F.concat(F.lit("hard_exclusion:"), f))),
        (F.col("settled") == "mismatch", "REVIEW", one("observation_event_mismatch")), (F.col("settled") == "errors", "REVIEW", F.col("errors")), (F.col("settled") == "replay", "REVIEW", F.col("replay")),
        (F.col("window") > 0, "KEEP", one("visually_reusable_moment")), (unsure, "REVIEW", one("visual_window_not_established")),
    ]
    decision, reasons = F.when(F.lit(False), ""), F.when(F.lit(False), _none())
    for rule, what, why in rules:
        decision, reasons = decision.when(rule, what), reasons.when(rule, why)
    x = x.withColumn("decision", decision.otherwise("REJECT")).withColumn("reasons", reasons.otherwise(one("duplicate_or_weak_visual_utility")))
    again = (F.col("decision") == "REVIEW") | ((F.col("decision") == "KEEP") & (F.col("review") > 0))
    stopped = again & F.col("blocked")
    why = F.when(F.col("settled") == "missing", one("provider_input_quarantine")).otherwise(F.concat(one("provider_input_quarantine"), F.col("reasons")))
    return x.select(
        "movie_id", "event_id", F.when(stopped, "PROVIDER_BLOCKED").otherwise(F.col("decision")).alias("decision"), F.when(stopped, why).otherwise(F.col("reasons")).alias("reasons"),
        F.col("window").alias("windows"), (again & ~stopped).alias("again"),
    )


def effective_completeness(status: Column, raw: Column) -> Column:
    """Completeness as the first policy reads it: a reusable state counts as complete, whatever was said of the action."""
    return F.when(status == "reusable_state", "true").otherwise(raw)


def grounded_actions(actions: DataFrame) -> DataFrame:
    """Distinct actions that samples support, with stable ids: movie_id, event_id, label, action_id.

    actions: movie_id, event_id, label, evidence, ids, known (ids of the event's samples), frames (distinct frames cited).
    """
    good = (F.col("evidence") == "distinct_visible_action_or_reaction") & (F.trim("label") != "") & (F.size(F.array_except("ids", "known")) == 0) & (F.col("frames") >= 2)
    mark = F.substring(F.sha2(F.concat_ws("|", "label", "evidence", F.array_join("ids", ",")).cast("binary"), 256), 1, 16)
    return actions.where(good).select("movie_id", "event_id", "label", F.concat(F.col("event_id").cast("string"), F.lit(":ACTION_"), mark).alias("action_id"))


def window_identity(event: Column, start: Column, end: Column) -> Column:
    """24 hex digits that depend on the event and the frame range alone."""
    return F.substring(F.sha2(F.concat_ws(":", F.lit("producer_window_v1"), event.cast("string"), start.cast("string"), end.cast("string")).cast("binary"), 256), 1, 24)


def producer_candidates(windows: DataFrame, shots: DataFrame) -> DataFrame:
    """One row per distinct window: movie_id, event_id, window_id, whole (does it cover its event?), shots clipped to it.

    windows: movie_id, event_id, start_frame, end_frame, event_start, event_end; shots: movie_id, event_id, shot_id, start_frame, end_frame.
    """
    w = windows.where("event_start <= start_frame and start_frame < end_frame and end_frame <= event_end").dropDuplicates(["movie_id", "event_id", "start_frame", "end_frame"])
    s = shots.select("movie_id", "event_id", "shot_id", F.col("start_frame").alias("a"), F.col("end_frame").alias("b"))
    met = w.join(s, ["movie_id", "event_id"]).where("a < end_frame and b > start_frame")
    clipped = F.struct(F.greatest("a", "start_frame").alias("start_frame"), F.least("b", "end_frame").alias("end_frame"), "shot_id")
    g = met.groupBy("movie_id", "event_id", "start_frame", "end_frame", "event_start", "event_end").agg(F.sort_array(F.collect_list(clipped)).alias("shots"))
    whole = (F.col("start_frame") == F.col("event_start")) & (F.col("end_frame") == F.col("event_end"))
    return g.select("movie_id", "event_id", window_identity(F.col("event_id"), F.col("start_frame"), F.col("end_frame")).alias("window_id"), whole.alias("whole"), "shots")


def ingest_responses(members: DataFrame, responses: DataFrame) -> DataFrame:
    """What a batch's answer says of each member, and how many rows belong to nobody: request_id, event_id, status.

    members: request_id, event_id; responses: request_id, raw (a JSON text each; one that cannot be read or has no event_id is EXTRA, and so is
    one of a stranger). A member's row has valid and inconclusive flags; two rows of one member block each other.
    """
    x = responses.select("request_id", F.get_json_object("raw", "$.event_id").cast("bigint").alias("event_id"), F.get_json_object("raw", "$.valid").alias("valid"), F.get_json_object("raw", "$.inconclusive").alias("open"))
    g = x.groupBy("request_id", "event_id").agg(F.count(F.lit(1)).alias("n"), F.max("valid").alias("valid"), F.max("open").alias("open"))
    m = members.select("request_id", "event_id").withColumn("member", F.lit(True))
    both = m.join(g, ["request_id", "event_id"], "full_outer")
    status = (
        F.when(F.col("member").isNull(), "EXTRA").when(F.col("n").isNull(), "MISSING_FROM_BATCH_RESPONSE").when((F.col("n") > 1) | (F.coalesce("valid", F.lit("false")) != "true"), "VALIDATION_BLOCKED")
        .when(F.col("open") == "true", "VALID_INCONCLUSIVE").otherwise("VALID")
    )
    return both.select("request_id", "event_id", status.alias("status"))


def reusable_checkpoints(current: DataFrame, saved: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """keys, reusable: is there a saved row, valid and with focus, that agrees in all parts (nulls included)? Who made it does not matter."""
    s = saved.select(*keys, "valid", "focus", *[F.col(p).alias(f"was_{p}") for p in parts])
    same = F.lit(True)
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"was_{p}"))
    return current.join(s, keys, "left").groupBy(*keys).agg(F.coalesce(F.max(same & F.col("valid") & F.col("focus")), F.lit(False)).alias("reusable"))


def recovered(attempts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The newest saved answer of each wanted row (movie_id, event_id, identity) with its identity that is valid now: movie_id, event_id, attempt."""
    good = attempts.where("valid").join(wanted, ["movie_id", "event_id", "identity"], "left_semi")
    return good.groupBy("movie_id", "event_id").agg(F.max("attempt").alias("attempt"))
