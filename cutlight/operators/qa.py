"""What the checks of a rendered asset amount to: failures that stop it, and warnings that do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reasons of an audit that warn without proof of harm.
WARNINGS = (
    "focused_person_persistently_at_crop_edge", "close_up_person_detection_inconclusive", "multiple_people_not_reliably_observed", "intended_target_not_reliably_visible", "target_binding_unstable", "crop_centered_between_competing_subjects",
    "competing_subject_dominates_target", "target_too_small_for_editorial_use", "legacy_multi_person_identity_unbound", "semantic_target_binding_unresolved", "no_render_samples", "post_render_detector_error",
)
_NONE = "array<string>"


def _codes(*rules: tuple[Column, Column | str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(code) if isinstance(code, str) else code) for rule, code in rules]))


def classify(assets: DataFrame) -> DataFrame:
    """assets with hard and soft: codes of failures and warnings, each once, in the order they are met.

    assets: file_exists, frame_count, width, height, aspect_ratio, duration_valid, black_bars, crop_plan_valid; shots: array of struct(
    focus_requirement, focus_subject_present, critical_focus_clipping, introduced_subject_clipping, crop_stable, action_preserved, interaction_preserved,
    full_bbox_clipping, focus_directive_available); audit: array of struct(reason, visibility, dominance) of the rendered shots; face: decision of
    the face audit. What is null was not looked at and is no failure, but for width and height; a missing visibility is 1, a missing
    dominance 0.
    """
    c = F.col
    no = lambda x: ~F.coalesce(x, F.lit(True))
    yes = lambda x: F.coalesce(x, F.lit(False))
    flat = (F.coalesce("width", F.lit(0)) <= 0) | (F.coalesce("height", F.lit(0)) <= 0)
    whole = _codes(
        (no(c("file_exists")), "vertical_render_missing"), (F.coalesce("frame_count", F.lit(1)) <= 0, "vertical_render_unreadable"), (flat, "vertical_dimensions_invalid"), (~flat & ~c("aspect_ratio").eqNullSafe("3:4"), "vertical_aspect_ratio_invalid"),
        (no(c("duration_valid")), "vertical_duration_invalid"), (yes(c("black_bars")), "severe_black_bars_or_corruption"), (no(c("crop_plan_valid")), "crop_plan_invalid"),
    )

    def shot_hard(s: Column) -> Column:
        needed = s["focus_requirement"] == "person"
        return _codes(
            (needed & no(s["focus_subject_present"]), "primary_subject_missing"), (needed & (yes(s["critical_focus_clipping"]) | yes(s["introduced_subject_clipping"])), "primary_subject_materially_clipped"), (no(s["crop_stable"]), "severe_reframe_instability"),
            (no(s["action_preserved"]), "required_action_or_region_lost"), (no(s["interaction_preserved"]), "required_multi_person_interaction_lost"),
        )

    def shot_soft(s: Column) -> Column:
        return _codes((yes(s["full_bbox_clipping"]) & ~yes(s["critical_focus_clipping"]), "noncritical_subject_edge_proximity"), (no(s["focus_directive_available"]), "focus_directive_unavailable"))

    def wrong_subject(a: Column) -> Column:
        return (a["reason"] == "intended_target_not_reliably_visible") & (F.coalesce(a["visibility"], F.lit(1.0)) < 0.20) & (F.coalesce(a["dominance"], F.lit(0.0)) >= 0.60)

    def audit_hard(a: Column) -> Column:
        return _codes(
            (a["reason"].isin("vertical_unreadable", "insufficient_render_decode"), "vertical_render_unreadable"), (a["reason"] == "required_people_not_visible_together", "required_multi_person_interaction_lost"),
            (a["reason"] == "focused_person_lost_in_render", "primary_subject_lost_in_render"), (wrong_subject(a), "wrong_subject_or_region_followed"),
        )

    def audit_soft(a: Column) -> Column:
        return _codes((a["reason"].isin(*WARNINGS) & ~wrong_subject(a), a["reason"]))

    of = lambda col, f: F.flatten(F.coalesce(F.transform(col, f), F.array().cast("array<array<string>>")))
    face_hard = _codes((c("face") == "REPAIR", "important_face_or_head_materially_clipped"))
    face_soft = _codes((~c("face").isin("PASS", "REPAIR"), F.concat(F.lit("face_safe_"), F.lower("face"))))
    hard = F.array_distinct(F.concat(whole, of("shots", shot_hard), of("audit", audit_hard), face_hard))
    soft = F.array_distinct(F.concat(of("shots", shot_soft), of("audit", audit_soft), face_soft))
    return assets.withColumns({"hard": hard.cast(_NONE), "soft": soft.cast(_NONE)})


#: Share of the crop that must stay free beside what is protected; shares for empty space and for a jump of the crop (fixed values).
SAFE, EMPTY, JUMP = 0.08, 0.20, 0.18


def focal_core(focus: Column, crop: Column) -> Column:
    """struct(x, w): the head region of a person's box; nearer to the middle where the box is much wider than the crop."""
    wide = focus["w"] >= crop * 1.5
    return F.struct((focus["x"] + focus["w"] * F.when(wide, 0.40).otherwise(0.30)).alias("x"), (focus["w"] * F.when(wide, 0.22).otherwise(0.40)).alias("w"))


def shot_geometry(rules: DataFrame, margin: float = SAFE) -> DataFrame:
    """rules with what a planned crop does to each shot: requirement, present, full_bbox_clipping, critical_focus_clipping, introduced_subject_clipping, source_edge_exception, empty_space_while_clipped, interaction_preserved, action_preserved, crop_stable, status.

    rules: crop, x, source (widths and place in pixels), focus (struct(x, w) of the required box, or null), person (must a person be seen?), subject (environment,
    action_region or another), together (must all stay in the picture?), review (did the plan ask for one?), bound (true, false; null: no target was named), directive (is
    there one?), keeps_action, regions (array of struct(x, w)), anchors (array of x in time), faces (array of struct(decision, limited), the judgment at each time, or
    empty: then the focus decides). A box at the edge of the source is no fault of the crop.
    """
    c = F.col
    yes = lambda x, otherwise: F.coalesce(x, F.lit(otherwise))
    free, right = c("crop") * margin, c("x") + c("crop")
    inside = lambda b: (b["x"] >= c("x") + free) & (b["x"] + b["w"] <= right - free)
    together, person = yes(c("together"), False), yes(c("person"), False)
    critical = F.when(together, F.struct(c("focus")["x"].alias("x"), c("focus")["w"].alias("w"))).otherwise(focal_core(c("focus"), c("crop")))
    has = c("focus").isNotNull()
    edge = has & ((c("focus")["x"] <= 1) | (c("focus")["x"] + c("focus")["w"] >= c("source") - 1))
    full = has & ~inside(c("focus"))
    clipped = has & ~inside(critical) & ~edge
    apart = F.abs(critical["x"] + critical["w"] / 2 - (c("x") + c("crop") / 2)) > c("crop") * EMPTY
    looked = F.coalesce(F.size("faces"), F.lit(0)) > 0
    repair = F.exists("faces", lambda f: f["decision"] == "REPAIR")
    by_face = lambda face, box: F.when(looked, face).otherwise(box)
    x = rules.withColumns({
        "full_bbox_clipping": yes(full, False), "critical_focus_clipping": yes(by_face(repair, clipped), False), "introduced_subject_clipping": yes(by_face(repair, clipped & person), False),
        "source_edge_exception": yes(by_face(F.exists("faces", lambda f: f["limited"]), edge), False), "empty_space_while_clipped": yes(by_face(repair, clipped & person & apart), False),
    })
    regions = F.forall(F.coalesce("regions", F.array().cast("array<struct<x: double, w: double>>")), lambda r: (r["x"] >= c("x")) & (r["x"] + r["w"] <= right))
    jumps = F.transform(F.sequence(F.lit(1), F.size("anchors") - 1), lambda i: F.abs(F.get("anchors", i) - F.get("anchors", i - 1)))
    stable = F.when(F.coalesce(F.size("anchors"), F.lit(0)) <= 1, True).otherwise(F.array_max(jumps) <= c("crop") * JUMP + 1)
    x = x.withColumns({"interaction_preserved": F.when(together, ~yes(c("review"), False)).otherwise(True), "action_preserved": yes(c("keeps_action"), True) & regions, "crop_stable": stable, "present": F.when(person, has)})
    x = x.withColumn("requirement", F.when(person, "person").when(c("subject") == "environment", "environment").when(c("subject") == "action_region", "action").otherwise("none"))
    bound = F.when(person, yes(c("bound"), True)).otherwise(True)
    fine = yes(c("directive"), True) & (~person | has) & bound & ~c("introduced_subject_clipping") & ~c("empty_space_while_clipped") & c("crop_stable") & c("interaction_preserved") & c("action_preserved")
    return x.withColumn("status", F.when(fine, "PASS").otherwise("FAIL"))
