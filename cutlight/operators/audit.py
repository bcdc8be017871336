"""What a rendered picture shows of the person that its crop was planned for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutlight.functions.columns import let
from cutlight.operators.geometry import median_of

_SHOT = ["movie_id", "asset", "shot_id"]
_BOX = ("x", "y", "w", "h")


def place_at(anchors: Column, t: Column) -> Column:
    """Where a crop begins at time t, to a whole pixel (halves to the even one): between two anchors in proportion, before the first and behind the last pair as at the last."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(anchors) - 1), lambda i: F.struct(F.get(anchors, i - 1).alias("a"), F.get(anchors, i).alias("b")))
    pair = F.get(F.filter(pairs, lambda p: (p["a"]["t"] <= t) & (t <= p["b"]["t"])), 0)
    between = let(pair, lambda p: p["a"]["x"] + (p["b"]["x"] - p["a"]["x"]) * (t - p["a"]["t"]) / F.greatest(F.lit(0.001), p["b"]["t"] - p["a"]["t"]))
    return F.bround(F.when(F.size(anchors) <= 1, F.get(anchors, 0)["x"]).otherwise(F.coalesce(between, F.element_at(anchors, -1)["x"])))


def rendered_target(plan: DataFrame) -> DataFrame:
    """plan with seen: the person of a rendered frame (struct x, y, w, h) that is the planned one, or null.

    plan: people (array of struct x, y, w, h, in order), targets (array of struct t, x, y, w, h: where the planned person was in the source, in time), anchors (array of struct t, x), t (the frame's time
    in the source), crop, width. The planned place, brought into the picture, picks the nearest person, who counts within 0.28 of the width, or 0.9 of
    the person's own width. Without planned places the person nearest to the middle is looked at, as older plans name nobody.
    """
    c = F.col
    known = F.coalesce(F.size("targets"), F.lit(0)) > 0
    nearest = F.array_min(F.transform("targets", lambda r, i: F.struct(F.abs(r["t"] - c("t")).alias("off"), i.alias("i"), r.alias("r"))))["r"]
    x = plan.withColumn("source", nearest)
    scale = lambda v: v * c("width") / F.greatest(F.lit(1.0), c("crop"))
    expected = scale(c("source.x") + c("source.w") / 2 - place_at(c("anchors"), c("t")))
    x = x.withColumn("expected", F.when(known, expected).otherwise(c("width") / 2))
    best = let(c("expected"), lambda at: F.array_min(F.transform("people", lambda p, i: F.struct(F.abs(p["x"] + p["w"] / 2 - at).alias("off"), i.alias("i"), F.struct(*[p[k].alias(k) for k in _BOX]).alias("p")))))
    x = x.withColumn("best", best)
    near = c("best.off") <= F.greatest(c("width") * 0.28, scale(c("source.w")) * 0.9)
    return x.withColumn("seen", F.when(~known | near, c("best.p"))).drop("source", "expected", "best")


def shot_audit(plans: DataFrame, frames: DataFrame, people: DataFrame) -> DataFrame:
    """Does each rendered shot keep its person? movie_id, asset, shot_id, decision (PASS, AMBIGUOUS, RETRY), reason, samples, and the measured shares.

    plans: movie_id, asset, shot_id, subject, need, person (is one required?), bound (true, false; null: nobody was named), focus_w (width of the planned focus), crop, width,
    height (of the picture), anchors, targets (as in rendered_target), start, end (seconds in the source), first, last (rendered frames, end exclusive). frames: movie_id, asset, shot_id, frame, decoded, failed
    (the detector broke down): the frames that were looked at, some for each shot. people: movie_id, asset, shot_id, frame, person, x, y, w, h: persons found; boxes of a
    pixel or less are none. Ratios are rounded to four places before they are judged. The rules go in order; the first one that fits decides.
    """
    c = F.col
    found = people.where((c("w") > 1) & (c("h") > 1)).groupBy(*_SHOT, "frame").agg(F.sort_array(F.collect_list(F.struct("person", *_BOX))).alias("people"))
    x = frames.join(found, [*_SHOT, "frame"], "left").join(plans.select(*_SHOT, "crop", "width", "height", "anchors", "targets", "start", "end", "first", "last"), _SHOT)
    x = x.withColumn("people", F.when(c("decoded"), F.coalesce("people", F.array().cast(found.schema["people"].dataType))).otherwise(F.array().cast(found.schema["people"].dataType)))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (c("frame") - c("first")) / F.greatest(F.lit(1.0), (c("last") - c("first")).cast("double"))))
    x = rendered_target(x.withColumn("t", c("start") + share * F.greatest(F.lit(0.0), c("end") - c("start"))))
    center, area = c("seen.x") + c("seen.w") / 2, c("seen.w") * c("seen.h")
    covered = F.exists("people", lambda p: (p["x"] < c("width") * 0.60) & (p["x"] + p["w"] > c("width") * 0.40))
    n = F.size("people")
    looked = F.struct(
        "frame", "decoded", n.alias("n"), c("seen").isNotNull().alias("seen"), center.alias("center"), (F.abs(center - c("width") / 2) / F.greatest(F.lit(1.0), c("width"))).alias("off"), (area / F.greatest(F.lit(1.0), c("width") * c("height"))).alias("share"),
        ((c("seen.x") <= c("width") * 0.04) | (c("seen.x") + c("seen.w") >= c("width") * 0.96)).alias("edge"), F.exists("people", lambda p: p["w"] * p["h"] > area * 1.15).alias("rival"), ((n >= 2) & ~covered).alias("hollow"),
    )
    g = x.groupBy(*_SHOT).agg(F.sort_array(F.collect_list(looked)).alias("looked"), F.bool_or("failed").alias("failed"))
    x = plans.join(g, _SHOT, "left").withColumn("samples", F.coalesce(F.size("looked"), F.lit(0)))
    total = F.greatest(F.lit(1), c("samples"))
    of = lambda rule: F.size(F.filter("looked", rule))
    part = lambda rule: of(rule) / total
    x = x.withColumn("kept", F.filter("looked", lambda s: s["seen"])).withColumn("hit", F.size("kept"))
    among = lambda rule: F.round(F.size(F.filter("kept", rule)) / F.greatest(F.lit(1), c("hit")), 4)
    leaps = F.size(F.filter(F.transform("kept", lambda s, i: F.abs(F.get("kept", i + 1)["center"] - s["center"]) / F.greatest(F.lit(1.0), c("width"))), lambda j: j > 0.38))
    x = x.withColumns({
        "decoded": part(lambda s: s["decoded"]), "present": part(lambda s: s["n"] > 0), "centered": part(lambda s: s["off"] <= 0.33), "together": part(lambda s: s["n"] >= 2), "visible": F.round(c("hit") / total, 4), "stable": F.round(F.greatest(F.lit(0.0), (c("hit") - leaps) / total), 4),
        "edge": among(lambda s: s["edge"]), "rival": among(lambda s: s["rival"]), "hollow": F.round(of(lambda s: s["hollow"]) / F.greatest(F.lit(1), of(lambda s: s["decoded"])), 4),
        "occupancy": F.round(F.coalesce(median_of(F.array_sort(F.transform("kept", lambda s: s["share"]))), F.lit(0.0)), 4), "off_center": F.round(median_of(F.array_sort(F.transform("kept", lambda s: s["off"]))), 4),
    })
    both, several = c("need").eqNullSafe("simultaneous"), c("subject").eqNullSafe("multiple_people")
    alone = ~both & ~several
    close = F.coalesce(c("focus_w") >= c("crop") * 1.40, F.lit(False))
    rules = (
        (~F.coalesce("person", F.lit(False)), "PASS", "person_audit_not_applicable"), (c("bound").eqNullSafe(False), "RETRY", "semantic_target_binding_unresolved"), (c("samples") == 0, "AMBIGUOUS", "no_render_samples"), (c("failed"), "AMBIGUOUS", "post_render_detector_error"),
        (c("decoded") < 0.80, "AMBIGUOUS", "insufficient_render_decode"), (several & both & (c("together") < 0.60), "RETRY", "required_people_not_visible_together"), (several & (c("together") < 0.60), "AMBIGUOUS", "multiple_people_not_reliably_observed"),
        (several, "PASS", "rendered_subject_present_and_usable"), ((c("present") < 0.60) & close, "AMBIGUOUS", "close_up_person_detection_inconclusive"), (c("present") < 0.60, "RETRY", "focused_person_lost_in_render"),
        (c("visible") < 0.60, "AMBIGUOUS", "intended_target_not_reliably_visible"), (c("stable") < 0.60, "AMBIGUOUS", "target_binding_unstable"), (c("edge") >= 0.60, "RETRY", "focused_person_persistently_at_crop_edge"),
        (alone & (c("hollow") >= 0.40), "AMBIGUOUS", "crop_centered_between_competing_subjects"), (alone & (c("rival") >= 0.40) & (c("edge") >= 0.40), "AMBIGUOUS", "competing_subject_dominates_target"), (c("occupancy") < 0.025, "AMBIGUOUS", "target_too_small_for_editorial_use"),
        (c("bound").isNull() & (c("together") >= 0.40), "AMBIGUOUS", "legacy_multi_person_identity_unbound"), (F.lit(True), "PASS", "rendered_subject_present_and_usable"),
    )
    said = F.coalesce(*[F.when(rule, F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))) for rule, d, r in rules])
    asked = F.coalesce("person", F.lit(False)) & ~c("bound").eqNullSafe(False)
    return x.select(*_SHOT, said["decision"].alias("decision"), said["reason"].alias("reason"), F.when(asked, c("samples")).otherwise(0).alias("samples"), "decoded", "present", "centered", "together", "visible", "stable", "edge", "rival", "hollow", "occupancy", "off_center")


def asset_audit(shots: DataFrame, faces: DataFrame) -> DataFrame:
    """The worst decision of an asset's shots, and the face audit's word on it: movie_id, asset, decision, reason, strategy (of the next try, or null).

    shots: as shot_audit() gives them; faces: movie_id, asset, face (PASS, REPAIR, SOURCE_LIMIT, AMBIGUOUS), where a face had to be kept.
    """
    has = lambda d: F.bool_or(F.col("decision") == d)
    g = shots.groupBy("movie_id", "asset").agg(has("RETRY").alias("again"), has("AMBIGUOUS").alias("unsure")).join(faces.select("movie_id", "asset", "face"), ["movie_id", "asset"], "left")
    bad = F.coalesce(F.col("face") != "PASS", F.lit(False))
    decision = F.when(F.col("again") | (bad & (F.col("face") == "REPAIR")), "RETRY").when(F.col("unsure") | bad, "AMBIGUOUS").otherwise("PASS")
    reason = F.when(bad, F.concat(F.lit("face_safe_"), F.lower("face"))).when(F.col("again"), "one_or_more_shots_need_reframe").when(F.col("unsure"), "one_or_more_shots_need_semantic_or_identity_review").otherwise("all_rendered_shots_pass")
    return g.select("movie_id", "asset", decision.alias("decision"), reason.alias("reason"), F.when(F.col("face") == "REPAIR", "face_priority").alias("strategy"))
