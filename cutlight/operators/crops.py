"""Crop plans: for each shot the box that must stay in the picture, and where a crop of full height begins over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutlight.functions.columns import let
from cutlight.operators import faces as fa
from cutlight.operators import geometry as geo
from cutlight.operators import tracks as tr
from cutlight.operators.qa import SAFE
from cutlight.session import shuffled

_SHOT = ["movie_id", "shot_id"]
_BOX = ("x", "y", "w", "h")
_ROW = "struct<t: double, x: double, y: double, w: double, h: double>"
# Subjects, needs, and words that tell of touch.
SUBJECTS = ("woman", "man", "multiple_people", "action_region", "environment", "unclear")
NEEDS = ("none", "sequence", "simultaneous", "unclear")
TOUCH = ("hug", "kiss", "handshake", "handoff", "handing", "fight", "touch", "dance", "embrace", "abrazo", "beso", "apretón", "entrega", "tocar")


def interaction_need(said: Column, both: Column, preserve: Column, text: Column, interactions: Column) -> Column:
    """One of NEEDS. said counts if it is one of them; else both (are both required?), preserve with a word of touch in text, then preserve or any
    visible interactions (an array) decide, as older directives say it."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    touch = F.coalesce(F.lower(text).rlike("|".join(TOUCH)), F.lit(False))
    old = F.when(yes(both) | (yes(preserve) & touch), "simultaneous").when(yes(preserve) | (F.coalesce(F.size(interactions), F.lit(0)) > 0), "sequence").otherwise("none")
    return F.when(F.lower(said).isin(*NEEDS), F.lower(said)).otherwise(old)


def legal_interval(region: Column, width: float, crop: float) -> Column:
    """struct(low, high, fits): where a crop may begin so that region (struct x, w) keeps its margin; fits: there is such a place, and the source itself does not cut it off."""
    margin = geo.required_margin(region["w"])
    low, high = region["x"] + region["w"] + margin - crop, region["x"] - margin
    begin, end = F.greatest(F.lit(0.0), low), F.least(F.lit(width - crop), high)
    limited = (region["x"] <= 1) | (region["x"] + region["w"] >= width - 1) | (low > high)
    return F.struct(begin.alias("low"), end.alias("high"), ((begin <= end) & ~limited).alias("fits"))


def union_box(boxes: Column) -> Column:
    """The box around an array of boxes; null for none."""

    def around(boxes: Column) -> Column:
        left, top = F.array_min(F.transform(boxes, lambda b: b["x"])), F.array_min(F.transform(boxes, lambda b: b["y"]))
        right, bottom = F.array_max(F.transform(boxes, lambda b: b["x"] + b["w"])), F.array_max(F.transform(boxes, lambda b: b["y"] + b["h"]))
        return F.when(F.coalesce(F.size(boxes), F.lit(0)) > 0, F.struct(left.alias("x"), top.alias("y"), (right - left).alias("w"), (bottom - top).alias("h")))

    return let(boxes, around)


def free_track(seen: Column, found: Column, place: Column, width: float) -> Column:
    """array of struct(t, x, y, w, h): the box that is meant, sample by sample, where no person is named.

    seen: array of struct(sample, t); found: array of struct(sample, person, x, y, w, h, confidence, foreground, face), in order. Boxes behind the foreground come first,
    among them faces. The first choice is the only one left, or the one nearest to the wanted side (of equals the surest); without a side nobody.
    From then on it is the one nearest to the last choice.
    """
    some = lambda xs, rule: let(F.filter(xs, rule), lambda ys: F.when(F.size(ys) > 0, ys).otherwise(xs))
    middle = lambda b: b["x"] + b["w"] / 2
    side = F.when(place == "left", 0.25).when(place == "center", 0.5).when(place == "right", 0.75) * width

    def nearest(xs: Column, at: Column, sure: bool) -> Column:
        key = lambda b, i: F.struct((F.abs(middle(b) - at) / (width if sure else 1.0)).alias("d"), (-b["confidence"] if sure else F.lit(0.0)).alias("c"), i.alias("i"), b.alias("b"))
        return F.array_min(F.transform(xs, key))["b"]

    def step(state: Column, s: Column) -> Column:
        last = state["last"]
        choose = lambda h: F.when(F.size(h) <= 0, None).when(last.isNotNull(), nearest(h, middle(last), False)).when(F.size(h) == 1, h[0]).when(side.isNotNull(), nearest(h, side, True))
        pick = let(F.filter(found, lambda b: b["sample"] == s["sample"]), lambda h: let(some(h, lambda b: ~b["foreground"]), lambda h: let(some(h, lambda b: b["face"]), choose)))
        row = lambda b: F.struct(s["t"].cast("double").alias("t"), *[b[c].cast("double").alias(c) for c in _BOX])
        on = lambda r: F.struct(r.alias("last"), F.concat(state["out"], F.array(r)).alias("out"))
        return let(pick, lambda b: F.when(b.isNull(), state).otherwise(let(row(b), on)))

    return F.aggregate(seen, F.struct(F.lit(None).cast(_ROW).alias("last"), F.array().cast(f"array<{_ROW}>").alias("out")), step)["out"]


def crop_plans(shots: DataFrame, samples: DataFrame, boxes: DataFrame, faces: DataFrame, directives: DataFrame, width: float, height: float, strategy: str = "subject_focus") -> DataFrame:
    """A plan for each shot: where a crop of full height and 3:4 begins over time, what it must hold, and whether somebody must look at it.

    shots: movie_id, shot_id, start, end, position (left, center or right: where the subject is said to be). samples: movie_id, shot_id, sample (without
    gaps), t. boxes: movie_id, shot_id, sample, person, x, y, w, h, confidence, foreground, face (a face found by itself, no person). faces: movie_id, shot_id, sample, face, box:
    those that may be bound to a target. directives, at most one a shot: subject, role, need (see interaction_need), secondary (must a second one stay?), place (left,
    center, right), targets (ids of persons; null: none named), regions (array of struct x, y, w, h that must stay). A shot without directive has none of this.

    Named persons are followed from the middle sample (one alone, or several together); names that cannot be followed leave no focus, and nobody else
    is taken instead. Without names free_track() decides. A named primary person's face, or else the upper part of the box, bounds the
    crop at each sample; strategy face_priority also centres on it. What must be together (simultaneous, several people, a second
    subject; or strategy interaction_aware) is the union of all boxes, and regions of action join it. If that fits, the crop stands still
    around it; else it follows the focus; else it stands at the position.

    Returns movie_id, shot_id, mode, locals (labels of the named), bound (null: none named or no person required), reason, track, focus, required, preserve, how (composition,
    track, fallback), anchors (array of struct t, x), x (their median), crop, face_bounded, face_review, impossible, review, action_kept.
    """
    crop = float(min(width, round(height * 3 / 4)))
    c, size = F.col, lambda a: F.coalesce(F.size(a), F.lit(0))
    said = directives.select(*_SHOT, "subject", "role", "need", "secondary", "place", "targets", "regions", F.lit(True).alias("directed"))
    d = shots.select(*_SHOT, "start", "end", "position").join(shuffled(said), _SHOT, "left")
    d = d.withColumns({
        "subject": F.when(F.lower("subject").isin(*SUBJECTS), F.lower("subject")).otherwise("unclear"), "role": F.coalesce("role", F.lit("primary")), "need": F.coalesce("need", F.lit("none")), "secondary": F.coalesce("secondary", F.lit(False)),
        "directed": F.coalesce("directed", F.lit(False)), "regions": F.coalesce("regions", F.array().cast("array<struct<x: double, y: double, w: double, h: double>>")), "place": F.lower("place"),
    })
    # all that is known of a shot lies in its row from here on, so nothing is shuffled by sample, face or target
    of_shot = boxes.groupBy(*_SHOT).agg(tr.measured_boxes(~c("face")).alias("all"), F.sort_array(F.collect_list(F.struct("sample", "person", *_BOX, "confidence", "foreground", "face"))).alias("found"))
    shown = faces.groupBy(*_SHOT).agg(F.collect_list(F.struct("sample", "face", F.struct(*[c("box")[k].alias(k) for k in _BOX]).alias("box"))).alias("faces"))
    for part in (tr.sampled(samples), of_shot, shown):
        d = d.join(shuffled(part), _SHOT, "left")
    d = tr.placed_in_row(d)

    # who is named: every id in its own shot, in the middle sample
    people = F.transform(c("middle")["boxes"], lambda b, i: F.struct(F.concat(F.lit("P"), (i + 1).cast("string")).alias("label"), b.alias("box")))
    d = d.withColumn("who", F.when(c("targets").isNotNull() & c("seed").isNotNull(), let(people, lambda people: F.transform("targets", lambda t: fa.resolved_identity(t, people, bare=True)))))
    d = d.withColumns({"names": F.transform("who", lambda w: w["local"]), "wrong": F.get(F.filter(F.transform("who", lambda w: w["reason"]), lambda r: r.isNotNull()), 0)})
    locals_, wrong = c("names"), c("wrong")
    twice = size(F.array_distinct("targets")) != size(c("targets"))
    error = F.when(c("targets").isNull(), None).when(c("seed").isNull() | (size(c("targets")) == 0) | twice, "invalid_target_person_ids").when(wrong.isNotNull(), wrong).when(size(F.array_distinct(locals_)) != size(locals_), "ambiguous_local_target")
    person = c("subject").isin("woman", "man", "multiple_people")
    one = person & (c("subject") != "multiple_people") & (size(c("targets")) == 1) & (c("need") != "simultaneous") & ~c("secondary")
    several = person & (size(c("targets")) >= 2)
    d = d.withColumn("error", error).withColumn("locals", F.when(c("targets").isNotNull() & c("error").isNull(), locals_)).drop("who", "names", "wrong")
    d = d.withColumns({"person": person, "one": F.coalesce(one, F.lit(False)), "several": F.coalesce(several, F.lit(False)), "preserve": (c("need") == "simultaneous") | (c("subject") == "multiple_people") | c("secondary")})

    x = d.withColumn("followed", F.when(c("error").isNull() & (c("one") | c("several")), F.transform("locals", lambda t: tr.follow(t, width))))
    x = x.withColumns({"alone": F.when(c("one"), F.get("followed", 0)), "joint": F.when(c("several") & c("followed").isNotNull(), tr.joint(c("locals"), c("followed")))})
    x = x.withColumns({"complete": F.coalesce("alone.complete", "joint.complete"), "reason": F.coalesce("alone.reason", "joint.reason")})
    as_rows = lambda a: F.transform(a, lambda r: F.struct(*[r[k].alias(k) for k in ("t", *_BOX)]))

    none = F.array().cast(f"array<{_ROW}>")
    free = F.coalesce(free_track(c("seen"), F.coalesce("found", F.array().cast(of_shot.schema["found"].dataType)), c("place"), width), none)
    x = x.withColumn("track", F.when(c("targets").isNull(), free).otherwise(F.coalesce(as_rows(c("alone.track")), c("joint.track"), none)))
    x = x.withColumn("resolved", F.when(c("targets").isNotNull(), F.coalesce("complete", F.lit(False))))
    x = x.withColumn("reason", F.when(c("targets").isNotNull(), F.coalesce("error", F.when(c("one") | c("several"), c("reason")).otherwise("insufficient_required_participants"))))

    # faces of the one that is followed bound the crop
    protected = c("subject").isin("woman", "man") & (c("role") == "primary")
    followed_one = c("one") & F.coalesce("resolved", F.lit(False))
    head = lambda b: F.struct(b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("w"), (b["h"] * 0.45).alias("h"))

    def held(b: Column) -> Column:
        here = lambda of: F.filter(of, lambda f: f["sample"] == b["sample"])
        others = F.get(F.filter("seen", lambda s: s["sample"] == b["sample"]), 0)["boxes"]
        face = let(others, lambda others: fa.bound_face(b, here("faces"), others))
        region = F.coalesce(face, head(b))
        return let(region, lambda region: F.struct(region.alias("region"), legal_interval(region, width, crop).alias("legal")))

    x = x.withColumn("held", F.when(protected & followed_one, F.transform(c("alone.track"), held)))
    unbounded = F.when(c("held").isNotNull(), F.exists("held", lambda h: ~h["legal"]["fits"])).otherwise(size(c("seen")) > 0)
    x = x.withColumn("face_review", protected & c("one") & F.coalesce(unbounded, F.lit(False))).withColumn("face_bounded", c("held").isNotNull())
    anchor = lambda b: F.greatest(F.lit(0.0), F.least(F.lit(width - crop), b["x"] + b["w"] / 2 - crop / 2))
    null = F.lit(None).cast("double")

    def row(b: Column, i: Column) -> Column:
        return let(F.get("held", i), lambda h: bounded(b, h))

    def bounded(b: Column, h: Column) -> Column:
        wish = F.when(h.isNotNull(), anchor(h["region"])).otherwise(anchor(b)) if strategy == "face_priority" else anchor(b)
        low, high = (F.when(h["legal"]["fits"], h["legal"][k]).when(h.isNotNull(), F.lit(v)).otherwise(null) for k, v in (("low", 0.0), ("high", width - crop)))
        return F.struct(b["t"].alias("t"), wish.alias("x"), low.alias("low"), high.alias("high"))

    x = x.withColumn("rows", F.transform("track", row)).withColumn("focus", union_box(c("track")))

    # what must stay together
    whole = F.transform("found", lambda b: F.struct(*[b[k].alias(k) for k in _BOX]))
    together = c("preserve") if strategy != "interaction_aware" else F.lit(True)
    everybody = together & (size(c("found")) > 0) & ~(c("targets").isNotNull() & c("several"))
    first = F.when(everybody, union_box(whole)).otherwise(c("focus"))
    parts = F.array_compact(F.concat(F.array(first), F.transform("regions", lambda r: F.struct(*[r[k].cast("double").alias(k) for k in _BOX]))))
    x = x.withColumn("required", union_box(parts))
    action = size(c("regions")) > 0
    fits = c("required").isNotNull() & (c("required.w") <= crop * (1 - 2 * SAFE))
    how = F.when(fits & (c("preserve") | action | (size(c("track")) == 0)), "composition").when(size(c("track")) > 0, "track").otherwise("fallback")
    x = x.withColumns({"how": how, "crop": F.lit(crop), "start": c("start").cast("double"), "end": c("end").cast("double"), "impossible": F.coalesce(~fits & c("required").isNotNull() & (c("preserve") | action), F.lit(False))})
    x = geo.smoothed(x).withColumnRenamed("anchors", "moving")
    side = F.when(F.lower("position") == "left", 0.0).when(F.lower("position") == "right", width - crop).otherwise(float(max(0, (int(width) - int(crop)) // 2)))
    still = lambda v: F.array(F.struct(c("start").alias("t"), v.alias("x")))
    x = x.withColumn("anchors", F.when(c("how") == "composition", still(anchor(c("required")))).when(c("how") == "track", c("moving")).otherwise(still(side)))
    unresolved, failed = c("person") & c("focus").isNull(), c("person") & c("targets").isNotNull() & ~c("resolved")
    mode = F.when(c("targets").isNotNull() & c("one"), "semantic_bound_geometry").when(c("targets").isNotNull() & c("several"), "semantic_bound_multi_geometry").otherwise("bounded_linear")
    return x.select(
        *_SHOT, mode.alias("mode"), "locals", F.when(c("person"), c("resolved")).alias("bound"), "reason", "track", "focus", "required", "preserve", "how", "anchors", let(F.array_sort(F.transform("anchors", lambda a: a["x"])), geo.median_of).alias("x"),
        "crop", "face_bounded", "face_review", "impossible", (c("impossible") | unresolved | F.coalesce(failed, F.lit(False)) | c("face_review") | ~c("directed")).alias("review"), (~action | c("required").isNotNull()).alias("action_kept"),
    )
