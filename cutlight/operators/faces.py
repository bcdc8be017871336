"""Faces and targets: which face belongs to whom, whether a crop keeps it, and which box a directive means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.functions.columns import iou, let, let_all
from cutlight.operators.geometry import required_margin
from cutlight.session import shuffled

_KEYS = ["movie_id", "shot_id", "sample"]


def containment(inner: Column, outer: Column) -> Column:
    """Share of box inner (struct x, y, w, h) that lies in box outer."""
    w = F.greatest(F.lit(0.0), F.least(inner["x"] + inner["w"], outer["x"] + outer["w"]) - F.greatest(inner["x"], outer["x"]))
    h = F.greatest(F.lit(0.0), F.least(inner["y"] + inner["h"], outer["y"] + outer["h"]) - F.greatest(inner["y"], outer["y"]))
    return w * h / F.greatest(F.lit(1.0), inner["w"] * inner["h"])


def bind_faces(faces: DataFrame, persons: DataFrame) -> DataFrame:
    """The one face of each target: movie_id, shot_id, sample, target, face; targets with none or several have no row.

    faces: keys, face, box; persons: keys, person, box. A face belongs to a person if its centre is inside, within 0.8 of the height,
    it is no wider than 1.1 of the person, lies in the person by 0.8, and by 0.15 more than in any other of another place or width.
    """
    f, p = F.col("f"), F.col("p")
    x = faces.select(*_KEYS, "face", F.col("box").alias("f")).join(shuffled(persons.select(*_KEYS, "person", F.col("box").alias("p"))), _KEYS)
    x = x.withColumn("own", containment(f, p))
    cx, cy = f["x"] + f["w"] / 2, f["y"] + f["h"] / 2
    fits = (p["x"] <= cx) & (cx <= p["x"] + p["w"]) & (p["y"] <= cy) & (cy <= p["y"] + p["h"] * 0.8) & (f["w"] <= p["w"] * 1.1)
    all_ = x.groupBy(*_KEYS, "face").agg(F.collect_list(F.struct("p", "own")).alias("others"))  # persons of one frame: few
    x = x.where(fits & (F.col("own") >= 0.8)).join(shuffled(all_), [*_KEYS, "face"])
    rivals = F.transform(F.filter("others", lambda o: F.abs(o["p"]["x"] - p["x"]) + F.abs(o["p"]["w"] - p["w"]) > 2), lambda o: o["own"])
    x = x.where(F.coalesce(F.col("own") - F.array_max(rivals) >= 0.15, F.lit(True)))
    g = x.groupBy(*_KEYS, F.col("person").alias("target")).agg(F.count(F.lit(1)).alias("n"), F.min("face").alias("face"))
    return g.where("n = 1").drop("n")


def bound_face(person: Column, faces: Column, persons: Column) -> Column:
    """What bind_faces() says of one person (struct x, y, w, h) of a frame, in a row: the box of its one face, or null. faces: array of struct(face, box) and persons: array of boxes, of the frame."""

    def fits(f: Column) -> Column:
        cx, cy = f["x"] + f["w"] / 2, f["y"] + f["h"] / 2
        inside = (person["x"] <= cx) & (cx <= person["x"] + person["w"]) & (person["y"] <= cy) & (cy <= person["y"] + person["h"] * 0.8) & (f["w"] <= person["w"] * 1.1)
        rivals = F.filter(persons, lambda o: F.abs(o["x"] - person["x"]) + F.abs(o["w"] - person["w"]) > 2)
        alone = lambda own: (own >= 0.8) & F.coalesce(own - F.array_max(F.transform(rivals, lambda o: containment(f, o))) >= 0.15, F.lit(True))
        return inside & let(containment(f, person), alone)

    return let(F.filter(faces, lambda f: fits(f["box"])), lambda mine: F.when(F.size(mine) == 1, F.get(mine, 0)["box"]))


def assess_face(face: Column, crop_x: Column, crop: float, width: float, height: float, bound: Column) -> Column:
    """struct(decision, reason): does a crop keep a face (struct x, y, w, h, or null)?"""
    x, y, w, h = (face[c] for c in ("x", "y", "w", "h"))
    left, right = x - crop_x, crop_x + crop - x - w
    margin, need = F.least(left, right), required_margin(w)
    clipped = (x <= 1) | (x + w >= width - 1) | (y <= 1) | (y + h >= height - 1)
    fits = (w + 2 * need <= crop) & (x >= need) & (x + w <= width - need)
    pair = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    return (
        F.when(~bound, pair("AMBIGUOUS", "semantic_target_binding_unresolved")).when(face.isNull(), pair("AMBIGUOUS", "face_detection_inconclusive")).when(clipped, pair("SOURCE_LIMIT", "source_face_already_clipped"))
        .when(~fits, pair("SOURCE_LIMIT", "face_exceeds_vertical_crop")).when(margin < 0, pair("REPAIR", "face_partially_clipped_but_source_has_room"))
        .when((margin < need) & (left < right), pair("REPAIR", "primary_face_too_close_to_left_edge")).when(margin < need, pair("REPAIR", "primary_face_too_close_to_right_edge")).otherwise(pair("PASS", "primary_face_safe"))
    )


def choose_target(boxes: DataFrame, wanted: DataFrame, width: float) -> DataFrame:
    """The box a directive means: keys, person. boxes: keys, person, x, w, confidence, foreground, face; wanted: keys, where.

    Boxes behind the foreground come first, among them those with a face. One left: that one. Otherwise the nearest to the
    wanted quarter of the width, of equals the surest; without a wanted side nobody.
    """
    by = Window.partitionBy(*_KEYS)
    x = boxes.withColumn("_b", F.max(~F.col("foreground")).over(by)).where(~F.col("_b") | ~F.col("foreground"))
    x = x.withColumn("_f", F.max("face").over(by)).where(~F.col("_f") | F.col("face")).withColumn("_n", F.count(F.lit(1)).over(by))
    x = x.join(shuffled(wanted.select(*_KEYS, "where")), _KEYS)
    at = F.when(F.col("where") == "left", 0.25).when(F.col("where") == "center", 0.5).when(F.col("where") == "right", 0.75) * width
    x = x.withColumn("_d", F.abs(F.col("x") + F.col("w") / 2 - at)).where((F.col("_n") == 1) | F.col("_d").isNotNull())
    return x.groupBy(*_KEYS).agg(F.min_by("person", F.struct(F.coalesce("_d", F.lit(0.0)), -F.col("confidence"), "person")).alias("person"))


def resolve_identities(identities: DataFrame, persons: DataFrame, most: float = 0.95, bare: bool = False) -> DataFrame:
    """keys, identity, local, reason: the person that an id (owner:P1) names in its shot, or why it names nobody.

    identities: movie_id, shot_id, sample, identity; persons: keys, label, x, y, w, h. bare: an id without owner (P1) is of its shot.
    """
    # they meet by shot: where both are dealt by it already, no row of a sample is shuffled
    shot = ["movie_id", "shot_id"]
    all_ = persons.groupBy(*shot).agg(F.collect_list(F.struct("sample", "label", F.struct("x", "y", "w", "h").alias("box"))).alias("_all"))
    x = identities.join(shuffled(all_), shot, "left").withColumn("all", F.filter("_all", lambda p: p["sample"] == F.col("sample")))
    return x.withColumn("who", resolved_identity(F.col("identity"), F.col("all"), most, bare)).select(*_KEYS, "identity", "who.local", "who.reason")


def resolved_identity(identity: Column, persons: Column, most: float = 0.95, bare: bool = False) -> Column:
    """struct(local, reason) of an id in the row of its shot (shot_id); persons: array of struct(label, box), those of the frame."""
    pattern = r"^([A-Za-z0-9_][A-Za-z0-9_.-]*):(P[1-9][0-9]*)$"
    said = F.when(identity.rlike(r"^P[1-9][0-9]*$"), F.concat_ws(":", F.col("shot_id"), identity)).otherwise(identity) if bare else identity

    def judge(owner: Column, label: Column) -> Column:
        def find(mine: Column) -> Column:
            box, n = F.get(mine, 0)["box"], F.coalesce(F.size(mine), F.lit(0))
            twin = F.exists(persons, lambda p: (p["label"] != label) & (iou(p["box"], box) >= most))
            return (
                F.when(F.coalesce(owner, F.lit("")) == "", "malformed_person_identity").when(owner != F.col("shot_id"), "cross_shot_person_identity").when(n > 1, "ambiguous_local_target").when(n < 1, "missing_local_target")
                .when((box["w"] <= 1) | (box["h"] <= 1), "unusable_reference_geometry").when(twin, "ambiguous_reference_geometry")
            )

        reason = let(F.filter(persons, lambda p: p["label"] == label), find)
        return let(reason, lambda reason: F.struct(F.when(reason.isNull(), label).alias("local"), reason.alias("reason")))

    return let(said, lambda said: let_all({"owner": F.regexp_extract(said, pattern, 1), "label": F.regexp_extract(said, pattern, 2)}, judge))


def boundary_holds(target: Column, outside: Column) -> Column:
    """Is a frame at an export's end as near to its source frame as to the one outside, with a margin for still pictures?"""
    return F.when(target.isNull(), False).when(outside.isNull(), True).otherwise(~(outside + F.greatest(F.lit(2.0), target * 0.2) < target))


def best_thumbnail(frames: DataFrame, keys: list[str]) -> DataFrame:
    """keys, frame: the sharpest of the sampled frames (keys, frame, sharpness); of equals the first."""
    return frames.groupBy(*keys).agg(F.min_by("frame", F.struct(-F.col("sharpness"), "frame")).alias("frame"))


def people_summary(people: Column) -> Column:
    """struct(people_count, composition, presentation, primary) of array<struct<presentation, role>>."""
    n = F.size(people)
    said = F.array_distinct(F.array_compact(F.transform(people, lambda p: p["presentation"])))
    primary = F.coalesce(F.get(F.filter(people, lambda p: p["role"] == "primary"), 0), F.get(people, 0))
    comp = F.when(n == 0, "not_applicable").when(n == 1, "single_subject").when(n == 2, "two_person").otherwise("group")
    return F.struct(n.cast("bigint").alias("people_count"), comp.alias("composition"), F.when(F.size(said) == 1, F.get(said, 0)).when(F.size(said) > 1, "mixed").alias("presentation"), primary["presentation"].alias("primary"))
