"""Geometry over detection tables: boxes of persons in sampled frames, and crops that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.functions.columns import iou
from cutlight.session import shuffled

SEVERITY = ("PASS", "SOURCE_LIMIT", "AMBIGUOUS", "REPAIR", "ERROR")


def number_persons(boxes: DataFrame) -> DataFrame:
    """boxes with label P1, P2, ... by centre from left to right, then top to bottom, then falling confidence; boxes of a pixel or less are left out."""
    cx, cy = F.col("x") + F.col("w") / 2, F.col("y") + F.col("h") / 2
    by = Window.partitionBy("movie_id", "shot_id", "sample").orderBy(cx, cy, F.desc("confidence"), "person")
    return boxes.where((F.col("w") > 1) & (F.col("h") > 1)).withColumn("label", F.concat(F.lit("P"), F.row_number().over(by).cast("string")))


def position(boxes: DataFrame, width: float) -> DataFrame:
    """boxes with cx (share of the width) and where: left up to 40 %, right from 60 %, else center."""
    cx = (F.col("x") + F.col("w") / 2) / width
    return boxes.withColumn("cx", cx).withColumn("where", F.when(F.col("cx") < 0.4, "left").when(F.col("cx") > 0.6, "right").otherwise("center"))


def overlapping_pairs(boxes: DataFrame, least: float) -> DataFrame:
    """Pairs of persons of a frame whose boxes overlap by at least so much: person_a, person_b, iou."""
    box = lambda c: F.struct("x", "y", "w", "h").alias(c)
    keys = ["movie_id", "shot_id", "sample"]
    a = boxes.select(*keys, F.col("person").alias("person_a"), box("a"))
    b = boxes.select(*keys, F.col("person").alias("person_b"), box("b"))
    x = a.join(shuffled(b), keys).where("person_a < person_b").withColumn("iou", iou(F.col("a"), F.col("b")))
    return x.where(F.col("iou") >= least).select(*keys, "person_a", "person_b", "iou")


def crop_interval(x: Column, w: Column, margin: Column, crop: float, width: float) -> Column:
    """struct(low, high, limited): where a crop may begin so that a box with its margin is inside; limited: the source is too narrow for it."""
    low, high = F.greatest(F.lit(0.0), x + w + margin - crop), F.least(F.lit(width - crop), x - margin)
    return F.struct(F.least(low, F.lit(width - crop)).alias("low"), F.greatest(high, F.lit(0.0)).alias("high"), ((low > high) | (x - margin < 0) | (x + w + margin > width)).alias("limited"))


def required_margin(w: Column, share: float = 0.12, least: float = 8.0) -> Column:
    return F.greatest(w * share, F.lit(least))


def crop_width(height: Column, width: Column) -> Column:
    """Width of a 3:4 crop of full height, even, at most the frame's."""
    return F.least(F.floor(height * 3 / 4 / 2) * 2, width)


def crop_start(cx: Column, crop: Column, width: Column) -> Column:
    """Left edge, to a whole pixel, of a crop around a centre, kept inside the frame."""
    return F.floor(F.greatest(F.lit(0.0), F.least(width - crop, cx - crop / 2)) + 0.5)


def worst(samples: DataFrame, keys: list[str]) -> DataFrame:
    """The worst state of each group, and all its reasons in order. samples: keys, state, reasons."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), F.col("state"))
    g = samples.groupBy(*keys).agg(F.max_by("state", rank).alias("state"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("reasons")))).alias("reasons"))
    return g


def persistent_overlay(regions: DataFrame, area: float = 0.05, from_y: float = 0.55, least: int = 3) -> DataFrame:
    """Events in which so many samples hold an invasive region: movie_id, event, samples, decision. regions: movie_id, event, sample, area, y."""
    bad = (F.col("area") >= area) & (F.col("y") >= from_y)
    per = regions.groupBy("movie_id", "event", "sample").agg(F.max(bad.cast("int")).alias("hit"))
    return per.groupBy("movie_id", "event").agg(F.sum("hit").alias("samples")).withColumn("decision", F.when(F.col("samples") >= least, "REJECT").otherwise("PASS"))


def editorial_geometry(boxes: DataFrame, crop: DataFrame, keys: tuple[str, ...] = ("movie_id", "shot_id"), jump: float = 0.15) -> DataFrame:
    """Per target of a shot (keys): samples, visible (share with the person inside the crop), center (median distance from its middle), occupancy, jumps.

    boxes: one box of a target a sample; crop: movie_id, shot_id, left, width.
    """
    by = Window.partitionBy(*keys).orderBy("sample")
    x = boxes.join(shuffled(crop), ["movie_id", "shot_id"])
    x = x.withColumn("cx", (F.col("x") + F.col("w") / 2 - F.col("left")) / F.col("width"))
    x = x.withColumn("inside", (F.col("x") >= F.col("left")) & (F.col("x") + F.col("w") <= F.col("left") + F.col("width"))).withColumn("moved", F.abs(F.col("cx") - F.lag("cx").over(by)))
    return x.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"), F.avg(F.col("inside").cast("double")).alias("visible"), F.median(F.abs(F.col("cx") - 0.5)).alias("center"), F.avg(F.col("w") / F.col("width")).alias("occupancy"), F.count_if(F.col("moved") > jump).alias("jumps"))


def median_of(values: Column) -> Column:
    """Median of a sorted array of numbers; null if it is empty."""
    n = F.size(values)
    return (F.get(values, F.floor((n + 1) / 2).cast("int") - 1) + F.get(values, F.floor(n / 2).cast("int"))) / 2


def smoothed(g: DataFrame, dead: float = 0.06, speed: float = 0.08) -> DataFrame:
    """g with anchors: array of struct(t, x).

    g: rows (array of struct(t, x, low, high) in time: what is preferred, and the legal interval), crop (its width), start and end of the shot or
    null. Preferences are brought into their intervals first. If they differ by less than the dead zone (share of crop) and one place is
    legal for all, that place, nearest to their median, is the only anchor. Else within the dead zone a crop stays, beyond it
    moves at most speed * crop a second, and the interval wins over both. Each step begins where the last one ended, so it is a fold
    over a shot. A start before the first anchor and an end behind the last one have anchors of their own. Where low and high are
    null in all rows nothing is bounded, and the first anchor moves to the start. No rows give no anchors.
    """
    into = lambda v, r: F.greatest(r["low"], F.least(r["high"], v))
    lo, hi = F.array_max(F.transform("rows", lambda r: r["low"])), F.array_min(F.transform("rows", lambda r: r["high"]))
    g = g.withColumns({"sm_lo": lo, "sm_hi": hi, "sm_raw": F.array_sort(F.transform("rows", lambda r: into(r["x"], r)))})
    still = (F.array_max("sm_raw") - F.array_min("sm_raw") < F.col("crop") * dead) & F.coalesce(F.col("sm_lo") <= F.col("sm_hi"), F.lit(True))
    first, last = F.get("rows", 0), F.element_at("rows", F.when(F.size("rows") > 0, F.lit(-1)))
    kind = "struct<t: double, x: double, out: array<struct<t: double, x: double>>>"

    def step(s: Column, r: Column) -> Column:
        most = speed * F.col("crop") * F.greatest(F.lit(0.0), r["t"] - s["t"])
        wish = into(r["x"], r)
        wish = F.when(F.abs(wish - s["x"]) < F.col("crop") * dead, s["x"]).otherwise(wish)
        x = F.when(s["t"].isNull(), into(r["x"], r)).otherwise(into(F.greatest(s["x"] - most, F.least(s["x"] + most, wish)), r))
        return F.struct(r["t"].alias("t"), x.alias("x"), F.concat(s["out"], F.array(F.struct(r["t"].alias("t"), x.alias("x")))).alias("out"))

    seed = F.from_json(F.lit('{"out":[]}'), kind)
    g = g.withColumn("sm_out", F.when(~still, F.aggregate("rows", seed, step)["out"]))
    at = lambda t, x: F.struct(t.alias("t"), x.alias("x"))
    none = F.array().cast("array<struct<t:double,x:double>>")
    free, begin = F.col("sm_lo").isNull(), F.get("sm_out", 0)["x"]
    before = F.when(F.col("start") < first["t"], F.array(at(F.col("start"), begin))).otherwise(none)
    after = F.when(F.col("end") > last["t"], F.array(at(F.col("end"), into(F.element_at("sm_out", F.when(F.size("sm_out") > 0, F.lit(-1)))["x"], last)))).otherwise(none)
    body = F.when(free, F.concat(F.array(at(F.coalesce("start", first["t"]), begin)), F.slice("sm_out", 2, F.greatest(F.size("sm_out"), F.lit(0))))).otherwise(F.concat(before, F.col("sm_out")))
    one = F.array(at(F.coalesce("start", first["t"]), F.greatest(F.col("sm_lo"), F.least(F.col("sm_hi"), median_of(F.col("sm_raw"))))))
    anchors = F.when(F.coalesce(F.size("rows"), F.lit(0)) <= 0, none).when(still, one).otherwise(F.concat(body, after))
    return g.withColumn("anchors", anchors).drop("sm_lo", "sm_hi", "sm_raw", "sm_out")


def smooth_anchors(anchors: DataFrame, keys: list[str], dead: float = 0.06, speed: float = 0.08) -> DataFrame:
    """Anchors smoothed in time, as smoothed() does: keys, t, x. anchors: keys, t, x, low, high, crop, start, end."""
    row = F.struct(*[F.col(c).cast("double").alias(c) for c in ("t", "x", "low", "high")])
    g = anchors.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("rows"), F.min("crop").cast("double").alias("crop"), F.min("start").cast("double").alias("start"), F.max("end").cast("double").alias("end"))
    return smoothed(g, dead, speed).select(*keys, F.explode("anchors").alias("z")).select(*keys, "z.t", "z.x")
