"""Joins of time ranges. Ranges are half-open, in seconds from the start of their title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.functions.columns import overlap

#: Seconds of a time bucket: ranges meet in the buckets that they touch.
BUCKET = 30.0


def _bucketed(df: DataFrame, start: Column, end: Column, size: float) -> DataFrame:
    first, last = F.floor(start / size), F.greatest(F.floor(start / size), F.ceil(end / size) - 1)
    return df.withColumn("_first", first).withColumn("_bucket", F.explode(F.sequence(first, last)))


def overlapping(left: DataFrame, right: DataFrame, pad: float = 0.0, size: float = BUCKET) -> DataFrame:
    """Pairs of rows of one title whose ranges overlap, the left range widened by pad on both sides.

    left and right have movie_id, start_s, end_s and otherwise different column names; the result has all of left's
    columns and right's under their names, right's range as other_start_s, other_end_s. An equi-join on title and time bucket; a
    pair that shares several buckets is kept in the first of them only.
    """
    a = _bucketed(left, F.col("start_s") - pad, F.col("end_s") + pad, size).withColumnRenamed("_first", "_a")
    names = {"start_s": "other_start_s", "end_s": "other_end_s"}
    b = _bucketed(right, F.col("start_s"), F.col("end_s"), size).withColumnRenamed("_first", "_b").withColumnsRenamed(names)
    both = a.join(b, ["movie_id", "_bucket"])
    once = F.col("_bucket") == F.greatest("_a", "_b")
    meets = (F.col("start_s") - pad < F.col("other_end_s")) & (F.col("other_start_s") < F.col("end_s") + pad)
    return both.where(once & meets).drop("_a", "_b", "_bucket")


def occupancy(ranges: DataFrame, cues: DataFrame, keys: list[str]) -> DataFrame:
    """ranges with overlap_s, the seconds that cues cover (a cue counts by itself), and occupancy, its share, at most 1."""
    met = overlapping(ranges.select("movie_id", *keys, "start_s", "end_s"), cues.select("movie_id", "start_s", "end_s"))
    seconds = overlap(F.col("start_s"), F.col("end_s"), F.col("other_start_s"), F.col("other_end_s"))
    sums = met.groupBy("movie_id", *keys).agg(F.sum(seconds).alias("overlap_s"))
    out = ranges.join(sums, ["movie_id", *keys], "left").withColumn("overlap_s", F.coalesce("overlap_s", F.lit(0.0)))
    return out.withColumn("occupancy", F.least(F.lit(1.0), F.try_divide("overlap_s", F.col("end_s") - F.col("start_s"))))


def overlapped_ids(ranges: DataFrame, others: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """movie_id, keys and ids: what overlaps each range, in the order of time; ranges that nothing overlaps have no ids."""
    met = overlapping(ranges.select("movie_id", *keys, "start_s", "end_s"), others.select("movie_id", id_col, "start_s", "end_s"))
    ids = met.groupBy("movie_id", *keys).agg(F.sort_array(F.collect_list(F.struct("other_start_s", id_col))).alias("_l"))
    ids = ids.withColumn("ids", F.transform("_l", lambda x: x[id_col])).drop("_l")
    out = ranges.select("movie_id", *keys).join(ids, ["movie_id", *keys], "left")
    return out.withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


def padded_context(ranges: DataFrame, cues: DataFrame, keys: list[str], pad: float = 5.0) -> DataFrame:
    """movie_id, keys, overlapping and padded: ids of the cues in a range, and in the range widened by pad."""
    met = overlapping(ranges.select("movie_id", *keys, "start_s", "end_s"), cues.select("movie_id", "cue_ord", "cue_id", "start_s", "end_s"), pad)
    inside = (F.col("start_s") < F.col("other_end_s")) & (F.col("other_start_s") < F.col("end_s"))
    got = met.groupBy("movie_id", *keys).agg(F.sort_array(F.collect_list(F.struct("cue_ord", "cue_id", inside.alias("inside")))).alias("_l"))
    got = got.withColumn("overlapping", F.transform(F.filter("_l", lambda x: x["inside"]), lambda x: x["cue_id"])).withColumn("padded", F.transform("_l", lambda x: x["cue_id"])).drop("_l")
    out = ranges.select("movie_id", *keys).join(got, ["movie_id", *keys], "left")
    none = F.array().cast("array<string>")
    return out.withColumn("overlapping", F.coalesce("overlapping", none)).withColumn("padded", F.coalesce("padded", none))


def nearest(points: DataFrame, rows: DataFrame, keys: list[str], at: str, t: str, tie: list[str]) -> DataFrame:
    """points (keys, at) with the row of rows (keys, t, ...) closest in time; of equals the first by tie.

    A row of rows can be the nearest of many points, a point meets the rows of its keys only.
    """
    met = points.join(rows, keys)
    best = F.struct(F.abs(F.col(at) - F.col(t)).alias("d"), *tie)
    rest = [c for c in rows.columns if c not in keys]
    got = met.groupBy(*keys, at).agg(F.min_by(F.struct(*rest), best).alias("_n"))
    return got.select(*keys, at, "_n.*")


def with_previous(df: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """df with previous_<column>: the value of the row before, in a title's order (null for the first)."""
    by = Window.partitionBy("movie_id").orderBy(*order)
    return df.withColumns({f"previous_{c}": F.lag(c).over(by) for c in columns})


def value_at(points: DataFrame, anchors: DataFrame, keys: list[str], t: str = "t", x: str = "x") -> DataFrame:
    """points (keys, t) with x, linear between the anchors (keys, t, x) before and after; beyond the ends the end's value."""
    all_ = points.select(*keys, F.col(t).alias("t"), F.lit(None).cast("double").alias("x"), F.lit(1).alias("_p")).unionByName(anchors.select(*keys, F.col(t).alias("t"), F.col(x).cast("double").alias("x"), F.lit(0).alias("_p")))
    by = Window.partitionBy(*keys).orderBy("t", "_p")
    a = F.when(F.col("_p") == 0, F.struct("t", "x"))
    before = F.last(a, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(a, ignorenulls=True).over(by.rowsBetween(0, Window.unboundedFollowing))
    met = all_.withColumn("_b", before).withColumn("_a", after).where("_p = 1")
    part = F.try_divide(F.col("t") - F.col("_b.t"), F.col("_a.t") - F.col("_b.t"))
    at = F.when(F.col("_b").isNull(), F.col("_a.x")).when(F.col("_a").isNull() | (F.col("_b.t") == F.col("t")), F.col("_b.x")).otherwise(F.col("_b.x") + (F.col("_a.x") - F.col("_b.x")) * part)
    return met.withColumn("x", at).select(*keys, "t", "x")
