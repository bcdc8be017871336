"""One map of a title from the overlapping maps of its chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ITEM = "array<struct<first:bigint,last:bigint,chunk:bigint,segment:bigint,chunk_first:bigint,chunk_last:bigint,ends_new:boolean,starts_new:boolean,known:int,confidence:double>>"


def seams(spans: DataFrame, chosen: DataFrame) -> DataFrame:
    """movie_id, chunk (the right one of each two neighbours), seam: the chosen one, the only shared cue, or null where nothing is shared.

    spans: movie_id, chunk, lo, hi (first and last cue); chosen: movie_id, chunk (the left one), seam.
    """
    by = Window.partitionBy("movie_id").orderBy("chunk")
    x = spans.withColumns({"left": F.lag("chunk").over(by), "lo0": F.lag("lo").over(by), "hi0": F.lag("hi").over(by)}).where("left is not null")
    x = x.join(chosen.select("movie_id", F.col("chunk").alias("left"), "seam"), ["movie_id", "left"], "left")
    low, high = F.greatest("lo", "lo0"), F.least("hi", "hi0")
    return x.select("movie_id", "chunk", F.when(low == high, low).when(low < high, F.col("seam")).alias("seam"))


def consolidate(segments: DataFrame, seams_: DataFrame) -> DataFrame:
    """The consolidated map: movie_id, segment_no (from 1), first, last, chunk, segment.

    segments: movie_id and the fields of _ITEM; seams_: as seams gives them. Chunk by chunk, what crosses the seam is settled: at an explicit change both
    sides are cut at the seam; otherwise the crossing segment that lies deepest in its chunk, then the better known,
    surer and longer one, bridges the seam and drops what overlaps it. A gap joins the maps as they are. The left side is what was
    kept so far, so it is a fold over a title's chunks.
    """
    fields = [f.split(":")[0] for f in _ITEM.removeprefix("array<struct<").removesuffix(">>").split(",")]
    item = F.struct(*[F.col(f) for f in fields])
    chunks = segments.groupBy("movie_id", "chunk").agg(F.collect_list(item).cast(_ITEM).alias("items")).join(seams_, ["movie_id", "chunk"], "left")
    rows = chunks.groupBy("movie_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "seam", "items"))).alias("rows"))

    def clip(x: Column, first: Column, last: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), *[x[f].alias(f) for f in fields[2:]])

    def settle(s: Column) -> Column:
        """kept from struct(left, right, seam, cross)."""
        seam = s["seam"]
        crosses = lambda x: (x["first"] <= seam) & (seam < x["last"])
        new = lambda x: ((x["last"] == seam) & x["ends_new"]) | ((x["first"] == seam + 1) & x["starts_new"])
        apart = F.concat(F.filter(s["left"], lambda x: x["last"] <= seam), F.filter(s["right"], lambda x: x["first"] > seam))
        cut = F.concat(apart, F.transform(F.filter(s["left"], crosses), lambda x: clip(x, x["first"], seam)), F.transform(F.filter(s["right"], crosses), lambda x: clip(x, seam + 1, x["last"])))
        key = lambda x: F.struct((-F.least(x["first"] - x["chunk_first"], x["chunk_last"] - x["last"])).alias("a"), (-x["known"]).alias("b"), (-x["confidence"]).alias("c"), (x["first"] - x["last"]).alias("d"), x["chunk"].alias("e"), x["segment"].alias("f"), x.alias("x"))
        bridges = F.filter(F.array(F.array_min(F.transform(s["cross"], key))["x"]), lambda b: b.isNotNull())
        bridged = F.concat(F.filter(apart, lambda x: ~F.exists(bridges, lambda b: (x["first"] <= b["last"]) & (b["first"] <= x["last"]))), bridges)
        protected = F.exists(F.concat(s["left"], s["right"]), new)
        return F.when(seam.isNull(), F.concat(s["left"], s["right"])).when(protected, cut).otherwise(bridged)

    def step(kept: Column, r: Column) -> Column:
        crosses = lambda x: (x["first"] <= r["seam"]) & (r["seam"] < x["last"])
        cross = F.concat(F.filter(kept, crosses), F.filter(r["items"], crosses))
        one = F.array(F.struct(kept.alias("left"), r["items"].alias("right"), r["seam"].alias("seam"), cross.alias("cross")))
        return F.array_sort(F.get(F.transform(one, settle), 0))

    done = rows.withColumn("kept", F.aggregate("rows", F.array().cast(_ITEM), lambda kept, r: F.when(F.size(kept) == 0, F.array_sort(r["items"])).otherwise(step(kept, r))))
    return done.select("movie_id", F.posexplode("kept").alias("at", "k")).select("movie_id", (F.col("at") + 1).cast("bigint").alias("segment_no"), "k.first", "k.last", "k.chunk", "k.segment")
