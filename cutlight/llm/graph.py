"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cutlight.llm.scratch import materialise


def _star(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): attach every v to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the least node that the edges reach, for each node that some edge names.

    edges: columns src and dst of one orderable type, in any direction, repeated or not; null ends and loops are left
    out. Each round writes its edges to the shared folder, so the plan stays short and a lost executor costs one round.
    Rounds grow with the logarithm of the longest path, not with its length.
    """
    raw = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    now = materialise(raw.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = _star(large)
        small = down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        seen = Observation()
        marks = (F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30))).alias("s"))
        now = materialise(small.distinct().observe(seen, *marks), "edges")  # what the edges are is seen while they are written
        was, sign = sign, seen.get
        if was == sign:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
