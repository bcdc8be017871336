"""Editorial beats: the best split of a scene run into parts, scored by length, speech and continuity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.operators.review import optimal_partition
from cutlight.operators.shots import EDGE_COLUMNS, continuity

LONGEST = 20.0


def runs(shots: DataFrame, longest: float = LONGEST) -> DataFrame:
    """Scene runs of shots (as for adjacent_edges, with start_s, end_s, role, alone): movie_id, run, p (place in the run, from 1), and the shot.

    A shot longer than any beat belongs to no run and ends the one before it.
    """
    by = Window.partitionBy("movie_id").orderBy("shot_ord")
    x = continuity(shots.withColumns({f"n_{c}": F.lead(c).over(by) for c in EDGE_COLUMNS}))
    x = x.select("movie_id", "shot_ord", "shot_id", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("d"), "role", "alone", F.when(F.col("n_shot_id").isNotNull(), F.col("merge")).otherwise(False).alias("merge"), "reasons")
    goes_on = F.coalesce(F.lag("merge").over(by), F.lit(False)) & (F.lag("d").over(by) <= longest) & (F.col("d") <= longest)
    x = x.withColumn("run", F.sum(F.when(goes_on, 0).otherwise(1)).over(by)).where(F.col("d") <= longest)
    return x.withColumn("p", F.row_number().over(Window.partitionBy("movie_id", "run").orderBy("shot_ord")).cast("bigint"))


def beat_score(d: Column, n: Column, short: Column, talk: Column, alone: Column) -> Column:
    """Score of a part of n shots and d seconds; short: one is under 4.5 s; talk: a speaker and a listener are neighbours (fixed values)."""
    base = F.when(d < 4.5, -12.0).when((d >= 5) & (d <= 9), 10.0).when(d <= 12, 7.0).when(d <= 18, 3.0).otherwise(-2.0)
    add = lambda cond, x: F.when(cond, x).otherwise(0.0)
    return base + 3.0 * (n - 1) + add(talk, 12.0) + add(short & (n > 1), 6.0) + add((n == 1) & (d >= 8) & (d <= 12), 7.0) + add((n == 1) & (d < 4.5) & alone, 20.0) + add((d > 18) & ~talk, -8.0)


def beat_scores(rows: DataFrame, longest: float = LONGEST) -> DataFrame:
    """movie_id, run, i, j, score of every part i..j of a run (from runs) that is no longer than longest; a window of that length bounds them."""
    ahead = Window.partitionBy("movie_id", "run").orderBy(F.floor(F.col("start_s") * 1000)).rangeBetween(0, int(longest * 1000))
    near = F.sort_array(F.collect_list(F.struct("p", "end_s", "d", "role")).over(ahead))
    x = rows.withColumn("near", F.filter(near, lambda r: (r["p"] >= F.col("p")) & (r["end_s"] - F.col("start_s") <= longest))).where(F.size("near") > 0)

    def part(last: Column, n: Column) -> Column:
        own = F.slice("near", F.lit(1), n + 1)
        pairs = F.zip_with(F.slice("near", F.lit(1), n), F.slice("near", F.lit(2), n), lambda a, b: ((a["role"] == "speaker") & (b["role"] == "listener")) | ((a["role"] == "listener") & (b["role"] == "speaker")))
        return F.struct(last["p"].alias("j"), beat_score(last["end_s"] - F.col("start_s"), n + 1, F.exists(own, lambda r: r["d"] < 4.5), F.exists(pairs, lambda p: p), F.col("alone")).alias("score"))

    return x.select("movie_id", "run", F.col("p").alias("i"), F.explode(F.transform("near", part)).alias("s")).select("movie_id", "run", "i", "s.j", "s.score")


def beats(rows: DataFrame, longest: float = LONGEST) -> DataFrame:
    """The beats of each run: movie_id, run, part_start, part_end, start_s, end_s, shot_ids, reasons (of the joins inside, sorted)."""
    parts = optimal_partition(rows, beat_scores(rows, longest))
    x = rows.join(parts, ["movie_id", "run"]).where((F.col("p") >= F.col("part_start")) & (F.col("p") <= F.col("part_end")))
    inner = F.when(F.col("p") < F.col("part_end"), F.col("reasons")).otherwise(F.array().cast("array<string>"))
    g = x.groupBy("movie_id", "run", "part_start", "part_end").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.sort_array(F.collect_list(F.struct("p", "shot_id", inner.alias("why")))).alias("l"))
    why = F.array_sort(F.array_distinct(F.flatten(F.transform("l", lambda r: r["why"]))))
    return g.select("movie_id", "run", "part_start", "part_end", "start_s", "end_s", F.transform("l", lambda r: r["shot_id"]).alias("shot_ids"), F.when(F.size(why) > 0, why).otherwise(F.array(F.lit("single_technical_shot"))).alias("reasons"))
