"""Queries over editorial beats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.operators import beats as bt
from cutlight.plans.shots import _shots_with_context, _with_edges
from cutlight.registry import query
from cutlight.session import cut

_ROLES = ("speaker", "listener", "none")
_BEATS = """, b0 AS (SELECT ctx.movie_id, ctx.shot_ord, ctx.shot_id, start_s, end_s, end_s - start_s AS d, k, coalesce(merge, false) AS m, coalesce(reasons, []::VARCHAR[]) AS reasons FROM ctx LEFT JOIN edge ON edge.movie_id = ctx.movie_id AND edge.shot_id = ctx.shot_id),
b1 AS (SELECT *, coalesce(lag(m) OVER w, false) AND lag(d) OVER w <= 20 AND d <= 20 AS goes FROM b0 WINDOW w AS (PARTITION BY movie_id ORDER BY shot_ord)),
b2 AS (SELECT *, CAST(sum(CASE WHEN goes THEN 0 ELSE 1 END) OVER (PARTITION BY movie_id ORDER BY shot_ord) AS BIGINT) AS run FROM b1),
b3 AS MATERIALIZED (SELECT *, row_number() OVER w AS p, coalesce(k % 3 < 2 AND lead(k % 3) OVER w = 1 - k % 3, false) AS talk FROM b2 WHERE d <= 20 WINDOW w AS (PARTITION BY movie_id, run ORDER BY shot_ord)),
b4 AS (SELECT a.movie_id, a.run, a.p AS i, b.p AS j, any_value(b.end_s - a.start_s) AS d, any_value(a.k = 7) AS alone, bool_or(m.d < 4.5) AS short, bool_or(m.talk AND m.p < b.p) AS talk, b.p - a.p AS more FROM b3 a JOIN b3 b ON b.movie_id = a.movie_id AND b.run = a.run AND b.p >= a.p AND b.end_s - a.start_s <= 20 JOIN b3 m ON m.movie_id = a.movie_id AND m.run = a.run AND m.p BETWEEN a.p AND b.p GROUP BY ALL),
sc AS MATERIALIZED (SELECT movie_id, run, i, j, CAST(CASE WHEN d < 4.5 THEN -12 WHEN d >= 5 AND d <= 9 THEN 10 WHEN d <= 12 THEN 7 WHEN d <= 18 THEN 3 ELSE -2 END + 3 * more + CASE WHEN talk THEN 12 ELSE 0 END + CASE WHEN short AND more > 0 THEN 6 ELSE 0 END + CASE WHEN more = 0 AND d >= 8 AND d <= 12 THEN 7 ELSE 0 END + CASE WHEN more = 0 AND d < 4.5 AND alone THEN 20 ELSE 0 END - CASE WHEN d > 18 AND NOT talk THEN 8 ELSE 0 END AS DOUBLE) AS s FROM b4)
"""
_SPLIT = """, bn AS (SELECT movie_id, run, max(p) AS n FROM b3 GROUP BY ALL),
bf(movie_id, run, e, best) AS (SELECT movie_id, run, 0::BIGINT, [{'t': 0.0::DOUBLE, 'i': 0::BIGINT}] FROM bn
 UNION ALL SELECT bf.movie_id, bf.run, bf.e + 1, list_append(bf.best, (SELECT arg_min(struct_pack(t := bf.best[sc.i].t + sc.s, i := sc.i), (-(bf.best[sc.i].t + sc.s), sc.i)) FROM sc WHERE sc.movie_id = bf.movie_id AND sc.run = bf.run AND sc.j = bf.e + 1)) FROM bf JOIN bn ON bn.movie_id = bf.movie_id AND bn.run = bf.run AND bf.e < bn.n),
bg(movie_id, run, i, j) AS (SELECT bf.movie_id, bf.run, bf.best[bn.n + 1].i, bn.n FROM bf JOIN bn ON bn.movie_id = bf.movie_id AND bn.run = bf.run AND bf.e = bn.n
 UNION ALL SELECT bg.movie_id, bg.run, bf.best[bg.i].i, bg.i - 1 FROM bg JOIN bn ON bn.movie_id = bg.movie_id AND bn.run = bg.run JOIN bf ON bf.movie_id = bg.movie_id AND bf.run = bg.run AND bf.e = bn.n WHERE bg.i > 1)
"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    x = _shots_with_context(spark, d).withColumn("role", fx.pick(_ROLES, F.col("k") % 3)).withColumn("alone", F.col("k") == 7)
    return cut(bt.runs(x), "runs")


@query(_with_edges(_BEATS + "SELECT movie_id, run, i, j, s AS score FROM sc"))
def g08_beat_scores(spark: SparkSession, d: str) -> DataFrame:
    return bt.beat_scores(_runs(spark, d))


@query(_with_edges(_BEATS + _SPLIT + "SELECT bg.movie_id, bg.run, i AS part_start, j AS part_end, round(min(start_s), 4) AS start_s, round(max(end_s), 4) AS end_s, list(shot_id ORDER BY p) AS shot_ids, CASE WHEN len(flatten(list(CASE WHEN p < j THEN reasons ELSE []::VARCHAR[] END))) > 0 THEN list_sort(list_distinct(flatten(list(CASE WHEN p < j THEN reasons ELSE []::VARCHAR[] END)))) ELSE ['single_technical_shot'] END AS reasons FROM bg JOIN b3 ON b3.movie_id = bg.movie_id AND b3.run = bg.run AND p BETWEEN i AND j GROUP BY ALL"))
def g10_editorial_beats(spark: SparkSession, d: str) -> DataFrame:
    x = bt.beats(_runs(spark, d))
    return x.withColumn("start_s", F.round("start_s", 4)).withColumn("end_s", F.round("end_s", 4))
