"""Queries over consolidated maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.operators import consolidate as co
from cutlight.operators import narrative as nv
from cutlight.plans.review import seam_choice
from cutlight.registry import SQL, query
from cutlight.session import cut

_HEAD, _, _TAIL = SQL["g11_seam_choice"].rpartition("\nSELECT movie_id, chunk, \"at\" AS seam")
_ITEMS = "STRUCT(f BIGINT, l BIGINT, c BIGINT, s BIGINT, cf BIGINT, cl BIGINT, en BOOLEAN)[]"
_FOLD = f"""{_HEAD},
sm AS (SELECT movie_id, chunk, "at" AS seam{_TAIL}),
it AS (SELECT r.movie_id, r.chunk, list(struct_pack(f := CAST(f AS BIGINT), l := CAST("at" AS BIGINT), c := CAST(r.chunk AS BIGINT), s := CAST(n AS BIGINT), cf := CAST(sp.lo AS BIGINT), cl := CAST(sp.hi AS BIGINT), en := f % 4 = 0) ORDER BY f) AS items FROM resp r JOIN sp ON sp.movie_id = r.movie_id AND sp.chunk = r.chunk GROUP BY ALL),
ix AS MATERIALIZED (SELECT it.movie_id, it.chunk, items, row_number() OVER w AS i, lag(it.chunk) OVER w AS lft, greatest(lo, lag(lo) OVER w) AS low, least(hi, lag(hi) OVER w) AS high FROM it JOIN sp ON sp.movie_id = it.movie_id AND sp.chunk = it.chunk WINDOW w AS (PARTITION BY it.movie_id ORDER BY it.chunk)),
iy AS MATERIALIZED (SELECT ix.movie_id, i, items, CAST(CASE WHEN low = high THEN low WHEN low < high THEN seam END AS BIGINT) AS seam FROM ix LEFT JOIN sm ON sm.movie_id = ix.movie_id AND sm.chunk = ix.lft),
fo(movie_id, i, kept) AS (SELECT movie_id, i, CAST(list_sort(items) AS {_ITEMS}) FROM iy WHERE i = 1
 UNION ALL SELECT movie_id, i, CAST(list_sort(CASE WHEN seam IS NULL THEN list_concat(kept, items) WHEN len(list_filter(list_concat(kept, items), lambda x: x.l = seam AND x.en)) > 0 THEN list_concat(list_concat(list_filter(kept, lambda x: x.l <= seam), list_filter(items, lambda x: x.f > seam)),
   list_concat(list_transform(list_filter(kept, lambda x: x.f <= seam AND seam < x.l), lambda x: struct_pack(f := x.f, l := seam, c := x.c, s := x.s, cf := x.cf, cl := x.cl, en := x.en)), list_transform(list_filter(items, lambda x: x.f <= seam AND seam < x.l), lambda x: struct_pack(f := seam + 1, l := x.l, c := x.c, s := x.s, cf := x.cf, cl := x.cl, en := x.en))))
   WHEN br IS NULL THEN list_concat(list_filter(kept, lambda x: x.l <= seam), list_filter(items, lambda x: x.f > seam))
   ELSE list_append(list_filter(list_concat(list_filter(kept, lambda x: x.l <= seam), list_filter(items, lambda x: x.f > seam)), lambda x: NOT (x.f <= br.l AND br.f <= x.l)), br) END) AS {_ITEMS})
 FROM (SELECT iy.movie_id, iy.i, kept, items, seam, list_sort(list_transform(list_filter(list_concat(kept, items), lambda x: x.f <= seam AND seam < x.l), lambda x: struct_pack(a := -least(x.f - x.cf, x.cl - x.l), d := x.f - x.l, e := x.c, g := x.s, x := x)))[1].x AS br FROM fo JOIN iy ON iy.movie_id = fo.movie_id AND iy.i = fo.i + 1)),
last_ AS (SELECT fo.movie_id, unnest(kept) AS k, generate_subscripts(kept, 1) AS segment_no FROM fo JOIN (SELECT movie_id, max(i) AS n FROM iy GROUP BY movie_id) m ON m.movie_id = fo.movie_id AND m.n = fo.i)
"""


def _consolidated(spark: SparkSession, d: str) -> DataFrame:
    # both written once: seams and maps read them in many places
    cues = cut(fx.cues(spark, d).select("movie_id", "cue_ord", "start_s", "end_s"), "cues")
    c = cut(nv.chunk_cues(cues, 60.0, 10.0).select("movie_id", "chunk", "cue_ord"), "chunks")
    spans = c.groupBy("movie_id", "chunk").agg(F.min("cue_ord").alias("lo"), F.max("cue_ord").alias("hi"))
    s = c.groupBy("movie_id", "chunk", F.floor((F.col("cue_ord") + F.col("chunk")) / 5).alias("segment")).agg(F.min("cue_ord").alias("first"), F.max("cue_ord").alias("last")).join(spans, ["movie_id", "chunk"])
    s = s.select("movie_id", "chunk", "segment", "first", "last", F.col("lo").alias("chunk_first"), F.col("hi").alias("chunk_last"), (F.col("first") % 4 == 0).alias("ends_new"), F.lit(False).alias("starts_new"), F.lit(1).alias("known"), F.lit(0.5).alias("confidence"))
    return co.consolidate(s, co.seams(spans, seam_choice(cues, c)))


@query(_FOLD + "SELECT movie_id, segment_no, k.f AS first, k.l AS last, k.c AS chunk, k.s AS segment FROM last_")
def g12_reconciled_map(spark: SparkSession, d: str) -> DataFrame:
    return _consolidated(spark, d)


@query(_FOLD + ", c2 AS (SELECT movie_id, segment_no, k.f AS f, k.l AS l, lag(k.l) OVER (PARTITION BY movie_id ORDER BY segment_no) AS before FROM last_) SELECT movie_id, count(*) AS segments, CAST(sum(l - f + 1) AS BIGINT) AS cues, count(*) FILTER (f > before + 1) AS gaps, count(*) FILTER (f <= before) AS overlaps FROM c2 GROUP BY movie_id")
def g13_consolidation_report(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    before = F.lag("last").over(Window.partitionBy("movie_id").orderBy("segment_no"))
    x = _consolidated(spark, d).withColumn("before", before)
    return x.groupBy("movie_id").agg(F.count(F.lit(1)).alias("segments"), F.sum(F.col("last") - F.col("first") + 1).alias("cues"), F.count_if(F.col("first") > F.col("before") + 1).alias("gaps"), F.count_if(F.col("first") <= F.col("before")).alias("overlaps"))
