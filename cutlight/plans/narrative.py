"""Queries over cues, chunks and segment maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.functions.columns import slug, tokens
from cutlight.operators import intervals as iv
from cutlight.operators import narrative as nv
from cutlight.registry import query

_r = lambda c, *more: F.round(c, 4).alias(c if not more else more[0])


def _durations(cues: DataFrame) -> DataFrame:
    return cues.groupBy("movie_id").agg((F.max("end_s") - 3 + F.col("movie_id") % 3 * 2).alias("duration_s"))


_DUR = "dur AS (SELECT movie_id, max(end_s) - 3 + movie_id % 3 * 2 AS duration_s FROM cu GROUP BY movie_id)"


@query(with_("SELECT movie_id, cue_ord, cue_id, round(start_s, 4) AS start_s, round(end_s, 4) AS end_s, trim(regexp_replace(regexp_replace(text, '</?(b|i|u|s|strike|font)(\\s[^>]*)?>', '', 'gi'), '\\s+', ' ', 'g'), ' ') AS clean FROM cu", "cu"))
def v02_clean_cue_text(spark: SparkSession, d: str) -> DataFrame:
    return fx.cues(spark, d).select("movie_id", "cue_ord", "cue_id", _r("start_s"), _r("end_s"), nv.clean_text(F.col("text")).alias("clean"))


@query(with_("""SELECT movie_id, count(*) AS cue_count, round(min_by(start_s, cue_ord), 4) AS first_start, round(max_by(end_s, cue_ord), 4) AS last_end, round(sum(end_s - start_s), 4) AS covered_s,
 round(avg(end_s - start_s), 4) AS average_s, round(coalesce(avg(g), 0), 4) AS average_gap_s, round(coalesce(max(g), 0), 4) AS maximum_gap_s
FROM (SELECT *, CASE WHEN lag(end_s) OVER w IS NOT NULL THEN greatest(0, start_s - lag(end_s) OVER w) END AS g FROM cu WINDOW w AS (PARTITION BY movie_id ORDER BY cue_ord)) GROUP BY movie_id""", "cu"))
def a01_cue_statistics(spark: SparkSession, d: str) -> DataFrame:
    x = nv.cue_statistics(fx.cues(spark, d))
    return x.select("movie_id", "cue_count", *[_r(c) for c in ("first_start", "last_end", "covered_s", "average_s", "average_gap_s", "maximum_gap_s")])


@query(with_("SELECT cu.movie_id, CASE WHEN max(end_s) > any_value(duration_s) + 2 THEN 'WARNING' ELSE 'OK' END AS status, 0::BIGINT AS n_errors, CASE WHEN max(end_s) > any_value(duration_s) + 2 THEN 1 ELSE 0 END AS n_warnings FROM cu JOIN dur USING (movie_id) GROUP BY cu.movie_id", "cu").replace("\nSELECT", f", {_DUR}\nSELECT", 1))
def v01_timeline_validation(spark: SparkSession, d: str) -> DataFrame:
    cues = fx.cues(spark, d)
    return nv.validate_timeline(cues, _durations(cues))


@query(with_("SELECT movie_id, n + 1 AS segment, CASE WHEN p < 0.10 THEN 'low' WHEN p < 0.35 THEN 'medium' ELSE 'high' END AS density FROM (SELECT movie_id, (cue_ord - 1) // 5 AS n, sum(end_s - start_s) / greatest(max(end_s) - min(start_s), 0.001) AS p FROM cu GROUP BY ALL)", "cu"))
def a05_dialogue_density(spark: SparkSession, d: str) -> DataFrame:
    x = fx.cues(spark, d).withColumn("segment", F.floor((F.col("cue_ord") - 1) / 5) + 1)
    return nv.density(x, ["movie_id", "segment"])


# windows of 60 s every 50 s, from a list of window numbers; then the lonely tail
_CHUNKS = """, win AS (
  SELECT movie_id, w, w * 50.0 AS a, least(w * 50.0 + 60, l) AS b FROM (SELECT movie_id, max(end_s) AS l FROM cu GROUP BY movie_id), unnest(range(0, CAST(ceil(l / 50) AS BIGINT))) t(w) WHERE w * 50.0 < l
), hit AS (SELECT win.movie_id, w, a, b, cue_ord FROM win JOIN cu ON cu.movie_id = win.movie_id AND cu.end_s > a AND cu.start_s < b),
per AS (SELECT movie_id, w, a, b, count(*) AS n, row_number() OVER (PARTITION BY movie_id ORDER BY w DESC) AS back, lead(b) OVER (PARTITION BY movie_id ORDER BY w DESC) AS pb FROM hit GROUP BY movie_id, w, a, b),
tail AS (SELECT movie_id, w, b FROM per WHERE back = 1 AND n = 1 AND pb IS NOT NULL AND b - pb <= 120),
fin AS (SELECT per.movie_id, per.w, per.a, CASE WHEN tail.b IS NOT NULL AND back = 2 THEN tail.b ELSE per.b END AS b, row_number() OVER (PARTITION BY per.movie_id ORDER BY per.w) AS chunk
  FROM per LEFT JOIN tail ON tail.movie_id = per.movie_id WHERE NOT (tail.w IS NOT NULL AND per.w = tail.w)),
chk AS (SELECT fin.movie_id, chunk, a AS start_s, b AS end_s, cue_ord FROM fin JOIN cu ON cu.movie_id = fin.movie_id AND cu.end_s > a AND cu.start_s < b)
"""


def _chunk_sql(body: str) -> str:
    head = with_("SELECT", "cu").removesuffix("\nSELECT")
    return head + _CHUNKS + body


@query(_chunk_sql("SELECT movie_id, chunk, round(start_s, 4) AS start_s, round(end_s, 4) AS end_s, count(*) AS n_cues, min(cue_ord) AS first_ord, max(cue_ord) AS last_ord FROM chk GROUP BY ALL"))
def w01_overlapping_chunks(spark: SparkSession, d: str) -> DataFrame:
    x = nv.chunk_cues(fx.cues(spark, d), 60.0, 10.0)
    return x.groupBy("movie_id", "chunk", _r("start_s"), _r("end_s")).agg(F.count(F.lit(1)).alias("n_cues"), F.min("cue_ord").alias("first_ord"), F.max("cue_ord").alias("last_ord"))


@query(_chunk_sql("SELECT movie_id, chunk, cue_ord FROM chk"))
def j06_chunk_membership(spark: SparkSession, d: str) -> DataFrame:
    return nv.chunk_cues(fx.cues(spark, d), 60.0, 10.0).select("movie_id", "chunk", "cue_ord")


@query(with_("SELECT sg.movie_id, segment_id, count(*) AS n_cues, list(cue_id ORDER BY cue_ord) AS cue_ids, round(min(cu.start_s), 4) AS start_s, round(max(cu.end_s), 4) AS end_s FROM sg JOIN cu ON cu.movie_id = sg.movie_id AND cue_ord BETWEEN first_ord AND last_ord GROUP BY sg.movie_id, segment_id", "sg"))
def j05_cue_range_expansion(spark: SparkSession, d: str) -> DataFrame:
    x = nv.expand_ranges(fx.segments(spark, d), fx.cues(spark, d), ["segment_id"])
    return x.select("movie_id", "segment_id", "n_cues", "cue_ids", _r("start_s"), _r("end_s"))


@query(with_("SELECT cu.movie_id, count(*) FILTER (h) AS assigned, count(*) FILTER (NOT h) AS unassigned FROM (SELECT movie_id, (cue_ord - 1) // 5 % 3 <> 0 AS h FROM cu) cu GROUP BY movie_id", "cu"))
def a20_cue_coverage(spark: SparkSession, d: str) -> DataFrame:
    some = fx.segments(spark, d).where(F.floor((F.col("first_ord") - 1) / 5) % 3 != 0)
    return nv.cue_coverage(fx.cues(spark, d), some)


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """Segments that chunks answer with: five cues each, cut differently in each chunk, every seventh shifted into the one before it."""
    c = nv.chunk_cues(fx.cues(spark, d), 60.0, 10.0)
    x = c.groupBy("movie_id", "chunk", F.floor((F.col("cue_ord") + F.col("chunk")) / 5).alias("n")).agg(F.min("cue_ord").alias("first_ord"), F.max("cue_ord").alias("last_ord"))
    bad = F.col("n") % 7 == 3
    return x.select("movie_id", "chunk", F.col("n").alias("ordinal"), F.when(bad, F.col("first_ord") - 1).otherwise(F.col("first_ord")).alias("first_ord"), F.when(F.col("n") % 11 == 5, F.col("last_ord") + 100000).otherwise(F.col("last_ord")).alias("last_ord"), F.when(F.col("n") % 2 == 0, "phase_change").alias("long_reason"))


_RESP = """, resp AS (SELECT movie_id, chunk, n AS ordinal, CASE WHEN n % 7 = 3 THEN f - 1 ELSE f END AS first_ord, CASE WHEN n % 11 = 5 THEN l + 100000 ELSE l END AS last_ord, CASE WHEN n % 2 = 0 THEN 'phase_change' END AS long_reason
  FROM (SELECT movie_id, chunk, (cue_ord + chunk) // 5 AS n, min(cue_ord) AS f, max(cue_ord) AS l FROM chk GROUP BY ALL))
"""


@query(_chunk_sql(_RESP + """SELECT movie_id, chunk, ordinal, list_filter([CASE WHEN s IS NULL OR e IS NULL THEN 'unknown_cue' END, CASE WHEN first_ord > last_ord THEN 'reversed' END, CASE WHEN first_ord <= reach THEN 'overlap_or_out_of_order' END, CASE WHEN e - s > 120 AND long_reason IS NULL THEN 'long_without_reason' END], lambda x: x IS NOT NULL) AS errors
FROM (SELECT r.*, a.start_s AS s, b.end_s AS e, max(last_ord) OVER (PARTITION BY r.movie_id, chunk ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM resp r LEFT JOIN cu a ON a.movie_id = r.movie_id AND a.cue_ord = first_ord LEFT JOIN cu b ON b.movie_id = r.movie_id AND b.cue_ord = last_ord)"""))
def v04_segment_contract(spark: SparkSession, d: str) -> DataFrame:
    return nv.validate_segments(_responses(spark, d), fx.cues(spark, d))


@query(_chunk_sql(_RESP + """SELECT movie_id, chunk, ordinal, e AS code, e IN ('unknown_cue', 'reversed') AS fatal FROM (SELECT movie_id, chunk, ordinal, unnest(list_filter([CASE WHEN last_ord > 100000 OR first_ord < 1 THEN 'unknown_cue' END, CASE WHEN first_ord > last_ord THEN 'reversed' END, CASE WHEN first_ord <= reach THEN 'overlap_or_out_of_order' END, CASE WHEN e - s > 120 AND long_reason IS NULL THEN 'long_without_reason' END], lambda x: x IS NOT NULL)) AS e
FROM (SELECT r.*, a.start_s AS s, b.end_s AS e, max(last_ord) OVER (PARTITION BY r.movie_id, chunk ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM resp r LEFT JOIN cu a ON a.movie_id = r.movie_id AND a.cue_ord = first_ord LEFT JOIN cu b ON b.movie_id = r.movie_id AND b.cue_ord = last_ord))"""))
def v23_structured_errors(spark: SparkSession, d: str) -> DataFrame:
    x = nv.validate_segments(_responses(spark, d), fx.cues(spark, d))
    return x.select("movie_id", "chunk", "ordinal", F.explode("errors").alias("code")).withColumn("fatal", F.col("code").isin("unknown_cue", "reversed"))


@query(_chunk_sql(_RESP + """SELECT movie_id, count(*) FILTER (c > 1) AS repeated_ids, count(*) FILTER (r > 1) AS repeated_ranges, count(*) FILTER (first_ord <= reach) AS out_of_order, count(*) FILTER (first_ord > reach + 1) AS gaps
FROM (SELECT *, count(*) OVER (PARTITION BY movie_id, segment_id) AS c, count(*) OVER (PARTITION BY movie_id, first_ord, last_ord) AS r, max(last_ord) OVER (PARTITION BY movie_id ORDER BY first_ord, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM (SELECT movie_id, printf('NARR_%06d', ordinal) AS segment_id, first_ord, last_ord FROM resp)) GROUP BY movie_id"""))
def v07_consolidated_contract(spark: SparkSession, d: str) -> DataFrame:
    x = _responses(spark, d).select("movie_id", F.format_string("NARR_%06d", "ordinal").alias("segment_id"), "first_ord", "last_ord")
    return nv.consolidated_errors(x)


@query(with_("""SELECT sh.movie_id, shot_id, count(*) AS n_segments, list_sort(list_distinct(list(segment_type))) AS types, list_sort(list_distinct(list(narrative_function))) AS functions, list_sort(list_distinct(list(narrative_tone))) AS tones
FROM sh JOIN sg ON sg.movie_id = sh.movie_id AND sh.start_s < sg.end_s AND sg.start_s < sh.end_s GROUP BY sh.movie_id, shot_id""", "sh", "sg"))
def a21_range_profile(spark: SparkSession, d: str) -> DataFrame:
    return nv.range_profile(fx.shots(spark, d), fx.segments(spark, d), ["shot_id"])


@query(with_("""SELECT sh.movie_id, shot_id, round(sum(CASE WHEN cu.cue_id IS NULL THEN 0 ELSE greatest(0, least(sh.end_s, cu.end_s) - greatest(sh.start_s, cu.start_s)) END), 4) AS overlap_s,
 round(least(1, CASE WHEN any_value(sh.end_s) > any_value(sh.start_s) THEN sum(CASE WHEN cu.cue_id IS NULL THEN 0 ELSE greatest(0, least(sh.end_s, cu.end_s) - greatest(sh.start_s, cu.start_s)) END) / (any_value(sh.end_s) - any_value(sh.start_s)) END), 4) AS occupancy
FROM sh LEFT JOIN cu ON cu.movie_id = sh.movie_id AND sh.start_s < cu.end_s AND cu.start_s < sh.end_s GROUP BY sh.movie_id, shot_id""", "sh", "cu"))
def j01_shot_cue_overlap(spark: SparkSession, d: str) -> DataFrame:
    x = iv.occupancy(fx.shots(spark, d), fx.cues(spark, d), ["shot_id"])
    return x.select("movie_id", "shot_id", _r("overlap_s"), _r("occupancy"))


@query(with_("SELECT sh.movie_id, shot_id, coalesce(list(segment_id ORDER BY sg.start_s, segment_id) FILTER (segment_id IS NOT NULL), []::VARCHAR[]) AS ids FROM sh LEFT JOIN sg ON sg.movie_id = sh.movie_id AND sh.start_s < sg.end_s AND sg.start_s < sh.end_s GROUP BY sh.movie_id, shot_id", "sh", "sg"))
def j02_shot_segments(spark: SparkSession, d: str) -> DataFrame:
    return iv.overlapped_ids(fx.shots(spark, d), fx.segments(spark, d), ["shot_id"], "segment_id")


@query(with_("""SELECT sh.movie_id, shot_id, coalesce(list(cue_id ORDER BY cue_ord) FILTER (sh.start_s < cu.end_s AND cu.start_s < sh.end_s), []::VARCHAR[]) AS overlapping, coalesce(list(cue_id ORDER BY cue_ord) FILTER (cue_id IS NOT NULL), []::VARCHAR[]) AS padded
FROM sh LEFT JOIN cu ON cu.movie_id = sh.movie_id AND sh.start_s - 5 < cu.end_s AND cu.start_s < sh.end_s + 5 GROUP BY sh.movie_id, shot_id""", "sh", "cu"))
def j03_padded_context(spark: SparkSession, d: str) -> DataFrame:
    return iv.padded_context(fx.shots(spark, d), fx.cues(spark, d), ["shot_id"])


@query(with_("SELECT movie_id, shot_id, lag(shot_id) OVER w AS previous_shot_id, round(start_s - lag(end_s) OVER w, 4) AS gap_s FROM sh WINDOW w AS (PARTITION BY movie_id ORDER BY start_s, shot_id)", "sh"))
def j07_adjacent_features(spark: SparkSession, d: str) -> DataFrame:
    x = iv.with_previous(fx.shots(spark, d), ["start_s", "shot_id"], ["shot_id", "end_s"])
    return x.select("movie_id", "shot_id", "previous_shot_id", F.round(F.col("start_s") - F.col("previous_end_s"), 4).alias("gap_s"))


@query(with_("""SELECT movie_id, 1::BIGINT AS window_no, segment_id, round(a, 4) AS start_s, round(b, 4) AS end_s FROM one UNION ALL SELECT movie_id, 2, segment_id, round(a, 4), round(b, 4) FROM two UNION ALL SELECT movie_id, 3, segment_id, round(a, 4), round(b, 4) FROM three""", "sg").replace("\nSELECT movie_id, 1", """, d AS (SELECT movie_id, max(end_s) AS dur FROM sg GROUP BY movie_id),
x AS (SELECT *, a0 AS a, a0 + sz AS b FROM (SELECT *, greatest(0, least((start_s + end_s) / 2 - sz / 2, dur - sz)) AS a0 FROM (SELECT sg.*, dur, least(60, dur) AS sz FROM sg JOIN d USING (movie_id)))),
one AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY (segment_type = 'conversation') DESC, end_s - start_s DESC, segment_id DESC) = 1),
sp AS (SELECT *, segment_type IN ('sparse_dialogue', 'transition') OR narrative_function = 'transition' AS s FROM x),
pool AS (SELECT * FROM (SELECT *, bool_or(s) OVER (PARTITION BY movie_id) AS anys FROM sp) WHERE s OR NOT anys),
two AS (SELECT p.* FROM pool p JOIN one o USING (movie_id) WHERE (p.b <= o.a OR p.a >= o.b) QUALIFY row_number() OVER (PARTITION BY p.movie_id ORDER BY p.end_s - p.start_s DESC, p.segment_id) = 1),
fr AS (SELECT x.*, (x.start_s + x.end_s) / 2 >= x.dur / 2 AND x.narrative_function <> o.narrative_function AND x.narrative_function <> t.narrative_function AS nw FROM x JOIN one o USING (movie_id) JOIN two t USING (movie_id)
  WHERE (x.b <= o.a OR x.a >= o.b) AND (x.b <= t.a OR x.a >= t.b) AND abs((x.a + x.b) / 2 - (o.a + o.b) / 2) >= 100 AND abs((x.a + x.b) / 2 - (t.a + t.b) / 2) >= 100),
three AS (SELECT * FROM fr QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY nw DESC, CASE WHEN nw THEN start_s - end_s END NULLS FIRST, start_s DESC, segment_id) = 1)
SELECT movie_id, 1""", 1))
def w10_diverse_windows(spark: SparkSession, d: str) -> DataFrame:
    sg = fx.segments(spark, d)
    x = nv.smoke_windows(sg, sg.groupBy("movie_id").agg(F.max("end_s").alias("duration_s")), apart=100.0)
    return x.select("movie_id", "window_no", "segment_id", _r("start_s"), _r("end_s"))


_REASONS = ("conflict_begins", "revelation", "therapy_phase_change", "unheard_of", "location_or_context_change")


@query(with_(f"SELECT movie_id, segment_id, CASE r WHEN 'conflict_begins' THEN 'conflict_start' WHEN 'therapy_phase_change' THEN 'phase_change' WHEN 'location_or_context_change' THEN 'context_change' WHEN 'revelation' THEN 'revelation' END AS reason FROM (SELECT *, ['{"', '".join(_REASONS)}'][first_ord % 5 + 1] AS r FROM sg)", "sg"))
def v03_boundary_reason(spark: SparkSession, d: str) -> DataFrame:
    known = [*nv.BOUNDARY_ALIASES.values()]
    x = fx.segments(spark, d).withColumn("r", fx.pick(_REASONS, F.col("first_ord") % 5))
    return x.select("movie_id", "segment_id", nv.boundary_reason(F.col("r"), known).alias("reason"))


@query(with_("SELECT movie_id, cue_ord, list_distinct(list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}\\p{Pc}]+'), lambda x: length(x) > 2)).list_sort() AS words FROM cu", "cu"))
def g07_token_sets(spark: SparkSession, d: str) -> DataFrame:
    x = fx.cues(spark, d)
    return x.select("movie_id", "cue_ord", F.array_sort(tokens(F.col("text"))).alias("words"))


@query("SELECT p_partkey AS asset, regexp_replace(substr(array_to_string(list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: x NOT IN ('a', 'an', 'the', 'of', 'and', 'el', 'la', 'los', 'las', 'de', 'del', 'y', 'en', 'un', 'una')), '-'), 1, 48), '-+$', '') AS slug FROM part")
def l01_asset_slug(spark: SparkSession, d: str) -> DataFrame:
    return fx.assets(spark, d).select("asset", slug(F.col("name")).alias("slug"))
