"""Subtitle cues, overlapping chunks and segment maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.functions.columns import errors

# Names that older maps use for a boundary's reason, and the reasons there are.
BOUNDARY_ALIASES = {
    "conflict_begins": "conflict_start",
    "conflict_resolves": "conflict_end",
    "interaction_purpose_change": "interaction_change",
    "subject_or_situation_change": "subject_change",
    "revelation_changes_situation": "revelation",
    "location_or_context_change": "context_change",
    "participant_group_change": "participant_change",
    "therapy_phase_change": "phase_change",
}


def _title():
    return Window.partitionBy("movie_id")


def cue_statistics(cues: DataFrame) -> DataFrame:
    """Per title: cue_count, first_start, last_end, covered_s, average_s, average_gap_s, maximum_gap_s."""
    before = F.lag("end_s").over(_title().orderBy("cue_ord"))
    x = cues.withColumn("gap", F.when(before.isNotNull(), F.greatest(F.lit(0.0), F.col("start_s") - before)))
    return x.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("cue_count"), F.min_by("start_s", "cue_ord").alias("first_start"), F.max_by("end_s", "cue_ord").alias("last_end"),
        F.sum(F.col("end_s") - F.col("start_s")).alias("covered_s"), F.avg(F.col("end_s") - F.col("start_s")).alias("average_s"),
        F.coalesce(F.avg("gap"), F.lit(0.0)).alias("average_gap_s"), F.coalesce(F.max("gap"), F.lit(0.0)).alias("maximum_gap_s"),
    )


def validate_timeline(cues: DataFrame, durations: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """movie_id, status, n_errors, n_warnings, of cues against durations (movie_id, duration_s).

    ERROR: a cue that starts after its end, before zero or before the cue ahead of it; WARNING: the last cue ends after the title.
    """
    before = F.lag("start_s").over(_title().orderBy("cue_ord"))
    found = errors((F.col("start_s") > F.col("end_s"), "reversed"), (F.col("start_s") < -tolerance, "before_zero"), (F.col("start_s") < before, "regression"))
    per = cues.withColumn("_e", F.size(found)).groupBy("movie_id").agg(F.sum("_e").alias("n_errors"), F.max_by("end_s", "cue_ord").alias("_end"))
    x = per.join(durations, "movie_id", "left").withColumn("n_warnings", F.when(F.col("_end") > F.col("duration_s") + tolerance, 1).otherwise(0))
    status = F.when(F.col("n_errors") > 0, "ERROR").when(F.col("n_warnings") > 0, "WARNING").otherwise("OK")
    return x.select("movie_id", status.alias("status"), "n_errors", "n_warnings")


def clean_text(text: Column) -> Column:
    """Text without formatting tags (b, i, u, s, strike, font), with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?i)</?(?:b|i|u|s|strike|font)(?:\s[^>]*)?>", ""), r"\s+", " "))


def boundary_reason(value: Column, known: list[str]) -> Column:
    """The reason's current name; null for names that nobody knows."""
    aliases = F.create_map(*[F.lit(x) for kv in BOUNDARY_ALIASES.items() for x in kv])
    name = F.coalesce(aliases[value], value)
    return F.when(name.isin(known), name)


def density(cues: DataFrame, keys: list[str]) -> DataFrame:
    """keys, density of speech: cue seconds per second between the group's first start and last end."""
    x = cues.groupBy(*keys).agg(F.sum(F.greatest(F.lit(0.0), F.col("end_s") - F.col("start_s"))).alias("covered"), F.min_by("start_s", "cue_ord").alias("a"), F.max_by("end_s", "cue_ord").alias("b"))
    part = F.col("covered") / F.greatest(F.col("b") - F.col("a"), F.lit(0.001))
    return x.select(*keys, F.when(part < 0.10, "low").when(part < 0.35, "medium").otherwise("high").alias("density"))


def chunk_cues(cues: DataFrame, window: float = 600.0, overlap: float = 60.0, tail: float = 120.0) -> DataFrame:
    """(movie_id, chunk, start_s, end_s, cue_ord): windows advance by window - overlap; a cue is in every window it meets.

    Empty windows don't count. A last chunk of one cue joins the one before it, if that grows by tail or overlap at most.
    """
    step = window - overlap
    last = F.max("end_s").over(_title())
    first_w = F.greatest(F.lit(0), F.floor((F.col("start_s") - window) / step) + 1)
    last_w = F.ceil(F.col("end_s") / step) - 1
    x = cues.withColumn("last_end", last).where(last_w >= first_w)
    x = x.withColumn("w", F.explode(F.sequence(first_w.cast("bigint"), last_w.cast("bigint"))))
    x = x.withColumn("a", F.col("w") * step).withColumn("b", F.least(F.col("w") * step + window, F.col("last_end")))
    x = x.where((F.col("a") < F.col("last_end")) & (F.col("end_s") > F.col("a")) & (F.col("start_s") < F.col("b")))
    sizes = x.groupBy("movie_id", "w", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    down = _title().orderBy(F.desc("w"))
    sizes = sizes.withColumn("back", F.row_number().over(down)).withColumn("b_before", F.lead("b").over(down))
    lonely = (F.col("back") == 1) & (F.col("n") == 1) & F.col("b_before").isNotNull() & (F.col("b") - F.col("b_before") <= max(tail, overlap))
    sizes = sizes.withColumn("absorbed", lonely)
    final = sizes.withColumn("grown", F.lag("absorbed").over(down)).withColumn("b_next", F.lag("b").over(down))
    final = final.where(~F.col("absorbed")).withColumn("end", F.when(F.coalesce("grown", F.lit(False)), F.col("b_next")).otherwise(F.col("b")))
    final = final.withColumn("chunk", F.row_number().over(_title().orderBy("w")).cast("bigint"))
    own = x.join(final.select("movie_id", "w", "chunk", "end", F.col("grown")), ["movie_id", "w"])
    kept = own.select("movie_id", "chunk", F.col("a").alias("start_s"), F.col("end").alias("end_s"), "cue_ord")
    # cues of the absorbed chunk go to the one before it
    moved = x.join(sizes.where("absorbed").select("movie_id", "w"), ["movie_id", "w"]).select("movie_id", "cue_ord")
    grown = final.where("grown").select("movie_id", "chunk", F.col("a").alias("start_s"), F.col("end").alias("end_s"))
    return kept.union(grown.join(moved, "movie_id").select("movie_id", "chunk", "start_s", "end_s", "cue_ord")).distinct()


def expand_ranges(ranges: DataFrame, cues: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_cues, cue_ids (in order), start_s, end_s, of ranges (movie_id, keys, first_ord, last_ord)."""
    long = ranges.select("movie_id", *keys, F.explode(F.sequence("first_ord", "last_ord")).alias("cue_ord"))
    met = long.join(cues.select("movie_id", "cue_ord", "cue_id", "start_s", "end_s"), ["movie_id", "cue_ord"])
    out = met.groupBy("movie_id", *keys).agg(F.count(F.lit(1)).alias("n_cues"), F.sort_array(F.collect_list(F.struct("cue_ord", "cue_id"))).alias("_l"), F.min_by("start_s", "cue_ord").alias("start_s"), F.max_by("end_s", "cue_ord").alias("end_s"))
    return out.withColumn("cue_ids", F.transform("_l", lambda x: x["cue_id"])).drop("_l")


def cue_coverage(cues: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per title: assigned and unassigned cues."""
    long = ranges.select("movie_id", F.explode(F.sequence("first_ord", "last_ord")).alias("cue_ord")).distinct().withColumn("hit", F.lit(1))
    x = cues.select("movie_id", "cue_ord").join(long, ["movie_id", "cue_ord"], "left")
    return x.groupBy("movie_id").agg(F.count("hit").alias("assigned"), F.count_if(F.col("hit").isNull()).alias("unassigned"))


def validate_segments(segments: DataFrame, cues: DataFrame, longest_s: float = 120.0) -> DataFrame:
    """movie_id, chunk, ordinal and error codes of the segments (movie_id, chunk, ordinal, first_ord, last_ord, long_reason) of chunks.

    unknown_cue, reversed, overlap_or_out_of_order (begins within what segments before it reach), long_without_reason.
    """
    names = cues.select("movie_id", F.col("cue_ord").alias("o"), F.col("start_s").alias("s"), F.col("end_s").alias("e"))
    a = names.select("movie_id", F.col("o").alias("first_ord"), F.col("s").alias("from_s"))
    b = names.select("movie_id", F.col("o").alias("last_ord"), F.col("e").alias("to_s"))
    x = segments.join(a, ["movie_id", "first_ord"], "left").join(b, ["movie_id", "last_ord"], "left")
    reach = F.max("last_ord").over(Window.partitionBy("movie_id", "chunk").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1))
    found = errors(
        (F.col("from_s").isNull() | F.col("to_s").isNull(), "unknown_cue"), (F.col("first_ord") > F.col("last_ord"), "reversed"),
        (F.col("first_ord") <= reach, "overlap_or_out_of_order"), ((F.col("to_s") - F.col("from_s") > longest_s) & F.col("long_reason").isNull(), "long_without_reason"),
    )
    return x.withColumn("errors", found).select("movie_id", "chunk", "ordinal", "errors")


def consolidated_errors(segments: DataFrame) -> DataFrame:
    """Per title: repeated ids, repeated ranges, out of order, gaps, in a map (movie_id, segment_id, first_ord, last_ord)."""
    by = _title().orderBy("first_ord", "segment_id")
    x = segments.withColumn("ids", F.count(F.lit(1)).over(Window.partitionBy("movie_id", "segment_id")))
    x = x.withColumn("ranges", F.count(F.lit(1)).over(Window.partitionBy("movie_id", "first_ord", "last_ord")))
    reach = F.max("last_ord").over(by.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("reach", reach)
    return x.groupBy("movie_id").agg(F.count_if(F.col("ids") > 1).alias("repeated_ids"), F.count_if(F.col("ranges") > 1).alias("repeated_ranges"), F.count_if(F.col("first_ord") <= F.col("reach")).alias("out_of_order"), F.count_if(F.col("first_ord") > F.col("reach") + 1).alias("gaps"))


def range_profile(ranges: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the sorted sets of types, functions and tones, unknown ones left out, of the segments that a range meets."""
    from cutlight.operators.intervals import overlapping

    met = overlapping(ranges.select("movie_id", *keys, "start_s", "end_s"), segments.select("movie_id", "segment_id", "segment_type", "narrative_function", "narrative_tone", "start_s", "end_s"))
    some = lambda c: F.array_sort(F.collect_set(F.when(F.col(c) != "unknown", F.col(c))))
    return met.groupBy("movie_id", *keys).agg(F.count(F.lit(1)).alias("n_segments"), some("segment_type").alias("types"), some("narrative_function").alias("functions"), some("narrative_tone").alias("tones"))


def smoke_windows(segments: DataFrame, durations: DataFrame, window: float = 60.0, apart: float = 900.0) -> DataFrame:
    """Three diverse windows of each title: movie_id, window_no, segment_id, start_s, end_s.

    First the best conversation (type, then length, then id), then the longest sparse or transitional segment that does not
    overlap it (any segment if there is none), then of the second half the longest whose function differs from both and
    whose middle is far enough from both, else the latest far enough. A title without a choice has fewer windows.
    """
    x = segments.join(durations, "movie_id")
    size = F.least(F.lit(window), F.col("duration_s"))
    middle = (F.col("start_s") + F.col("end_s")) / 2
    a = F.greatest(F.lit(0.0), F.least(middle - size / 2, F.col("duration_s") - size))
    x = x.withColumn("a", a).withColumn("b", a + size).withColumn("length", F.col("end_s") - F.col("start_s")).withColumn("middle", middle)

    def best(rows: DataFrame, no: int, *order: Column) -> DataFrame:
        got = rows.withColumn("_r", F.row_number().over(_title().orderBy(*order))).where("_r = 1")
        return got.select("movie_id", F.lit(no).alias("window_no"), "segment_id", "narrative_function", "a", "b")

    one = best(x, 1, F.desc(F.col("segment_type") == "conversation"), F.desc("length"), F.desc("segment_id"))

    def clear(rows: DataFrame, chosen: DataFrame, far: float) -> DataFrame:
        c = chosen.select("movie_id", F.col("a").alias("ca"), F.col("b").alias("cb"))
        ok = ((F.col("b") <= F.col("ca")) | (F.col("a") >= F.col("cb"))) & (F.abs((F.col("a") + F.col("b")) / 2 - (F.col("ca") + F.col("cb")) / 2) >= far)
        return rows.join(c, "movie_id").where(ok).drop("ca", "cb")

    sparse = F.col("segment_type").isin("sparse_dialogue", "transition") | (F.col("narrative_function") == "transition")
    any_sparse = F.max(sparse.cast("int")).over(_title())
    pool = x.withColumn("_s", sparse).withColumn("_any", any_sparse).where(F.col("_s") | (F.col("_any") == 0))
    two = best(clear(pool, one, 0.0), 2, F.desc("length"), F.col("segment_id"))
    taken = one.select("movie_id", F.col("narrative_function").alias("f1")).join(two.select("movie_id", F.col("narrative_function").alias("f2")), "movie_id")
    free = clear(clear(x, one, apart), two, apart).join(taken, "movie_id")
    new = (F.col("middle") >= F.col("duration_s") / 2) & (F.col("narrative_function") != F.col("f1")) & (F.col("narrative_function") != F.col("f2"))
    three = best(free.withColumn("_new", new), 3, F.desc("_new"), F.when(F.col("_new"), -F.col("length")), F.desc("start_s"), F.col("segment_id"))
    return one.union(two).union(three).select("movie_id", F.col("window_no").cast("bigint").alias("window_no"), "segment_id", F.col("a").alias("start_s"), F.col("b").alias("end_s"))
