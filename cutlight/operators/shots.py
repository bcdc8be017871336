"""Frames, cuts, shots and the visual events that shots form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.functions.columns import clamp, errors, rounded
from cutlight.session import cut

#: Event types and the durations that suit them: from, to, and the longest that is still allowed (fixed values).
DURATION_RANGES = {
    "reaction": (3.0, 7.0, 10.0),
    "action": (4.0, 9.0, 12.0),
    "movement": (5.0, 10.0, 14.0),
    "activity": (5.0, 10.0, 14.0),
    "conversation": (7.0, 15.0, 18.0),
    "interaction": (7.0, 15.0, 18.0),
}
OTHER_RANGE = (5.0, 10.0, 15.0)
KEEP, REVIEW, LONGEST = 70, 50, 18.0
#: Frames of a stretch in which cuts and windows meet.
STRETCH = 2000


def _title():
    return Window.partitionBy("movie_id")


def cuts(scores: DataFrame, threshold: float | Column) -> DataFrame:
    """Rows of scores (movie_id, frame, score) that are cuts."""
    return scores.where(F.col("score") >= threshold)


def build_shots(windows: DataFrame, cuts_: DataFrame, fps: float) -> DataFrame:
    """Shots of windows (movie_id, start_frame, end_frame) cut at distinct frames inside: movie_id, window_start, n, shot_id, start_frame, end_frame, start_s, end_s."""
    w = windows.select("movie_id", F.col("start_frame").alias("window_start"), F.col("end_frame").alias("window_end"))
    # a cut meets the windows of its stretch of frames only, not all of its title
    near = w.withColumn("_b", F.explode(F.sequence(F.floor(F.col("window_start") / STRETCH), F.floor(F.col("window_end") / STRETCH))))
    inner = cuts_.withColumn("_b", F.floor(F.col("frame") / STRETCH)).join(near, ["movie_id", "_b"]).where((F.col("frame") > F.col("window_start")) & (F.col("frame") < F.col("window_end"))).select("movie_id", "window_start", "window_end", "frame")
    ends = w.select("movie_id", "window_start", "window_end", F.explode(F.array("window_start", "window_end")).alias("frame"))
    by = Window.partitionBy("movie_id", "window_start").orderBy("frame")
    x = inner.union(ends).distinct().withColumn("end_frame", F.lead("frame").over(by)).where("end_frame is not null").withColumn("n", F.row_number().over(by))
    return x.select("movie_id", "window_start", F.col("n").cast("bigint").alias("n"), F.format_string("SHOT_%04d", "n").alias("shot_id"), F.col("frame").alias("start_frame"), "end_frame", (F.col("frame") / fps).alias("start_s"), (F.col("end_frame") / fps).alias("end_s"))


def local_peaks(scores: DataFrame, most: int = 15) -> DataFrame:
    """The highest frames of each title that are no lower than both neighbours and above zero: movie_id, rank, frame, score."""
    by = _title().orderBy("frame")
    x = scores.withColumn("_b", F.lag("score").over(by)).withColumn("_a", F.lead("score").over(by))
    top = (F.col("score") > 0) & F.coalesce(F.col("score") >= F.col("_b"), F.lit(True)) & F.coalesce(F.col("score") >= F.col("_a"), F.lit(True))
    x = x.where(top).withColumn("rank", F.row_number().over(_title().orderBy(F.desc("score"), "frame"))).where(F.col("rank") <= most)
    return x.select("movie_id", F.col("rank").cast("bigint").alias("rank"), "frame", "score")


def shot_metrics(shots: DataFrame, keys: list[str]) -> DataFrame:
    """Number and durations of shots by keys: n, per_minute, min, median, mean, p90 (nearest rank), max, short and long counts."""
    d = F.col("end_s") - F.col("start_s")
    total = F.sum(d)
    return shots.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.when(total > 0, F.count(F.lit(1)) * 60 / total).alias("per_minute"), F.min(d).alias("min_s"), F.median(d).alias("median_s"), F.avg(d).alias("mean_s"),
        F.expr("percentile_disc(0.9) within group (order by end_s - start_s)").alias("p90_s"), F.max(d).alias("max_s"),
        F.count_if(d < 0.5).alias("below_half"), F.count_if(d < 1).alias("below_1"), F.count_if(d > 15).alias("above_15"), F.count_if(d > 30).alias("above_30"),
    )


def threshold_sweep(scores: DataFrame, thresholds: list[float]) -> DataFrame:
    """Cuts and shots at each threshold, for each title and for all (movie_id null): threshold, movie_id, n_cuts, n_shots."""
    t = scores.select("movie_id", "score", F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold"))
    per = t.groupBy("threshold", "movie_id").agg(F.count_if(F.col("score") >= F.col("threshold")).alias("n_cuts"))
    per = per.withColumn("n_shots", F.col("n_cuts") + 1)
    both = per.groupingSets([["threshold", "movie_id"], ["threshold"]], "threshold", "movie_id")
    return both.agg(F.sum("n_cuts").alias("n_cuts"), F.sum("n_shots").alias("n_shots")).select("threshold", "movie_id", "n_cuts", "n_shots")


def cut_difference(scores: DataFrame, low: float, high: float) -> DataFrame:
    """Per title: cuts at low, at high, and those of low that high loses."""
    return scores.groupBy("movie_id").agg(F.count_if(F.col("score") >= low).alias("at_low"), F.count_if(F.col("score") >= high).alias("at_high"), F.count_if((F.col("score") >= low) & (F.col("score") < high)).alias("only_low"))


def shot_signals(shots: DataFrame, frames: DataFrame, sliver_s: float = 0.25) -> DataFrame:
    """Signals of shots pooled over their sampled frames: movie_id, shot_id, status, mean, std, near_black, sharpness, motion.

    std is over all pixels. Without a frame a title's last shot of under sliver_s is SKIPPED, any other FAILED.
    """
    n = F.sum("n")
    mean = F.sum("s1") / n
    got = frames.groupBy("movie_id", "shot_id").agg(
        mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.sum("s2") / n - mean * mean)).alias("std"), (F.sum("dark") / n).alias("near_black"),
        F.avg("laplacian").alias("sharpness"), F.coalesce(F.avg("diff_prev"), F.lit(0.0)).alias("motion"), F.count(F.lit(1)).alias("frames"),
    )
    last = F.lead("shot_id").over(_title().orderBy("start_s", "shot_id")).isNull()
    x = shots.select("movie_id", "shot_id", last.alias("last"), (F.col("end_s") - F.col("start_s")).alias("d")).join(got, ["movie_id", "shot_id"], "left")
    status = F.when(F.col("frames").isNotNull(), "COMPLETE").when(F.col("last") & (F.col("d") < sliver_s), "SKIPPED").otherwise("FAILED")
    return x.select("movie_id", "shot_id", status.alias("status"), "mean", "std", "near_black", "sharpness", "motion")


def middle_sample(samples: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row in the middle (of an even number the later one) of each group."""
    by = Window.partitionBy(*keys)
    x = samples.withColumn("_n", F.count(F.lit(1)).over(by)).withColumn("_r", F.row_number().over(by.orderBy(order)))
    return x.where(F.col("_r") == F.floor(F.col("_n") / 2) + 1).drop("_n", "_r")


def picture_bounds(runs: DataFrame, width: int, height: int, share: float = 0.78, least: int = 24, rest: float = 0.55) -> DataFrame:
    """The usable picture of each title from dark edge runs (movie_id, top, bottom, left, right) of its sampled frames.

    An edge is stable at the length that the given share of frames reach; shorter than least pixels it does not count. If too
    little of the frame would be left, the whole frame is used.
    """

    def stable(c: str) -> Column:
        values = F.array_sort(F.collect_list(c))
        at = F.element_at(values, (F.size(values) - F.ceil(F.size(values) * share) + 1).cast("int"))
        return F.when(at >= least, at).otherwise(0)

    x = runs.groupBy("movie_id").agg(*[stable(c).alias(c) for c in ("top", "bottom", "left", "right")], F.count(F.lit(1)).alias("n"))
    w, h = width - F.col("left") - F.col("right"), height - F.col("top") - F.col("bottom")
    small = (w < rest * width) | (h < rest * height)
    zero = lambda c: F.when(small, 0).otherwise(F.col(c)).cast("bigint").alias(c)
    return x.select("movie_id", zero("top"), zero("bottom"), zero("left"), zero("right"), F.when(small, F.lit("FULL_FRAME")).otherwise("CROPPED").alias("status"))


def analysis_units(shots: DataFrame, fps: float, longest: float = LONGEST) -> DataFrame:
    """Shots cut into units of at most longest seconds whose sizes differ by one frame at most: part, start_frame, end_frame."""
    frames = F.col("end_frame") - F.col("start_frame")
    most = int(longest * fps)
    x = shots.where(frames > 0).withColumn("frames", frames).withColumn("parts", F.ceil(frames / most))
    x = x.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    base, more = F.floor(F.col("frames") / F.col("parts")), F.col("frames") % F.col("parts")
    a = F.col("start_frame") + F.col("part") * base + F.least(F.col("part"), more)
    b = a + base + F.when(F.col("part") < more, 1).otherwise(0)
    return x.select("movie_id", "shot_id", "part", a.alias("unit_start"), b.alias("unit_end"))


def validate_shots(shots: DataFrame, windows: DataFrame, fps: float) -> DataFrame:
    """Faults of the shots of each window: movie_id, window_id, no_shots, bad_first, bad_last (booleans), gaps (or overlaps), non_positive, outside, mismatches.

    shots: movie_id, window_id, shot_id, start_frame, end_frame, start_s, end_s, representative_s, duration_s; windows: movie_id,
    window_id, start_frame, end_frame. outside: the representative frame is not in the shot; mismatches: seconds and frames disagree.
    """
    keys = ["movie_id", "window_id"]
    before = F.lag("end_frame").over(Window.partitionBy(*keys).orderBy("start_s", "shot_id"))
    size = F.col("end_frame") - F.col("start_frame")
    order = F.struct("start_s", "shot_id")
    g = shots.withColumn("_b", before).groupBy(*keys).agg(
        F.min_by("start_frame", order).alias("first"), F.max_by("end_frame", order).alias("last"), F.count_if(F.col("start_frame") != F.col("_b")).alias("gaps"), F.count_if(size <= 0).alias("non_positive"),
        F.count_if(~((F.col("start_s") <= F.col("representative_s")) & (F.col("representative_s") < F.col("end_s")))).alias("outside"), F.count_if(F.abs(F.col("duration_s") - size / fps) > 1e-8).alias("mismatches"),
    )
    x = windows.join(g, keys, "left")
    no = F.col("first").isNull()
    return x.select(*keys, no.alias("no_shots"), F.coalesce(F.col("first") != F.col("start_frame"), F.lit(False)).alias("bad_first"), F.coalesce(F.col("last") != F.col("end_frame"), F.lit(False)).alias("bad_last"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "non_positive", "outside", "mismatches")])


def continuity_errors(shots: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Per title: jumps between shots beyond the tolerance, first start and last end."""
    x = shots.withColumn("_b", F.lag("end_s").over(_title().orderBy("start_s", "shot_id")))
    return x.groupBy("movie_id").agg(F.count_if(F.abs(F.col("start_s") - F.col("_b")) > tolerance).alias("jumps"), F.min("start_s").alias("first_s"), F.max("end_s").alias("last_s"))


def priority_batches(events: DataFrame, size: int, score: str = "score") -> DataFrame:
    """movie_id, event_id, rank, batch: events of a title by falling score, start and id, in batches of a fixed size."""
    x = events.withColumn("rank", F.row_number().over(_title().orderBy(F.desc(score), "start_s", "event_id")).cast("bigint"))
    return x.select("movie_id", "event_id", "rank", F.floor((F.col("rank") - 1) / size).alias("batch"))


def histogram_similarity(a: Column, b: Column) -> Column:
    """Correlation of two histograms brought to 0..1; histograms without variance count as equal."""
    mean = lambda h: F.aggregate(h, F.lit(0.0), lambda s, x: s + x) / F.size(h)
    # a step's result goes on as a lambda's variable: an expression inside a lambda would be worked out again for each element
    let = lambda value, use: F.get(F.transform(F.array(value), use), 0)

    def sums(m: Column) -> Column:
        both = F.zip_with(a, b, lambda p, q: F.struct((p - m["a"]).alias("p"), (q - m["b"]).alias("q")))
        zero = F.struct(F.lit(0.0).alias("ab"), F.lit(0.0).alias("aa"), F.lit(0.0).alias("bb"))
        return F.aggregate(both, zero, lambda s, v: F.struct((s["ab"] + v["p"] * v["q"]).alias("ab"), (s["aa"] + v["p"] * v["p"]).alias("aa"), (s["bb"] + v["q"] * v["q"]).alias("bb")))

    like = lambda s: clamp((F.when(s["aa"] * s["bb"] > 0, s["ab"] / F.sqrt(s["aa"] * s["bb"])).otherwise(1.0) + 1) / 2, 0.0, 1.0)
    return let(let(F.struct(mean(a).alias("a"), mean(b).alias("b")), sums), like)


#: What a shot must say about itself for its continuity with another one; hist (its histogram) where similarity counts.
EDGE_COLUMNS = ("shot_id", "occupancy", "interaction_id", "action_id", "scene_id", "establishing_id", "setting_id", "participants", "subject_id", "composition", "reverse_shot", "scene_break_after", "scene_break_before", "cut_score")
STRONG_CUT, TALK, LIKE = 0.65, 0.45, 0.12


def continuity(pairs: DataFrame) -> DataFrame:
    """pairs with merge, reasons, breaks, dialogue and similarity of a shot and a later one.

    pairs: EDGE_COLUMNS of the first shot, and of the second under n_<name>; with hist and n_hist, the similarity of both.
    Missing ids and flags are never a difference; a known difference or a break vetoes whatever speaks for a merge.
    """
    no = lambda c: F.coalesce(c, F.lit(False))
    same = {c: no(F.col(c) == F.col(f"n_{c}")) for c in EDGE_COLUMNS}
    other = {c: no(F.col(c) != F.col(f"n_{c}")) for c in EDGE_COLUMNS}
    reverse = no(F.col("reverse_shot")) & no(F.col("n_reverse_shot"))
    reasons = errors(
        (same["interaction_id"] | reverse, "same_interaction"), (reverse, "validated_shot_reverse_shot"), (same["action_id"], "continuous_action"), (same["scene_id"], "same_scene"),
        (same["establishing_id"], "establishing_or_insert_continuity"), (same["setting_id"] & same["participants"], "stable_setting_and_participants"),
        (same["setting_id"] & ~same["participants"] & same["subject_id"], "stable_setting_and_shared_subject"),
    )
    strong = no(F.col("cut_score") >= STRONG_CUT) | no(F.col("n_cut_score") >= STRONG_CUT)
    x = pairs.withColumn("reasons", reasons).withColumn("dialogue", F.col("occupancy") + F.col("n_occupancy") >= TALK)
    bare = F.size("reasons") == 0
    breaks = errors(
        (no(F.col("scene_break_after")) | no(F.col("n_scene_break_before")), "explicit_scene_or_time_break"), (other["setting_id"], "setting_or_location_discontinuity"),
        (other["participants"], "participant_set_discontinuity"), (strong & bare, "strong_scene_change_without_continuity"),
        (other["composition"] & bare & ~F.col("dialogue"), "major_composition_change_without_interaction"), (other["subject_id"] & bare & ~F.col("dialogue"), "major_subject_identity_change_without_interaction"),
    )
    like = histogram_similarity(F.col("hist"), F.col("n_hist")) if "hist" in pairs.columns else F.lit(None).cast("double")
    return x.withColumn("breaks", breaks).withColumn("merge", F.size("breaks") == 0).withColumn("similarity", like)


def _edge_columns(shots: DataFrame) -> list[str]:
    return [*EDGE_COLUMNS, *[c for c in ("hist", "vec_id") if c in shots.columns]]


def similarities(pairs: DataFrame, hists: DataFrame) -> DataFrame:
    """pairs with the similarity of the vectors vec_id and n_vec_id (hists: vec_id, hist) in their place; one that is missing counts like one without variance.

    Where the vectors are too many to be sent to all tasks, each pair goes through a shuffle with one of them: pairs should be those that need it, with few columns. A vector travels
    as it is stored, and its numbers become doubles where they are compared.
    """
    x = pairs.join(hists, "vec_id", "left").join(hists.select(F.col("vec_id").alias("n_vec_id"), F.col("hist").alias("n_hist")), "n_vec_id", "left")
    x = x.withColumns({c: F.col(c).cast("array<double>") for c in ("hist", "n_hist")})
    return x.withColumn("similarity", histogram_similarity(F.col("hist"), F.col("n_hist"))).drop("hist", "n_hist", "vec_id", "n_vec_id")


def adjacent_edges(shots: DataFrame, hists: DataFrame | None = None) -> DataFrame:
    """Continuity of each shot with the next one of its title: movie_id, shot_id, next_id, merge, reasons, breaks, dialogue, similarity.

    shots: movie_id, shot_ord, EDGE_COLUMNS, and where similarity counts hist, or vec_id with hists (vec_id, hist). One window over a title.
    """
    by = _title().orderBy("shot_ord")
    x = continuity(shots.withColumns({f"n_{c}": F.lead(c).over(by) for c in _edge_columns(shots)}).where("n_shot_id is not null"))
    names = ["movie_id", "shot_id", F.col("n_shot_id").alias("next_id"), "merge", "reasons", "breaks", "dialogue"]
    return x.select(*names, "similarity") if hists is None else similarities(x.select(*names, "vec_id", "n_vec_id"), hists)


def baseline_join(edges: DataFrame, least: float = LIKE) -> DataFrame:
    """edges with joined: a merge that likeness, speech or a reason supports."""
    return edges.withColumn("joined", F.col("merge") & (F.coalesce(F.col("similarity") >= least, F.lit(False)) | F.col("dialogue") | (F.size("reasons") > 0)))


def joined_edges(edges: DataFrame, columns: list[str], hists: DataFrame | None, least: float = LIKE) -> DataFrame:
    """columns of edges (as continuity() gives them) and joined, as baseline_join() says it. Vectors (hists; edges have vec_id and n_vec_id) are looked up for those merges only that neither speech nor a reason supports."""
    if hists is None:
        return baseline_join(edges, least).select(*columns, "joined")
    unsure = F.col("merge") & ~F.coalesce("dialogue", F.lit(False)) & (F.size("reasons") == 0)
    known = F.col("merge") & (F.col("dialogue") | (F.size("reasons") > 0))
    x = cut(edges.select(*columns, known.alias("joined"), F.coalesce(unsure, F.lit(False)).alias("unsure"), "vec_id", "n_vec_id"), "edges")
    like = similarities(x.where("unsure").select(*columns, "vec_id", "n_vec_id"), hists).withColumn("joined", F.coalesce(F.col("similarity") >= least, F.lit(False)))
    return x.where("not unsure").select(*columns, "joined").unionByName(like.select(*columns, "joined"))


def duration_fit(duration: Column, kind: Column) -> Column:
    """0..25: how well a duration suits an event type, fading on both sides without a cliff."""
    low, high, allowed = (F.coalesce(F.create_map(*[F.lit(x) for k, v in DURATION_RANGES.items() for x in (k, v[i])])[F.lower(kind)], F.lit(OTHER_RANGE[i])) for i in range(3))
    d = F.greatest(F.lit(0.0), duration)
    far = F.greatest(F.lit(0.0), 25 * 0.65 * (1 - (d - allowed) / F.greatest(F.lit(8.0), allowed)))
    return F.when((d >= low) & (d <= high), 25.0).when(d < low, 25 * (0.45 + 0.55 * d / low)).when(d <= allowed, 25 * (1 - 0.35 * (d - high) / (allowed - high))).otherwise(far)


def score_events(events: DataFrame) -> DataFrame:
    """events with the five parts of their score, total and structural decision.

    Needs duration_s, kind, sharpness, brightness, near_black, continuity, occupancy, motion, n_shots.
    """
    part = lambda x: rounded(clamp(x, 0.0, 100.0), 2)
    quality = 25 * (0.45 * F.least(F.lit(1.0), F.col("sharpness") / 150) + 0.35 * (1 - F.abs(F.col("brightness") - 110) / 145) + 0.20 * (1 - F.col("near_black")))
    continuity = 20 * (0.6 * F.col("continuity") + 0.4 * (1 - F.least(F.lit(1.0), F.col("occupancy"))))
    motion = 15 * (1 - F.least(F.lit(1.0), F.abs(F.col("motion") - 12) / 20))
    simple = 15 * (1 / (1 + 0.18 * (F.col("n_shots") - 1)))
    x = events.withColumns({"p_duration": part(duration_fit(F.col("duration_s"), F.col("kind"))), "p_quality": part(quality), "p_continuity": part(continuity), "p_motion": part(motion), "p_simple": part(simple)})
    x = x.withColumn("total", rounded(F.col("p_duration") + F.col("p_quality") + F.col("p_continuity") + F.col("p_motion") + F.col("p_simple"), 2))
    return x.withColumn("structural", F.when(F.col("total") >= KEEP, "KEEP").when(F.col("total") >= REVIEW, "REVIEW").otherwise("REJECT"))


def event_rollup(shots: DataFrame, group: str) -> DataFrame:
    """One event for each group of a title's shots: bounds, mean signals, shot ids in order, narrative ids, reasons, kind.

    Needs shot_ord, occupancy, ids (narrative segments) and similarity (to the shot before in the event) beside the signals.
    """
    signals = ("brightness", "sharpness", "motion", "near_black", "occupancy", "similarity")
    order = F.sort_array(F.collect_list(F.struct("shot_ord", "shot_id", "ids", *[F.col(c).cast("double").alias(c) for c in signals])))

    def mean(c: str) -> Column:
        """The mean of what is known, added up in the order of shots: in another order it may lie on the other side of a rounding's edge."""
        known = F.filter(F.transform("_l", lambda x: x[c]), lambda v: v.isNotNull())
        return F.try_divide(F.aggregate(known, F.lit(0.0), lambda s, v: s + v), F.size(known))

    g = shots.groupBy("movie_id", group).agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.count(F.lit(1)).alias("n_shots"), order.alias("_l"))
    g = g.withColumns({c: mean(c) for c in signals[:-1]} | {"continuity": F.coalesce(mean("similarity"), F.lit(1.0))})
    g = g.withColumn("shot_ids", F.transform("_l", lambda x: x["shot_id"])).withColumn("narrative_ids", F.array_distinct(F.flatten(F.transform("_l", lambda x: x["ids"])))).drop("_l")
    many, talk = F.col("n_shots") > 1, F.col("occupancy") >= 0.22
    reasons = errors((F.lit(True), "technical_shot_continuity"), (many, "camera_cut_not_treated_as_asset_boundary"), (F.size("narrative_ids") == 1, "same_narrative_segment"), (talk, "subtitle_continuity"))
    kind = F.when(many & talk, "conversation").when(many, "interaction").otherwise("action")
    return g.withColumn("reasons", reasons).withColumn("kind", kind).withColumn("duration_s", F.col("end_s") - F.col("start_s"))


def scene_runs(shots: DataFrame) -> DataFrame:
    """Runs of consecutive shots (as for adjacent_edges) whose continuity allows a merge: movie_id, run (from 1), n_shots, shot_ids."""
    by = _title().orderBy("shot_ord")
    x = continuity(shots.withColumns({f"n_{c}": F.lead(c).over(by) for c in EDGE_COLUMNS})).select("movie_id", "shot_ord", "shot_id", "merge")
    x = x.withColumn("run", F.sum(F.when(F.coalesce(F.lag("merge").over(by), F.lit(False)), 0).otherwise(1)).over(by))
    g = x.groupBy("movie_id", "run").agg(F.count(F.lit(1)).alias("n_shots"), F.sort_array(F.collect_list(F.struct("shot_ord", "shot_id"))).alias("_l"))
    return g.select("movie_id", "run", "n_shots", F.transform("_l", lambda r: r["shot_id"]).alias("shot_ids"))


def event_health(events: DataFrame) -> DataFrame:
    """Events by bucket of duration: events, multi_shot, median and mean seconds."""
    d = F.col("duration_s")
    bucket = F.when(d < 3, "below_3").when(d < 5, "3_to_5").when(d < 10, "5_to_10").when(d <= 18, "10_to_18").otherwise("above_18")
    return events.withColumn("bucket", bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("n_shots") > 1).alias("multi_shot"), F.median(d).alias("median_s"), F.avg(d).alias("mean_s"))


def grouping_rows(shots: DataFrame, hists: DataFrame | None = None) -> DataFrame:
    """shots (as for adjacent_edges, with start_s, end_s, alone) as bounded_groups reads them: joined, talk and why tell of the edge to the next shot."""
    by = _title().orderBy("shot_ord")
    x = continuity(shots.withColumns({f"n_{c}": F.lead(c).over(by) for c in _edge_columns(shots)}))
    next_ = F.col("n_shot_id").isNotNull()
    no = lambda c: next_ & F.coalesce(c, F.lit(False))
    x = x.withColumns({"duration_s": F.col("end_s") - F.col("start_s"), "talk": no(F.col("dialogue")), "why": no(F.size("reasons") > 0), "next": next_, "merge": next_ & F.col("merge")})
    x = joined_edges(x, ["movie_id", "shot_ord", "shot_id", "duration_s", "talk", "why", "alone", "next"], hists)
    return x.select("movie_id", "shot_ord", "shot_id", "duration_s", (F.col("next") & F.coalesce("joined", F.lit(False))).alias("joined"), "talk", "why", "alone")


def _fold(rows: DataFrame, order: str, columns: list[str], state: str, start: str, step) -> DataFrame:
    """movie_id, island, order and no: what step(state, row) gives as no to each row of an island, in order."""
    row = F.struct(order, *columns)
    lists = rows.groupBy("movie_id", "island").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    kind = f"struct<s:struct<{state}>,out:array<int>>"

    def go(acc: Column, r: Column) -> Column:
        s = step(acc["s"], r)
        return F.struct(s.alias("s"), F.concat(acc["out"], F.array(s["no"])).alias("out"))

    done = lists.withColumn("no", F.aggregate("rows", F.from_json(F.lit('{"s":' + start + ',"out":[]}'), kind), go)["out"])
    return done.select("movie_id", "island", F.explode(F.arrays_zip(F.col(f"rows.{order}").alias(order), F.col("no").alias("no"))).alias("z")).select("movie_id", "island", f"z.{order}", "z.no")


def bounded_groups(rows: DataFrame, longest: float = LONGEST) -> DataFrame:
    """Greedy groups of shots: movie_id, group_no (from 1), first_ord, duration_s, alone, shot_ids.

    rows: movie_id, shot_ord, shot_id, duration_s, joined (to the next shot), talk (that join is a conversation), why (it
    has positive reasons), alone (the shot has value of its own). A group grows while it stays within longest seconds; a
    quiet one stops early at 5 s (one shot) or 15 s. Groups of 3 to longest seconds are kept. Titles fall into islands of
    joined neighbours first, so the fold runs over islands.
    """
    by = _title().orderBy("shot_ord")
    x = rows.withColumn("island", F.sum(F.when(F.coalesce(F.lag("joined").over(by), F.lit(False)), 0).otherwise(1)).over(by))

    def step(s: Column, r: Column) -> Column:
        """quiet: the edge that leads to the next row is neither speech nor reasoned; closed: that row begins a group."""
        d, quiet = r["duration_s"], ~r["talk"] & ~r["why"]
        fresh = s["closed"] | (s["d"] + d > longest)
        total = F.when(fresh, d).otherwise(s["d"] + d)
        closed = (~fresh & (total >= 15) & s["quiet"]) | (fresh & (r["alone"] | ((d >= 5) & quiet)))
        return F.struct((s["no"] + F.when(fresh, 1).otherwise(0)).alias("no"), total.alias("d"), quiet.alias("quiet"), closed.alias("closed"))

    state = "no:int,d:double,quiet:boolean,closed:boolean"
    no = _fold(x.select("movie_id", "island", "shot_ord", "duration_s", "talk", "why", "alone"), "shot_ord", ["duration_s", "talk", "why", "alone"], state, '{"no":0,"d":0.0,"quiet":false,"closed":true}', step)
    g = x.join(no.drop("island"), ["movie_id", "shot_ord"]).groupBy("movie_id", "island", "no").agg(
        F.min("shot_ord").alias("first_ord"), F.sort_array(F.collect_list(F.struct("shot_ord", "shot_id", "duration_s"))).alias("_l"), F.max("alone").alias("alone")
    )
    g = g.withColumn("duration_s", F.aggregate("_l", F.lit(0.0), lambda s, r: s + r["duration_s"])).where((F.col("duration_s") >= 3) & (F.col("duration_s") <= longest))
    group_no = F.row_number().over(_title().orderBy("first_ord")).cast("bigint")
    return g.select("movie_id", group_no.alias("group_no"), "first_ord", "duration_s", "alone", F.transform("_l", lambda r: r["shot_id"]).alias("shot_ids"))


def rescue_orphans(groups: DataFrame, shots: DataFrame, low: float = 3.0, high: float = 4.5, longest: float = LONGEST, hists: DataFrame | None = None) -> DataFrame:
    """Groups after those of low to high seconds have gone to a neighbour: movie_id, event_no, first_ord, duration_s, shot_ids.

    groups: as bounded_groups gives them; shots: as for adjacent_edges. A short group goes to the one before it, else to the one after it, if
    neither holds a shot of its own value, both together stay within longest seconds, and the shots at the seam would be
    joined. What a merge has made longer is no orphan any more, so one pass in order settles a title; it runs over islands of
    groups whose seams would be joined.
    """
    cols = _edge_columns(shots)
    by = _title().orderBy("group_no")
    g = groups.withColumns({"next_d": F.lead("duration_s").over(by), "next_alone": F.lead("alone").over(by), "_left": F.element_at("shot_ids", -1), "_right": F.lead(F.element_at("shot_ids", 1)).over(by)})
    seams = g.where("_right is not null").select("movie_id", "group_no", "_left", "_right")
    left = shots.select("movie_id", F.col("shot_id").alias("_left"), *cols)
    right = shots.select("movie_id", F.col("shot_id").alias("_right"), *[F.col(c).alias(f"n_{c}") for c in cols])
    joined = joined_edges(continuity(seams.join(left, ["movie_id", "_left"]).join(right, ["movie_id", "_right"])), ["movie_id", "group_no"], hists).withColumnRenamed("joined", "link")
    g = g.join(joined, ["movie_id", "group_no"], "left").withColumn("link", F.coalesce("link", F.lit(False)))
    g = g.withColumn("island", F.sum(F.when(F.coalesce(F.lag("link").over(by), F.lit(False)), 0).otherwise(1)).over(by))

    def step(s: Column, r: Column) -> Column:
        """take: the next row goes to this one's number."""
        d = r["duration_s"]
        orphan = (d >= low) & (d <= high) & ~r["alone"]
        back = s["take"] | (orphan & (s["no"] > 0) & ~s["alone"] & (s["d"] + d <= longest))
        ahead = ~back & orphan & r["link"] & ~r["next_alone"] & (d + r["next_d"] <= longest)
        no = s["no"] + F.when(back, 0).otherwise(1)
        return F.struct(no.alias("no"), F.when(back, s["d"] + d).otherwise(d).alias("d"), F.when(back, s["alone"]).otherwise(r["alone"]).alias("alone"), F.coalesce(ahead, F.lit(False)).alias("take"))

    names = ["duration_s", "alone", "link", "next_d", "next_alone"]
    no = _fold(g.select("movie_id", "island", "group_no", *names), "group_no", names, "no:int,d:double,alone:boolean,take:boolean", '{"no":0,"d":0.0,"alone":false,"take":false}', step)
    e = g.join(no.drop("island"), ["movie_id", "group_no"]).groupBy("movie_id", "island", "no").agg(F.min("first_ord").alias("first_ord"), F.sort_array(F.collect_list(F.struct("group_no", "duration_s", "shot_ids"))).alias("_l"))
    event_no = F.row_number().over(_title().orderBy("first_ord")).cast("bigint")
    return e.select("movie_id", event_no.alias("event_no"), "first_ord", F.aggregate("_l", F.lit(0.0), lambda s, r: s + r["duration_s"]).alias("duration_s"), F.flatten(F.transform("_l", lambda r: r["shot_ids"])).alias("shot_ids"))
