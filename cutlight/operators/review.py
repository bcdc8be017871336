"""Temporal samples, asset windows, seams between chunks, and smaller review rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_FRAMES = 16


def sample_plan(shots: DataFrame, most: int = MOST_FRAMES) -> DataFrame:
    """Frames to look at in each event: movie_id, event, sample_id, shot_id, frame, roles, error.

    shots: movie_id, event, shot_id, start_frame, end_frame, lively. Every shot's middle and the event's ends are a must;
    then the shots' begins and ends, then quarter points of lively events from the longest shot on, while there is room.
    Frames that are wanted for several reasons count once. An event whose musts exceed the room is one error row.
    """
    by = Window.partitionBy("movie_id", "event").orderBy("start_frame", "shot_id")
    size = F.col("end_frame") - F.col("start_frame")
    x = shots.withColumn("r", F.row_number().over(by)).withColumn("back", F.row_number().over(Window.partitionBy("movie_id", "event").orderBy(F.desc("start_frame"), F.desc("shot_id")))).withColumn("long", F.row_number().over(Window.partitionBy("movie_id", "event").orderBy(F.desc(size), "start_frame")))
    at = lambda step, order, frame, role: F.struct(F.lit(step).alias("step"), order.cast("int").alias("o"), frame.cast("bigint").alias("frame"), F.lit(role).alias("role"))
    first, last = F.col("start_frame"), F.col("end_frame") - 1
    quarter = lambda f: F.col("start_frame") + F.floor((size - 1) * f)
    wants = F.array_compact(F.array(
        at(1, F.col("r"), F.floor((F.col("start_frame") + F.col("end_frame") - 1) / 2), "middle"), F.when(F.col("r") == 1, at(2, F.lit(0), first, "begin")), F.when(F.col("back") == 1, at(3, F.lit(0), last, "end")),
        at(4, F.col("r"), first, "begin"), at(5, F.col("r"), last, "end"), F.when(F.col("lively"), at(6, F.col("long") * 2, quarter(0.25), "development")), F.when(F.col("lively"), at(6, F.col("long") * 2 + 1, quarter(0.75), "development")),
    ))
    w = x.select("movie_id", "event", "shot_id", F.explode(wants).alias("w")).select("movie_id", "event", "shot_id", "w.*")
    g = w.groupBy("movie_id", "event", "shot_id", "frame").agg(F.min(F.struct("step", "o")).alias("p"), F.collect_set("role").alias("roles"))
    turn = F.row_number().over(Window.partitionBy("movie_id", "event").orderBy("p", "frame", "shot_id"))
    musts = F.count_if(F.col("p.step") <= 3).over(Window.partitionBy("movie_id", "event"))
    g = g.withColumn("turn", turn).withColumn("musts", musts)
    good = g.where((F.col("musts") <= most) & (F.col("turn") <= most))
    n = F.row_number().over(Window.partitionBy("movie_id", "event").orderBy("frame", "shot_id"))
    order = F.filter(F.array(*[F.lit(r) for r in ("begin", "middle", "end", "development")]), lambda r: F.array_contains("roles", r))
    rows = good.select("movie_id", "event", F.format_string("SAMPLE_%02d", n).alias("sample_id"), "shot_id", "frame", order.alias("roles"), F.lit(None).cast("string").alias("error"))
    bad = g.where(F.col("musts") > most).select("movie_id", "event").distinct()
    none = [F.lit(None).cast(t).alias(c) for c, t in (("sample_id", "string"), ("shot_id", "string"), ("frame", "bigint"), ("roles", "array<string>"))]
    return rows.union(bad.select("movie_id", "event", *none, F.lit("coverage exceeds the cap").alias("error")))


def asset_windows(moments: DataFrame, fps: int, longest_s: int = 20, near: float = 0.8) -> DataFrame:
    """What becomes of each moment: movie_id, moment, state, start_frame, end_frame.

    moments: movie_id, ord, moment, kind, start_frame, end_frame, reuse_key, weak, clear. State WEAK, REVIEW, SUPPRESSED or WINDOW. States
    longer than longest_s are cut to their central part, complete actions stay whole, other long ones go to review. In a title's
    order a window falls away if an accepted one has its key or overlaps it by near of the shorter; since only
    accepted ones count, it is a fold over the title, with what is accepted as its state.
    """
    most = longest_s * fps
    size = F.col("end_frame") - F.col("start_frame")
    state = F.when(F.col("weak"), "WEAK").when(~F.col("clear") | (F.col("kind") == "unclear"), "REVIEW").when((size > most) & ~F.col("kind").isin("sustained_state", "composition", "complete_action"), "REVIEW").otherwise("CANDIDATE")
    clip = (size > most) & F.col("kind").isin("sustained_state", "composition")
    a = F.when(clip, F.col("start_frame") + F.floor((size - most) / 2)).otherwise(F.col("start_frame"))
    x = moments.withColumn("state", state).withColumn("a", a).withColumn("b", F.when(clip, F.col("a") + most).otherwise(F.col("end_frame")))
    rows = x.where("state = 'CANDIDATE'").groupBy("movie_id").agg(F.sort_array(F.collect_list(F.struct("ord", "moment", "a", "b", F.col("reuse_key").cast("string").alias("key")))).alias("rows"))
    none = F.array().cast("array<struct<moment:bigint,a:bigint,b:bigint,key:string>>")

    def step(kept: Column, r: Column) -> Column:
        shared = lambda p: F.greatest(F.lit(0), F.least(r["b"], p["b"]) - F.greatest(r["a"], p["a"]))
        again = F.exists(kept, lambda p: (p["key"] == r["key"]) | (shared(p) >= near * F.least(r["b"] - r["a"], p["b"] - p["a"])))
        return F.when(again, kept).otherwise(F.concat(kept, F.array(F.struct(r["moment"].cast("bigint").alias("moment"), r["a"].cast("bigint").alias("a"), r["b"].cast("bigint").alias("b"), r["key"].alias("key")))))

    kept = rows.select("movie_id", F.explode(F.aggregate("rows", none, step)).alias("k")).select("movie_id", F.col("k.moment").alias("moment"), F.lit(True).alias("kept"))
    out = x.join(kept, ["movie_id", "moment"], "left")
    final = F.when(F.col("state") != "CANDIDATE", F.col("state")).when(F.col("kept"), "WINDOW").otherwise("SUPPRESSED")
    won = F.col("state") == "WINDOW"
    return out.withColumn("state", final).select("movie_id", "moment", "state", F.when(won, F.col("a")).alias("start_frame"), F.when(won, F.col("b")).alias("end_frame"))


def choose_seams(boundaries: DataFrame, overlaps: DataFrame, cues: DataFrame) -> DataFrame:
    """The cue after which the left chunk ends, for each pair of neighbouring chunks: movie_id, chunk, seam, reason.

    boundaries: movie_id, chunk, at (cue ordinal that ends a segment), new (the cut is a new interaction); overlaps:
    movie_id, chunk (the left one), low, high (first and last shared cue). The best boundary from low up to high - 1 wins, by: a
    new interaction, in both chunks, next to one of the other chunk, the longest pause, nearness to the overlap's middle, the
    earliest. Without any boundary every cue of the overlap is a candidate.
    """
    o = overlaps.where("low < high")
    side = lambda c, name: boundaries.select("movie_id", (F.col("chunk") - c).alias("chunk"), "at", "new").join(o, ["movie_id", "chunk"]).where("at >= low and at < high").select("movie_id", "chunk", "at", "new", F.lit(name).alias("side"))
    b = side(0, "l").union(side(1, "r"))
    g = b.groupBy("movie_id", "chunk", "at").agg(F.max(F.col("new").cast("int")).alias("new"), F.max((F.col("side") == "l").cast("int")).alias("l"), F.max((F.col("side") == "r").cast("int")).alias("r"))
    other = g.select("movie_id", "chunk", F.explode(F.array(F.col("at") - 1, F.col("at") + 1)).alias("at"), F.col("l").alias("nl"), F.col("r").alias("nr")).groupBy("movie_id", "chunk", "at").agg(F.max("nl").alias("nl"), F.max("nr").alias("nr"))
    g = g.join(other, ["movie_id", "chunk", "at"], "left").na.fill(0, ["nl", "nr"])
    both = (F.col("l") == 1) & (F.col("r") == 1)
    near = ~both & (((F.col("l") == 1) & (F.col("nr") == 1)) | ((F.col("r") == 1) & (F.col("nl") == 1)))
    g = g.select("movie_id", "chunk", "at", "new", both.cast("int").alias("both"), near.cast("int").alias("near"), F.lit(0).alias("fallback"))
    rest = o.join(g.select("movie_id", "chunk").distinct(), ["movie_id", "chunk"], "left_anti")
    zero = [F.lit(0).alias(c) for c in ("new", "both", "near")]
    all_ = g.union(rest.select("movie_id", "chunk", F.explode(F.sequence("low", F.col("high") - 1)).alias("at"), *zero, F.lit(1).alias("fallback")))
    at = lambda name, shift: cues.select("movie_id", (F.col("cue_ord") - shift).alias("at"), F.col("start_s").alias(f"{name}_s"), F.col("end_s").alias(f"{name}_e"))
    ends = o.join(cues.select("movie_id", F.col("cue_ord").alias("low"), F.col("start_s").alias("from_s")), ["movie_id", "low"]).join(cues.select("movie_id", F.col("cue_ord").alias("high"), F.col("end_s").alias("to_s")), ["movie_id", "high"]).select("movie_id", "chunk", ((F.col("from_s") + F.col("to_s")) / 2).alias("mid"))
    x = all_.join(at("here", 0), ["movie_id", "at"]).join(at("next", 1), ["movie_id", "at"]).join(ends, ["movie_id", "chunk"])
    pause = F.round(F.greatest(F.lit(0.0), F.col("next_s") - F.col("here_e")), 6)
    score = F.struct("new", "both", "near", pause.alias("pause"), F.round(-F.abs((F.col("here_e") + F.col("next_s")) / 2 - F.col("mid")), 6).alias("central"), (-F.col("at")).alias("first"))
    best = x.groupBy("movie_id", "chunk").agg(F.max_by(F.struct("at", "new", "both", "near", "fallback"), score).alias("b"))
    why = F.when(F.col("b.fallback") == 1, "midpoint_fallback").when(F.col("b.both") == 1, "consensus_boundary").when(F.col("b.near") == 1, "near_consensus_boundary").otherwise("narrative_boundary")
    return best.select("movie_id", "chunk", F.col("b.at").alias("seam"), F.concat(why, F.when(F.col("b.new") == 1, "+new_interaction").otherwise("")).alias("reason"))


def next_free_number(used: DataFrame, key: str, number: str) -> DataFrame:
    """key, next: the smallest number from 1 that a key does not use."""
    top = used.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    all_ = top.select(key, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n") + 1)).alias(number))
    return all_.join(used.select(key, number).distinct(), [key, number], "left_anti").groupBy(key).agg(F.min(number).alias("next"))


def take_class(counts: DataFrame) -> DataFrame:
    """movie_id, threshold (the middle one), take: counts is movie_id, threshold, n_cuts of a sweep.

    No cut at the lowest threshold: a long take; two cuts or more lost between the lowest and the highest: too conservative.
    """
    g = counts.groupBy("movie_id").agg(F.array_sort(F.collect_set("threshold")).alias("t"), F.max_by("n_cuts", -F.col("threshold")).alias("low"), F.max_by("n_cuts", "threshold").alias("high"))
    take = F.when(F.col("low") == 0, "LIKELY_TRUE_LONG_TAKE").when(F.col("low") - F.col("high") >= 2, "TOO_CONSERVATIVE").otherwise("INCONCLUSIVE")
    return g.select("movie_id", F.get("t", F.floor(F.size("t") / 2).cast("int")).alias("threshold"), take.alias("take"))


def next_strategy(strategy: Column, status: Column, face: Column, repairable: Column) -> Column:
    """The crop strategy to try next; null: none."""
    stop = (status == "PASS") | (strategy == "face_priority") | face.isin("SOURCE_LIMIT", "AMBIGUOUS", "ERROR")
    return F.when(stop, F.lit(None).cast("string")).when(repairable, "face_priority").when(strategy == "subject_focus", "interaction_aware")


def first_decisions(decisions: DataFrame) -> DataFrame:
    """asset, decision, conflicts: the first decision of each asset stands; later ones that differ are conflicts. decisions: asset, ts_us, decision."""
    first = decisions.groupBy("asset").agg(F.min_by("decision", F.struct("ts_us", "decision")).alias("first"))
    x = decisions.join(first, "asset")
    return x.groupBy("asset", F.col("first").alias("decision")).agg(F.count_if(F.col("decision") != F.col("first")).alias("conflicts"))


def retry_allowance(attempts: DataFrame, most: int) -> DataFrame:
    """movie_id, attempts, failed, left: tries that remain to each title; attempts: movie_id, ok."""
    g = attempts.groupBy("movie_id").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(~F.col("ok")).alias("failed"))
    return g.withColumn("left", F.greatest(F.lit(0), most - F.col("failed")))


def coherence(events: DataFrame, edges: DataFrame) -> DataFrame:
    """movie_id, event, status of events (movie_id, event, shot_ids) against edges (movie_id, shot_id, next_id, merge).

    PASS: one shot, or every neighbouring pair has an edge that merges; LEGACY_UNVERIFIED: none of the pairs has an edge; else SPLIT_REQUIRED.
    """
    pairs = events.select("movie_id", "event", F.size("shot_ids").alias("n"), F.posexplode_outer(F.when(F.size("shot_ids") > 1, F.arrays_zip(F.slice("shot_ids", F.lit(1), F.size("shot_ids") - 1).alias("a"), F.slice("shot_ids", F.lit(2), F.size("shot_ids") - 1).alias("b")))).alias("at", "p"))
    e = edges.select("movie_id", F.col("shot_id").alias("a"), F.col("next_id").alias("b"), "merge")
    x = pairs.select("movie_id", "event", "n", F.col("p.a").alias("a"), F.col("p.b").alias("b")).join(e, ["movie_id", "a", "b"], "left")
    g = x.groupBy("movie_id", "event", "n").agg(F.count("merge").alias("known"), F.count_if(F.col("merge")).alias("merged"))
    status = F.when((F.col("n") <= 1) | (F.col("merged") == F.col("n") - 1), "PASS").when(F.col("known") == 0, "LEGACY_UNVERIFIED").otherwise("SPLIT_REQUIRED")
    return g.select("movie_id", "event", status.alias("status"))


def optimal_partition(items: DataFrame, scores: DataFrame) -> DataFrame:
    """The split of each run into consecutive parts with the greatest sum of scores: movie_id, run, part_start, part_end.

    items: movie_id, run, n (length); scores: movie_id, run, i, j, score of the part i..j (from 1, both included), for the parts that are
    allowed. Of equal sums the one whose last part begins earliest wins. Parts are bounded in length, so a run has few of them; the
    best sum up to each end is a fold over the run's ends.
    """
    by_end = scores.groupBy("movie_id", "run", "j").agg(F.sort_array(F.collect_list(F.struct("i", "score"))).alias("parts"))
    rows = by_end.groupBy("movie_id", "run").agg(F.sort_array(F.collect_list(F.struct("j", "parts"))).alias("rows"))
    # best[k]: (sum, begin of the last part) of the first k items; best[0] = (0, 0)
    start = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(0).cast("bigint").alias("i")))

    def step(best: Column, r: Column) -> Column:
        options = F.transform(r["parts"], lambda p: F.struct((F.element_at(best, p["i"].cast("int"))["total"] + p["score"]).alias("total"), p["i"].cast("bigint").alias("i")))
        first = F.get(options, 0)
        top = F.aggregate(options, first, lambda a, b: F.when(b["total"] > a["total"], b).otherwise(a))
        return F.concat(best, F.array(top))

    best = rows.withColumn("best", F.aggregate("rows", start, step)).select("movie_id", "run", "best")
    ends = best.withColumn("n", F.size("best") - 1)

    def back(path: Column, _: Column) -> Column:
        at = F.element_at(path["best"], path["at"].cast("int") + 1)["i"]
        return F.when(path["at"] <= 0, path).otherwise(F.struct(path["best"].alias("best"), (at - 1).alias("at"), F.concat(path["out"], F.array(F.struct(at.alias("i"), path["at"].alias("j")))).alias("out")))

    seed = F.struct(F.col("best"), F.col("n").cast("bigint").alias("at"), F.array().cast("array<struct<i:bigint,j:bigint>>").alias("out"))
    walked = ends.withColumn("w", F.aggregate(F.sequence(F.lit(1), F.col("n")), seed, back))
    return walked.select("movie_id", "run", F.explode("w.out").alias("p")).select("movie_id", "run", F.col("p.i").alias("part_start"), F.col("p.j").alias("part_end"))


def stale_fingerprints(current: DataFrame, stored: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """keys, state: FRESH, STALE (a part has changed) or NEW, by the digest of strings and whole numbers in the order of their names."""
    mark = F.sha2(F.to_json(F.struct(*sorted(parts)), {"ignoreNullFields": "false"}).cast("binary"), 256)
    a, b = current.select(*keys, mark.alias("a")), stored.select(*keys, mark.alias("b"))
    return a.join(b, keys, "left").select(*keys, F.when(F.col("b").isNull(), "NEW").when(F.col("a") == F.col("b"), "FRESH").otherwise("STALE").alias("state"))


def requeue_batches(batches: DataFrame, state: DataFrame, terminal: list[str]) -> DataFrame:
    """movie_id, batch, open: batches (movie_id, batch, event_id) that have events without a terminal state, and how many."""
    done = state.where(F.col("status").isin(*terminal)).select("movie_id", "event_id").distinct()
    left = batches.join(done, ["movie_id", "event_id"], "left_anti")
    return left.groupBy("movie_id", "batch").agg(F.count(F.lit(1)).alias("open"))


def repair_list(audits: DataFrame, files: DataFrame) -> DataFrame:
    """asset, state: REPAIR for assets whose audit says so and whose file is the one audited, STALE where the file has changed."""
    x = audits.where("decision = 'REPAIR'").join(files.select("asset", F.col("sha").alias("now")), "asset", "left")
    return x.select("asset", F.when(F.col("sha").eqNullSafe(F.col("now")), "REPAIR").otherwise("STALE").alias("state"))


def combined_audit(audits: DataFrame) -> DataFrame:
    """movie_id, n by decision of audits (face, person): a face that passes beside a person that does not is ambiguous; else the face's decision, if any."""
    d = F.when((F.col("face") == "PASS") & (F.col("person") != "PASS"), "AMBIGUOUS").otherwise(F.coalesce("face", "person"))
    return audits.withColumn("d", d).groupBy("movie_id", F.col("d").alias("decision")).agg(F.count(F.lit(1)).alias("n"))


def observation_status(events: DataFrame, records: DataFrame) -> DataFrame:
    """movie_id, cached, missing, records, and records of each contract."""
    has = records.where("valid").select("movie_id", "event_id").distinct().withColumn("hit", F.lit(1))
    a = events.join(has, ["movie_id", "event_id"], "left").groupBy("movie_id").agg(F.count("hit").alias("cached"), F.count_if(F.col("hit").isNull()).alias("missing"))
    b = records.groupBy("movie_id").agg(F.count(F.lit(1)).alias("records"), *[F.count_if(F.col("contract") == c).alias(c) for c in ("v1", "temporal_v2", "visual_reuse")])
    return a.join(b, "movie_id", "left")


def bind_labels(mentions: DataFrame, catalog: DataFrame, prefix: str) -> DataFrame:
    """mentions (movie_id, event_id, ord, label) with id: the catalog's id of the label (trimmed, any case), else a new one from its number."""
    norm = lambda c: F.lower(F.trim(c))
    c = catalog.groupBy("movie_id", norm(F.col("label")).alias("_l")).agg(F.min("id").alias("_id"))
    x = mentions.withColumn("_l", norm(F.col("label"))).join(c, ["movie_id", "_l"], "left")
    return x.select("movie_id", "event_id", "ord", "label", F.coalesce("_id", F.format_string(prefix + "_%03d", "ord")).alias("id"))


def forbidden_keys(rows: DataFrame, json_col: str, keys: list[str]) -> DataFrame:
    """rows with found: the forbidden keys that stand anywhere in a JSON text, in order."""
    names = F.regexp_extract_all(F.col(json_col), F.lit(r'"([A-Za-z0-9_]+)"\s*:'), F.lit(1))
    return rows.withColumn("found", F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isin(*keys)))))
