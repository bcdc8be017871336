"""The next stretch of each title to look at, the registry of those chosen so far, and control events chosen without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutlight.operators.intervals import overlapping
from cutlight.sources.versions import closed, drop

#: Seconds of a window: least, wanted, most; seconds at a title's ends that no window begins or ends in.
LEAST, NOMINAL, MOST, GUARD = 45.0, 60.0, 75.0, 30.0
# Relations with the words that state them, and words of what is no story.
RELATIONS = {
    "mother_daughter": ("mother and daughter", "madre e hija"), "father_daughter": ("father and daughter", "padre e hija"), "mother_son": ("mother and son", "madre e hijo"),
    "father_son": ("father and son", "padre e hijo"), "siblings": ("siblings", "hermanos", "hermanas"), "romantic_partner": ("romantic partner", "pareja", "novios"),
}
NO_STORY = ("credits", "créditos", "title card", "title sequence", "opening logo", "production logo")
#: Weights of the distances between a candidate and the windows looked at (fixed values).
WEIGHTS = {"narrative_segment_ids": 0.28, "interaction_context": 0.22, "tone": 0.16, "content_hints": 0.14}
AT_TIME, COHERENT = 0.10, 0.10
PROFILE = ("narrative_segment_ids", "interaction_context", "tone", "content_hints", "relationship_hints")
_REGISTRY = "movie_id bigint, window_id string, start_s double, end_s double, status string, pilot_status string, diversity_score double, selection_reason array<string>, " + ", ".join(f"{c} array<string>" for c in PROFILE)


def _mentions(text: Column, phrases: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | F.contains(text, F.lit(p))
    return F.coalesce(found, F.lit(False))


def profiles(ranges: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """movie_id, keys and the PROFILE of each range, sorted lists of what its segments say; unknown and unclear say nothing.

    ranges: movie_id, keys, start_s, end_s. segments: movie_id, segment_id, start_s, end_s, segment_type, narrative_function,
    narrative_tone, summary, opportunities (array). Relations are those that a summary states in so many words. The ids are in the segments' order.
    """
    summary = F.lower(F.coalesce("summary", F.lit("")))
    relations = F.array_compact(F.array(*[F.when(_mentions(summary, p), F.lit(name)) for name, p in RELATIONS.items()]))
    said = lambda c, *nothing: F.when(~F.col(c).isin(*nothing), F.col(c))
    hints = F.array_compact(F.concat(F.array(said("segment_type", "unknown")), F.filter(F.coalesce("opportunities", F.array().cast("array<string>")), lambda x: (x != "unknown") & (x != ""))))
    s = segments.select("movie_id", F.col("segment_id").alias("met_id"), "start_s", "end_s", said("narrative_function", "unknown").alias("met_function"), said("narrative_tone", "unclear").alias("met_tone"), hints.alias("met_hints"), relations.alias("met_relations"))
    met = overlapping(ranges.select("movie_id", *keys, "start_s", "end_s"), s)
    g = met.groupBy("movie_id", *keys).agg(
        F.sort_array(F.collect_list(F.struct("other_start_s", "met_id"))).alias("ids"), F.sort_array(F.collect_set("met_function")).alias("interaction_context"), F.sort_array(F.collect_set("met_tone")).alias("tone"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("met_hints")))).alias("content_hints"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("met_relations")))).alias("relationship_hints"),
    )
    g = g.withColumn("narrative_segment_ids", F.transform("ids", lambda x: x["met_id"]))
    out = ranges.select("movie_id", *keys).join(g, ["movie_id", *keys], "left")
    return out.select("movie_id", *keys, *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in PROFILE])


def candidates(segments: DataFrame, durations: DataFrame) -> DataFrame:
    """movie_id, segment_id, start_s, end_s, coherence (share of the window inside its segment): a window for each segment that can be story.

    durations: movie_id, duration_s. A segment longer than the window holds it, in its middle; a shorter one borrows from both sides.
    """
    x = segments.join(durations, "movie_id").where("duration_s > 0")
    left, right, whole = F.col("start_s"), F.col("end_s"), F.col("duration_s")
    length = F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.least(F.lit(NOMINAL), whole)))
    middle = (left + right) / 2
    inside = F.greatest(left, F.least(middle - length / 2, right - length))
    around = F.greatest(F.lit(0.0), F.least(middle - length / 2, F.greatest(F.lit(0.0), whole - length)))
    x = x.withColumn("a", F.when(right - left >= length, inside).otherwise(around)).withColumn("b", F.least(whole, F.col("a") + length)).withColumn("a", F.greatest(F.lit(0.0), F.col("b") - length))
    shared = F.greatest(F.lit(0.0), F.least("b", right) - F.greatest("a", left))
    x = x.withColumn("coherence", F.least(F.lit(1.0), shared / F.greatest(F.col("b") - F.col("a"), F.lit(0.001))))
    thousandth = lambda c: F.floor(F.col(c) * 1000 + 0.5) / 1000
    x = x.withColumn("a", thousandth("a")).withColumn("b", thousandth("b"))
    story = (F.col("a") >= GUARD) & (F.col("b") <= whole - GUARD) & ~_mentions(F.lower(F.coalesce("summary", F.lit(""))), NO_STORY)
    return x.where(story).select("movie_id", "segment_id", F.col("a").alias("start_s"), F.col("b").alias("end_s"), "coherence")


def next_windows(segments: DataFrame, registry: DataFrame, durations: DataFrame) -> DataFrame:
    """The window to look at next in each title that has none selected: rows like the registry's, with status SELECTED; titles without a free window have no row.

    A candidate that overlaps a TESTED or LEGACY window is out (an anti-join in time buckets). The others are scored by their least
    distance, in each part of the profile and in time, to all of these windows: a title's windows do not overlap, so they are few
    enough to stand in one list beside each candidate. Of equal scores the more coherent, then the earlier, then the last segment id.
    """
    seen = registry.where(F.col("status").isin("TESTED", "LEGACY"))
    busy = registry.where("status = 'SELECTED'").select("movie_id").distinct()
    cand = candidates(segments, durations).join(busy, "movie_id", "left_anti")
    taken = overlapping(cand, seen.select("movie_id", "start_s", "end_s")).select("movie_id", "segment_id").distinct()
    cand = cand.join(taken, ["movie_id", "segment_id"], "left_anti")
    cand = cand.join(profiles(cand, segments, ["segment_id"]), ["movie_id", "segment_id"])
    window = F.struct(((F.col("start_s") + F.col("end_s")) / 2).alias("middle"), *WEIGHTS)
    x = cand.join(seen.groupBy("movie_id").agg(F.collect_list(window).alias("seen")), "movie_id", "left").join(durations, "movie_id")

    def distance(name: str) -> Column:
        one = lambda w: F.lit(1.0) - F.size(F.array_intersect(F.col(name), w[name])) / F.size(F.array_union(F.col(name), w[name]))
        return F.when(F.size(name) == 0, F.lit(0.0)).otherwise(F.array_min(F.transform("seen", one)))

    middle, region = (F.col("start_s") + F.col("end_s")) / 2, F.greatest(F.col("duration_s") * 0.25, F.lit(1.0))
    away = F.least(F.lit(1.0), F.array_min(F.transform("seen", lambda w: F.abs(middle - w["middle"]) / region)))
    x = x.withColumns({f"d_{c}": distance(c) for c in WEIGHTS} | {"d_time": away})
    score = AT_TIME * F.col("d_time") + COHERENT * F.col("coherence")
    for c, w in WEIGHTS.items():
        score = score + w * F.col(f"d_{c}")
    score = F.when(F.col("seen").isNull(), 0.45 + 0.25 * F.col("coherence")).otherwise(score)
    x = x.withColumn("diversity_score", F.floor(score * 10000 + 0.5) / 10000)
    when = lambda cond, name: F.when(cond, F.lit(name))
    reasons = F.array_compact(F.array(F.lit("different_narrative_segment"), when(F.col("d_interaction_context") >= 0.5, "different_interaction_context"), when(F.col("d_tone") >= 0.5, "different_tone"), when(F.col("d_time") >= 0.5, "different_movie_region"), when(F.col("coherence") >= 0.75, "coherent_narrative_context")))
    x = x.withColumn("selection_reason", F.when(F.col("seen").isNull(), F.array(F.lit("coherent_narrative_context"))).otherwise(reasons))
    kept = ["segment_id", "start_s", "end_s", "diversity_score", "selection_reason", *PROFILE]
    best = x.groupBy("movie_id").agg(F.max_by(F.struct(*kept), F.struct("diversity_score", "coherence", -F.col("start_s"), "segment_id")).alias("w")).select("movie_id", "w.*")
    # the segment that the window was made for stands for its segments, as the profile keeps all of them
    numbers = registry.select("movie_id", F.regexp_extract("window_id", "^SW_([0-9]+)$", 1).try_cast("bigint").alias("no")).where("no is not null").groupBy("movie_id").agg(F.collect_set("no").alias("used"))
    best = best.join(numbers, "movie_id", "left").withColumn("used", F.coalesce("used", F.array().cast("array<bigint>")))
    free = F.array_min(F.array_except(F.sequence(F.lit(1).cast("bigint"), F.size("used").cast("bigint") + 1), F.col("used")))
    return best.select(
        "movie_id", F.concat(F.lit("SW_"), F.lpad(free.cast("string"), F.greatest(F.lit(2), F.length(free.cast("string"))), F.lit("0"))).alias("window_id"), "start_s", "end_s", F.lit("SELECTED").alias("status"),
        F.lit(None).cast("string").alias("pilot_status"), "diversity_score", "selection_reason", *PROFILE,
    )


class WindowRegistry:
    """All windows of all titles under one folder that driver and executors share, one subfolder a version.

    A version counts once Spark's writer has closed it; a run that dies before leaves an open folder, which nobody reads and the
    next one writes over. So select() and mark() change all titles or none. One writer at a time; older versions than the last two
    are dropped.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """Numbers of the closed versions, rising."""
        return closed(self.spark, self.path, "version")

    def read(self) -> DataFrame:
        """The rows of the last closed version; none before the first one."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], _REGISTRY)
        return self.spark.read.schema(_REGISTRY).parquet(f"{self.path}/version={found[-1]}")

    def publish(self, rows: DataFrame) -> DataFrame:
        """rows as the next version; they may come from the last one."""
        found = self.versions()
        number = found[-1] + 1 if found else 1
        columns = [f.name for f in self.spark.createDataFrame([], _REGISTRY).schema.fields]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.path}/version={number}")
        for old in found[:-1]:
            drop(self.spark, f"{self.path}/version={old}")
        return self.read()

    def select(self, segments: DataFrame, durations: DataFrame) -> DataFrame:
        """The SELECTED window of each title; titles without one get their next window first, a title that has one keeps it."""
        rows = self.read()
        new = next_windows(segments, rows, durations)
        if not new.isEmpty():
            rows = self.publish(rows.unionByName(new))
        return rows.where("status = 'SELECTED'")

    def mark(self, attempts: DataFrame) -> None:
        """Windows that were tried become TESTED. attempts: movie_id, window_id, attempt (what became of it)."""
        rows = self.read()
        got = attempts.groupBy("movie_id", "window_id").agg(F.max("attempt").alias("attempt"))
        x = rows.join(got, ["movie_id", "window_id"], "left")
        tried = F.col("attempt").isNotNull()
        x = x.withColumn("status", F.when(tried, "TESTED").otherwise(F.col("status"))).withColumn("pilot_status", F.coalesce("attempt", "pilot_status"))
        if not x.where(tried).isEmpty():
            self.publish(x)


# The kinds of positive controls, in order, with the words that show them.
CONTROL_RULES = (
    ("movement", ("walking", "camina", "aleja")), ("object_activity", ("maquill", "makeup", "espejo", "mirror", "bebe", "copa", "cajón", "drawer")),
    ("interaction", ("touching", "hombro", "abraza", "acaricia", "face_to_face")), ("reaction", ("observa", "mirar", "looking", "listen", "escucha")),
    ("emotional_state", ("resting head", "apoya su cabeza")), ("action", ("carrying", "lleva comida", "gesticul", "lanzando besos")),
)


def positive_controls(events: DataFrame, wanted: int = 6, rules=CONTROL_RULES) -> DataFrame:
    """Control events of each title, chosen among its KEEPs: movie_id, place, event_id, category, enough (there are as many as wanted).

    events: movie_id, event_id, ordinal, decision, text. Each rule takes its first event, by ordinal and id, that no earlier rule took;
    then the first others fill up. A rule needs no more than its first matches, one for each rule before it and one more, so a fold over these
    few is all that a title needs in one place.
    """
    keeps = events.where("decision = 'KEEP'")
    text = F.lower(F.coalesce("text", F.lit("")))
    rule = F.array_compact(F.array(*[F.when(_mentions(text, terms), F.lit(i)) for i, (_, terms) in enumerate(rules)], F.lit(len(rules))))
    hit = keeps.select("movie_id", "event_id", F.coalesce("ordinal", F.lit(0)).cast("bigint").alias("ordinal"), F.explode(rule).alias("rule"))
    nth = F.row_number().over(Window.partitionBy("movie_id", "rule").orderBy("ordinal", "event_id"))
    hit = hit.withColumn("nth", nth).where(F.col("nth") <= len(rules) + wanted)
    per = hit.groupBy("movie_id", "rule").agg(F.sort_array(F.collect_list(F.struct("ordinal", "event_id"))).alias("found"))
    per = per.groupBy("movie_id").agg(F.sort_array(F.collect_list(F.struct("rule", "found"))).alias("rules"))
    kind = f"array<struct<event_id: {keeps.schema['event_id'].dataType.simpleString()}, rule: int>>"

    def step(taken: Column, r: Column) -> Column:
        free = F.filter(r["found"], lambda e: ~F.exists(taken, lambda t: t["event_id"] == e["event_id"]))
        room = F.when(r["rule"] < len(rules), F.lit(1)).otherwise(F.greatest(F.lit(0), wanted - F.size(taken)))
        return F.concat(taken, F.transform(F.slice(free, F.lit(1), room), lambda e: F.struct(e["event_id"].alias("event_id"), r["rule"].alias("rule")))).cast(kind)

    x = per.withColumn("taken", F.aggregate("rules", F.array().cast(kind), step))
    names = F.array(*[F.lit(f"positive_control:{name}") for name, _ in rules], F.lit("positive_control:canonical_keep"))
    x = x.select("movie_id", (F.size("taken") == wanted).alias("enough"), F.posexplode("taken").alias("at", "t"))
    return x.select("movie_id", (F.col("at") + 1).alias("place"), "t.event_id", F.get(names, F.col("t.rule")).alias("category"), "enough")


def requested_controls(events: DataFrame, requested: list[tuple], key: str) -> DataFrame:
    """The events that a list of controls names, for each title: movie_id, category, key, label, event_id (null: the title has no such event).

    requested: (category, key, label), a short list; key: a column of events, an id or an ordinal. As many rows as titles times the list.
    """
    kind = events.schema[key].dataType.simpleString()
    listed = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(k).cast(kind).alias(key), F.lit(name).alias("label")) for c, k, name in requested])
    asked = events.select("movie_id").distinct().select("movie_id", F.inline(listed))
    return asked.join(events.select("movie_id", key, "event_id"), ["movie_id", key], "left").select("movie_id", "category", key, "label", "event_id")
