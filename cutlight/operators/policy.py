"""Observation records, their precedence, and the rules that decide what to keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds of visual utility and conversation signals that make a moment useful by themselves.
GENERIC = ("generic_dialogue_only", "generic_presence_only")
USEFUL_UTILITIES = ("concrete_action", "useful_state", "clear_reaction", "physical_interaction", "movement", "object_activity", "environment", "strong_nonverbal_interaction")
USEFUL_SIGNALS = ("clear_reaction", "strong_body_language", "physical_interaction", "concrete_activity", "useful_environment_or_composition")
PRECEDENCE = ("utility", "visual_reuse", "temporal_v2", "v1")


def latest_records(records: DataFrame) -> DataFrame:
    """The record that counts of each event: valid, of the strongest contract, the latest; ties by fingerprint.

    records: movie_id, event_id, contract, created_us, valid, fingerprint.
    """
    rank = F.array_position(F.array(*[F.lit(c) for c in PRECEDENCE]), F.col("contract"))
    best = F.struct(-F.when(rank == 0, 99).otherwise(rank), "created_us", "fingerprint")
    rest = [c for c in records.columns if c not in ("movie_id", "event_id")]
    g = records.where("valid").groupBy("movie_id", "event_id").agg(F.max_by(F.struct(*rest), best).alias("_r"))
    return g.select("movie_id", "event_id", "_r.*")


def decide(observations: DataFrame) -> DataFrame:
    """movie_id, event_id, decision and reasons by the first rule that holds.

    observations: utility, signal, complete, context, flags (hard exclusions), n_actions; a null among the first four: REVIEW.
    """
    u, s, c, x = (F.col(n) for n in ("utility", "signal", "complete", "context"))
    useful_signal = s.isin(*USEFUL_SIGNALS)
    one = lambda text: F.array(F.lit(text))
    keep = F.array_compact(F.array(F.concat(F.lit("useful_visual_utility:"), u), F.when(useful_signal, F.concat(F.lit("independent_conversation_signal:"), s))))
    rules: list[tuple[Column, str, Column]] = [
        (u.isNull() | s.isNull() | c.isNull() | x.isNull(), "REVIEW", one("observation_incomplete_or_invalid")),
        (F.size("flags") > 0, "REJECT", F.transform("flags", lambda f: F.concat(F.lit("hard_exclusion:"), f))),
        (u.isin(*GENERIC) & ~useful_signal, "REJECT", one("generic_dialogue_or_presence_without_independent_visual_signal")),
        ((u == "unclear") | (c == "unclear") | (x == "unclear"), "REVIEW", one("insufficient_observation")),
        (x == "high", "REJECT", one("high_context_dependency")),
        (c == "false", "REJECT", one("incomplete_moment_without_reusable_state")),
        (u.isin("concrete_action", "object_activity") & (F.col("n_actions") == 0), "REVIEW", one("action_utility_without_canonical_action_evidence")),
        (u.isin(*USEFUL_UTILITIES) | useful_signal, "KEEP", keep),
    ]
    decision, reasons = F.when(F.lit(False), ""), F.when(F.lit(False), F.array().cast("array<string>"))
    for rule, what, why in rules:
        decision, reasons = decision.when(rule, what), reasons.when(rule, why)
    return observations.select("movie_id", "event_id", decision.otherwise("REVIEW").alias("decision"), reasons.otherwise(one("unclassified_visual_utility")).alias("reasons"))


def transitions(old: DataFrame, new: DataFrame) -> DataFrame:
    """old_decision, new_decision, n and the sorted event_ids of events that both decide."""
    x = old.select("event_id", F.col("decision").alias("old_decision")).join(new.select("event_id", F.col("decision").alias("new_decision")), "event_id")
    return x.groupBy("old_decision", "new_decision").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("event_id")).alias("event_ids"))


def effective_decision(proposed: Column, errors: Column) -> Column:
    """The proposed decision if nothing is wrong with it, else REVIEW; null where nothing was proposed."""
    return F.when(proposed.isNull(), F.lit(None).cast("string")).when(F.size(errors) == 0, proposed).otherwise("REVIEW")


def observation_errors(utilities: tuple, signals: tuple, complete: tuple, context: tuple) -> Column:
    """Codes of what an observation lacks or says outside its vocabulary."""
    from cutlight.functions.columns import errors

    rules = []
    for name, known in (("utility", utilities), ("signal", signals), ("complete", complete), ("context", context)):
        rules += [(F.col(name).isNull(), f"missing:{name}"), (~F.col(name).isin(*known), f"unknown:{name}")]
    return errors(*rules, (F.col("flags").isNull(), "missing:flags"))


def enrichment_plan(events: DataFrame, records: DataFrame) -> DataFrame:
    """Per title the number of events by bucket: COMPLETED (a valid enriched record), RESOLVED (a valid base one), PAID (only invalid ones), MISSING."""
    r = records.groupBy("movie_id", "event_id").agg(F.max((F.col("valid") & (F.col("contract") != "v1")).cast("int")).alias("rich"), F.max(F.col("valid").cast("int")).alias("any"))
    x = events.select("movie_id", "event_id").join(r, ["movie_id", "event_id"], "left")
    bucket = F.when(F.col("rich") == 1, "COMPLETED").when(F.col("any") == 1, "RESOLVED").when(F.col("any") == 0, "PAID").otherwise("MISSING")
    return x.groupBy("movie_id", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def without_valid_record(events: DataFrame, records: DataFrame) -> DataFrame:
    """Events that no valid record describes."""
    return events.join(records.where("valid").select("movie_id", "event_id"), ["movie_id", "event_id"], "left_anti")


def scarce(candidates: DataFrame, within_s: float = 12.0, least: float = 0.55) -> DataFrame:
    """Which accepted events stay where they repeat one another: movie_id, event_id, kept.

    candidates: movie_id, event_id, start_s, setting (null equals null), tokens, priority. Events of one setting within
    within_s whose tokens are similar enough are in conflict; in the order of falling priority, then start and id, an
    event stays if no conflicting one has stayed before it. Conflicts are found by an equi-join on title, setting and time bucket;
    only the scan itself is a fold, over the conflicts of a title.
    """
    from cutlight.functions.columns import jaccard

    key = F.coalesce(F.col("setting").cast("string"), F.lit("\\x00"))
    c = candidates.withColumn("_s", key).withColumn("_o", F.row_number().over(Window.partitionBy("movie_id").orderBy(F.desc("priority"), "start_s", "event_id")))
    b = F.floor(F.col("start_s") / within_s)
    left = c.select("movie_id", "_s", "_o", "start_s", "tokens", F.explode(F.array(b - 1, b, b + 1)).alias("_b"))
    right = c.select("movie_id", "_s", F.col("_o").alias("_p"), F.col("start_s").alias("_t"), F.col("tokens").alias("_w"), b.alias("_b"))
    met = left.join(right, ["movie_id", "_s", "_b"]).where((F.col("_p") < F.col("_o")) & (F.abs(F.col("start_s") - F.col("_t")) <= within_s) & (jaccard(F.col("tokens"), F.col("_w")) >= least))
    rivals = met.groupBy("movie_id", "_o").agg(F.collect_set("_p").alias("_rivals"))
    some = rivals.groupBy("movie_id").agg(F.sort_array(F.collect_list(F.struct("_o", "_rivals"))).alias("rows"))
    lost = some.select("movie_id", F.explode(F.aggregate("rows", F.array().cast("array<int>"), lambda out, r: F.when(F.size(F.array_except(r["_rivals"], out)) > 0, F.concat(out, F.array(r["_o"]))).otherwise(out))).alias("_o"))
    return c.join(lost.withColumn("_lost", F.lit(True)), ["movie_id", "_o"], "left").select("movie_id", "event_id", F.col("_lost").isNull().alias("kept"))
