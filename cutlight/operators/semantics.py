"""Contracts of semantic answers, what a decision leaves on its event, and the gate before a new set of decisions is taken over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutlight.functions.columns import errors

# Vocabularies of semantic answers.
POSITIONS = ("left", "center", "right", "multiple", "unclear")
PRESENTATIONS = ("woman", "man", "unclear")
AGE_GROUPS = ("young_adult", "adult", "middle_aged", "older_adult", "unclear")
FRAME_ROLES = ("primary", "secondary", "background", "unclear")
RELATIONSHIP_SOURCES = ("visual", "srt", "narrative", "combined")
EMOTIONS = ("smiling", "crying", "tense_appearance", "surprised_appearance", "neutral", "unclear")
DECISIONS = ("KEEP", "REVIEW", "REJECT")
ACTION_TYPES = ("distinct_visible_action_or_reaction", "generic_presence_or_movement", "unclear")
INTENT_TYPES = ("specific_visual_need", "generic_ambience_or_context", "unclear")
FAMILY = ("romantic_partner", "married_couple", "mother_daughter", "father_daughter", "mother_son", "father_son", "siblings")
HALLUCINATIONS = ("mother", "daughter", "husband", "wife", "couple", "therapist", "trauma", "jealousy", "betrayal")
UTILITY_KINDS = ("concrete_action", "useful_state", "clear_reaction", "physical_interaction", "movement", "object_activity", "environment", "strong_nonverbal_interaction", "generic_dialogue_only", "generic_presence_only", "unclear")
SIGNALS = ("none", "clear_reaction", "strong_body_language", "physical_interaction", "concrete_activity", "useful_environment_or_composition", "generic_dialogue_only")
INELIGIBLE = ("generic_dialogue_only", "generic_presence_only", "unclear")


def _grounded(evidence: Column, said: Column) -> Column:
    """Is the quoted evidence, without outer blanks and case, among what was said?"""
    norm = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return (norm(evidence) != "") & F.array_contains(F.transform(said, norm), norm(evidence))


def _people_rules(people: Column) -> list[tuple[Column, str]]:
    """Of each person the first fault counts."""
    steps = [("presentation", PRESENTATIONS, "invalid person presentation"), ("age", AGE_GROUPS, "invalid person age group"), ("role", FRAME_ROLES, "invalid person frame role"), ("position", POSITIONS, "invalid person position")]

    def fault(i: int):
        def wrong(p: Column) -> Column:
            fine = F.lit(True)
            for name, known, _ in steps[:i]:
                fine = fine & p[name].isin(*known)
            return fine & ~p[steps[i][0]].isin(*steps[i][1])

        return wrong

    return [(F.exists(people, fault(i)), code) for i, (_, _, code) in enumerate(steps)]


def _keep_rules() -> list[tuple[Column, str]]:
    c, keep, said = F.col, F.col("decision") == "KEEP", F.col("action_type").isNotNull() | F.col("intent_type").isNotNull()
    return [
        (keep & (~c("reusable") | (c("complete") == "false")), "KEEP lacks semantic usefulness"), (keep & ~said, "KEEP lacks editorial qualification"),
        (keep & said & ~c("action_type").isin(*ACTION_TYPES), "invalid KEEP action evidence type"), (keep & said & ~c("intent_type").isin(*INTENT_TYPES), "invalid KEEP reusable intent type"),
        (keep & (c("action_type") == "unclear"), "KEEP lacks grounded visible action or state"), (keep & (c("intent_type") == "unclear"), "KEEP lacks searchable reusable use case"),
        (keep & said & ~_grounded(c("action_evidence"), F.concat("actions", "interactions")), "KEEP action evidence is not grounded in visible structured action"),
        (keep & said & ~_grounded(c("use_case"), c("use_cases")), "KEEP reusable use case is not grounded in structured use cases"),
    ]


def answer_errors() -> Column:
    """Faults of an answer in the columns position, plan_bad, people (array of struct(presentation, age, role, position)), relationships
    (array of struct(source, type, confidence)), emotions, decision, complete, said (all visual text, lower case), reusable,
    action_type, intent_type, action_evidence, use_case, actions, interactions, use_cases."""
    c = F.col
    known = F.filter("relationships", lambda r: r["source"].isin(*RELATIONSHIP_SOURCES))
    return errors(
        (~c("position").isin(*POSITIONS), "invalid subject position"), (c("plan_bad"), "invalid shot focus plan"), *_people_rules(c("people")),
        (F.size(known) < F.size("relationships"), "invalid relationship provenance"), (F.exists(known, lambda r: ~r["confidence"].between(0, 1)), "invalid relationship confidence"),
        (F.exists(known, lambda r: (r["source"] == "visual") & r["type"].isin(*FAMILY)), "visual relationship overreach"), (F.exists("emotions", lambda e: ~e.isin(*EMOTIONS)), "invalid visible emotion"),
        (~c("decision").isin(*DECISIONS), "invalid decision"), (~c("complete").isin("true", "false", "unclear"), "invalid completeness"),
        (c("said").rlike("|".join(HALLUCINATIONS)), "visual relationship or narrative hallucination"), *_keep_rules(),
    )


def utility_answer_errors() -> Column:
    """Faults of an answer that also has utility and signal, sorted, each once."""
    c = F.col
    known = F.filter("relationships", lambda r: r["source"].isin(*RELATIONSHIP_SOURCES))
    found = errors(
        (~c("position").isin(*POSITIONS), "invalid subject position"), (c("plan_bad"), "invalid shot focus plan"), *_people_rules(c("people")), (F.size(known) < F.size("relationships"), "invalid relationship provenance"),
        (F.exists(known, lambda r: ~r["confidence"].between(0, 1)), "invalid relationship confidence"), (F.exists("emotions", lambda e: ~e.isin(*EMOTIONS)), "invalid visible emotion"), (~c("decision").isin(*DECISIONS), "invalid decision"),
        (~c("utility").isin(*UTILITY_KINDS), "invalid visual utility kind"), (~c("signal").isin(*SIGNALS), "invalid conversation visual signal"),
        ((c("decision") == "KEEP") & c("utility").isin(*INELIGIBLE), "KEEP has ineligible visual utility kind"), *_keep_rules(),
    )
    return F.array_sort(F.array_distinct(found))


def materialised(decisions: DataFrame, observations: DataFrame, labels: DataFrame) -> DataFrame:
    """What a decision leaves on its event: movie_id, event_id, decision, status, actions (labels of the cited ids that are known), contains_people, people_count, composition.

    observations: movie_id, event_id, action_ids, count (0, 1, 2_plus or unclear), persons (number of visible ids); labels: movie_id, event_id, action_id, label.
    """
    known = labels.groupBy("movie_id", "event_id").agg(F.map_from_entries(F.collect_list(F.struct("action_id", "label"))).alias("_m"))
    x = decisions.join(observations, ["movie_id", "event_id"]).join(known, ["movie_id", "event_id"], "left")
    actions = F.array_compact(F.transform("action_ids", lambda i: F.col("_m")[i]))
    n = F.col("count")
    contains = F.when(n.isin("1", "2_plus") | (F.col("persons") > 0), True).when(n == "0", False)
    composition = F.when(n == "1", "single_subject").when(n == "2_plus", "multiple_people").when(n == "0", "not_applicable").otherwise("unclear")
    return x.select("movie_id", "event_id", "decision", F.lit("VALIDATED").alias("status"), F.coalesce(actions, F.array().cast("array<string>")).alias("actions"), contains.alias("contains_people"), F.when(n.isin("0", "1"), n.cast("bigint")).alias("people_count"), composition.alias("composition"))


def promotion(events: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per title: may the new decisions be taken over, and what changes: movie_id, events, missing, promoted, stale, keepers.

    events: movie_id, event_id, decision, mark (what identifies the event); candidates: the same with valid. Only a complete set of valid
    decisions over unchanged events is promoted. stale: KEEP becomes REJECT; keepers: those that are KEEP only now.
    """
    c = candidates.select("movie_id", "event_id", F.col("decision").alias("new"), F.col("mark").alias("then"), "valid")
    x = events.join(c, ["movie_id", "event_id"], "left")
    good = F.coalesce(F.col("valid") & (F.col("mark") == F.col("then")), F.lit(False))
    ids = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("event_id"))))
    g = x.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(~good).alias("missing"), ids((F.col("decision") == "KEEP") & (F.col("new") == "REJECT")).alias("stale"),
        ids((F.col("decision") != "KEEP") & (F.col("new") == "KEEP")).alias("keepers"),
    )
    none = F.array().cast(g.schema["stale"].dataType)
    ok = F.col("missing") == 0
    return g.select("movie_id", "events", "missing", ok.alias("promoted"), F.when(ok, F.col("stale")).otherwise(none).alias("stale"), F.when(ok, F.col("keepers")).otherwise(none).alias("keepers"))
