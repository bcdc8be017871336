"""Queries over semantic answers and promotions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import policy as po
from cutlight.operators import semantics as se
from cutlight.plans.observe import _DECIDE
from cutlight.registry import query

_PLACES, _SOURCES, _DECISIONS = (*se.POSITIONS, "top"), (*se.RELATIONSHIP_SOURCES, "rumour"), (*se.DECISIONS, "MAYBE")
_TYPES, _INTENTS = (*se.ACTION_TYPES, "other"), (*se.INTENT_TYPES, "other")
_GIVEN = "lambda x: x IS NOT NULL"
_ANSWERS = with_("SELECT", "ob").removesuffix("\nSELECT") + f""", an AS (SELECT movie_id, event_id, k, utility, signal, complete, {fx._list(_PLACES)}[k % 6 + 1] AS position, {fx._list(_SOURCES)}[k % 5 + 1] AS source, {fx._list(_DECISIONS)}[k % 4 + 1] AS decision, {fx._list(_TYPES)}[k // 4 % 4 + 1] AS action_type, {fx._list(_INTENTS)}[k // 8 % 4 + 1] AS intent_type FROM ob),
ak AS (SELECT *, [CASE WHEN decision = 'KEEP' AND (k % 10 = 4 OR complete = 'false') THEN 'KEEP lacks semantic usefulness' END, CASE WHEN decision = 'KEEP' AND action_type = 'other' THEN 'invalid KEEP action evidence type' END, CASE WHEN decision = 'KEEP' AND intent_type = 'other' THEN 'invalid KEEP reusable intent type' END,
 CASE WHEN decision = 'KEEP' AND action_type = 'unclear' THEN 'KEEP lacks grounded visible action or state' END, CASE WHEN decision = 'KEEP' AND intent_type = 'unclear' THEN 'KEEP lacks searchable reusable use case' END, CASE WHEN decision = 'KEEP' AND k % 7 = 0 THEN 'KEEP action evidence is not grounded in visible structured action' END, CASE WHEN decision = 'KEEP' AND k % 9 = 0 THEN 'KEEP reusable use case is not grounded in structured use cases' END] AS keeps,
 [CASE WHEN position = 'top' THEN 'invalid subject position' END, CASE WHEN k % 31 = 4 THEN 'invalid shot focus plan' END, CASE WHEN k % 20 = 3 THEN 'invalid person presentation' END, CASE WHEN k % 20 <> 3 AND k % 21 = 3 THEN 'invalid person age group' END, CASE WHEN k % 20 <> 3 AND k % 21 <> 3 AND k % 22 = 3 THEN 'invalid person frame role' END, CASE WHEN k % 20 <> 3 AND k % 21 <> 3 AND k % 22 <> 3 AND k % 23 = 3 THEN 'invalid person position' END,
  CASE WHEN source = 'rumour' THEN 'invalid relationship provenance' END, CASE WHEN source <> 'rumour' AND k > 80 THEN 'invalid relationship confidence' END] AS head FROM an)
"""


def _answers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    person = F.struct(F.when(k % 20 == 3, "robot").otherwise("woman").alias("presentation"), F.when(k % 21 == 3, "ancient").otherwise("adult").alias("age"), F.when(k % 22 == 3, "lead").otherwise("primary").alias("role"), F.when(k % 23 == 3, "top").otherwise("left").alias("position"))
    relation = F.struct(fx.pick(_SOURCES, k % 5).alias("source"), fx.pick(("siblings", "friends"), F.col("event_id") % 2).alias("type"), (k / 80).alias("confidence"))
    one = lambda *t: F.array(*[F.lit(x) for x in t])
    return fx.observations(spark, d).withColumns({
        "position": fx.pick(_PLACES, k % 6), "plan_bad": k % 31 == 4, "people": F.array(person), "relationships": F.array(relation), "emotions": F.array(F.when(k % 25 == 7, "rage").otherwise("neutral")), "decision": fx.pick(_DECISIONS, k % 4),
        "said": F.when(k % 26 == 5, "a mother at the door").otherwise("a door"), "reusable": k % 10 != 4, "action_type": fx.pick(_TYPES, F.floor(k / 4) % 4), "intent_type": fx.pick(_INTENTS, F.floor(k / 8) % 4),
        "action_evidence": F.when(k % 7 == 0, "sleeps").otherwise(" opens DOOR"), "use_case": F.when(k % 9 == 0, "").otherwise("entry"), "actions": one("Opens Door ", "walks"), "interactions": one("talk"), "use_cases": one("Entry"),
    })


@query(_ANSWERS + f"""SELECT movie_id, event_id, list_filter(list_concat(list_concat(head, [CASE WHEN source = 'visual' AND event_id % 2 = 0 THEN 'visual relationship overreach' END, CASE WHEN k % 25 = 7 THEN 'invalid visible emotion' END, CASE WHEN decision = 'MAYBE' THEN 'invalid decision' END, CASE WHEN k % 26 = 5 THEN 'visual relationship or narrative hallucination' END]), keeps), {_GIVEN}) AS errors FROM ak""")
def v11_semantic_contract(spark: SparkSession, d: str) -> DataFrame:
    return _answers(spark, d).select("movie_id", "event_id", se.answer_errors().alias("errors"))


@query(_ANSWERS + f"""SELECT movie_id, event_id, list_sort(list_distinct(list_filter(list_concat(list_concat(head, [CASE WHEN k % 25 = 7 THEN 'invalid visible emotion' END, CASE WHEN decision = 'MAYBE' THEN 'invalid decision' END, CASE WHEN signal = 'unclear' THEN 'invalid conversation visual signal' END, CASE WHEN decision = 'KEEP' AND utility IN ('generic_dialogue_only', 'generic_presence_only', 'unclear') THEN 'KEEP has ineligible visual utility kind' END]), keeps), {_GIVEN}))) AS errors FROM ak""")
def v12_utility_answer_contract(spark: SparkSession, d: str) -> DataFrame:
    return _answers(spark, d).select("movie_id", "event_id", se.utility_answer_errors().alias("errors"))


_COUNTS = ("0", "1", "2_plus", "unclear")


@query(with_(f"SELECT movie_id, event_id, {_DECIDE} AS decision, 'VALIDATED' AS status, CASE WHEN n_actions = 0 THEN []::VARCHAR[] WHEN k % 8 = 0 THEN ['walk'] ELSE ['walk', 'turn'] END AS actions, CASE WHEN k % 4 IN (1, 2) OR k % 3 > 0 THEN true WHEN k % 4 = 0 THEN false END AS contains_people, CASE WHEN k % 4 < 2 THEN k % 4 END AS people_count, ['not_applicable', 'single_subject', 'multiple_people', 'unclear'][k % 4 + 1] AS composition FROM ob", "ob"))
def p09_materialised_decisions(spark: SparkSession, d: str) -> DataFrame:
    ob = fx.observations(spark, d)
    k = F.col("k")
    ids = F.when(F.col("n_actions") == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("A1"), F.lit("A2"), F.lit("A9")))
    seen = ob.select("movie_id", "event_id", ids.alias("action_ids"), fx.pick(_COUNTS, k % 4).alias("count"), (k % 3).alias("persons"))
    one = lambda i, t: ob.select("movie_id", "event_id", F.lit(i).alias("action_id"), F.lit(t).alias("label"), "k")
    labels = one("A1", "walk").union(one("A2", "turn").where(k % 8 != 0)).drop("k")
    return se.materialised(po.decide(ob).select("movie_id", "event_id", "decision"), seen, labels)


@query(with_(f"""SELECT movie_id, events, missing, missing = 0 AS promoted, CASE WHEN missing = 0 THEN stale ELSE [] END AS stale, CASE WHEN missing = 0 THEN keepers ELSE [] END AS keepers FROM (SELECT movie_id, count(*) AS events, count(*) FILTER (movie_id % 3 = 0 AND k % 41 = 1) AS missing, coalesce(list(event_id ORDER BY event_id) FILTER (o = 'KEEP' AND n = 'REJECT'), []) AS stale, coalesce(list(event_id ORDER BY event_id) FILTER (o <> 'KEEP' AND n = 'KEEP'), []) AS keepers
 FROM (SELECT movie_id, event_id, k, {_DECIDE} AS o, CASE WHEN k % 12 = 5 THEN 'REJECT' WHEN k % 12 = 7 THEN 'KEEP' ELSE {_DECIDE} END AS n FROM ob) GROUP BY movie_id)""", "ob"))
def p15_promotion_gate(spark: SparkSession, d: str) -> DataFrame:
    ob = fx.observations(spark, d)
    k = F.col("k")
    now = po.decide(ob).join(ob.select("event_id", "k"), "event_id").select("movie_id", "event_id", "decision", F.sha2(F.col("event_id").cast("string").cast("binary"), 256).alias("mark"), "k")
    bad = (F.col("movie_id") % 3 == 0) & (k % 41 == 1)
    new = now.withColumn("decision", F.when(k % 12 == 5, "REJECT").when(k % 12 == 7, "KEEP").otherwise(F.col("decision"))).withColumn("valid", ~(bad & (k % 2 == 1))).withColumn("mark", F.when(bad, "changed").otherwise(F.col("mark")))
    return se.promotion(now.drop("k"), new.drop("k"))
