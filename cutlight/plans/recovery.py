"""Queries over observations recovered from older rounds, and over what that changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import policy as po
from cutlight.operators import recovery as rc
from cutlight.plans.observe import _DECIDE
from cutlight.registry import query

ACTIONS = ("Camina por la calle", "conversación tranquila", "habla por TELÉFONO", "recostado en la cama", "Abraza a alguien", "mira", " ", "escucha")
TALKS = ("Cara a cara", "talking", "apoya la mano", "conversando", "juega")
MOODS = ("neutral", "joy", "grief")
EVIDENCE = ("distinct_visible_action_or_reaction", "generic_presence_or_movement")


def _history(spark: SparkSession, d: str) -> DataFrame:
    """What older rounds said of each event; many say nothing, or something that nobody knows."""
    o, k, e = fx.observations(spark, d), F.col("k"), F.col("event_id")
    label = lambda i, s: F.struct(F.concat(e.cast("string"), F.lit(i)).alias("id"), F.lit(s).alias("label"))
    there = e % 4 != 0
    return o.select(
        "movie_id", "event_id", F.when(k % 9 != 8, F.array_compact(F.array(fx.pick(ACTIONS, k % 8), F.when(k % 3 == 0, fx.pick(ACTIONS, (k + e) % 8))))).alias("actions"), F.when(k % 4 == 1, F.array(fx.pick(TALKS, (k + e) % 5))).alias("interactions"),
        F.when(k % 5 == 2, F.array(F.lit("Copa"), F.lit("silla"), F.lit("copa "))).alias("objects"), F.array(fx.pick(MOODS, k % 3)).alias("emotions"), F.when(e % 5 == 0, F.array(F.lit("discusión"))).alias("relations"), F.when(k % 6 != 5, k % 4).alias("people"),
        fx.pick(EVIDENCE, e % 3).alias("evidence"), F.when(k % 3 == 1, "specific_visual_need").alias("intent"), F.when(k % 7 != 6, k % 2 == 0).alias("reusable"), F.when(k % 7 == 0, "maybe").when(k % 7 != 1, F.col("complete")).alias("complete"),
        F.when(k % 10 == 0, fx.pick(fx.UTILITIES, e % len(fx.UTILITIES))).when(k % 10 == 5, "nonsense").alias("bench_kind"), F.when(k % 20 == 0, fx.pick(fx.SIGNALS, e % len(fx.SIGNALS))).alias("bench_signal"),
        F.when(there, F.col("utility")).alias("old_kind"), F.when(there, F.col("complete")).alias("old_complete"), F.when(there, F.col("context")).alias("old_context"), F.when(there, F.col("flags")).alias("old_flags"),
        F.when(e % 2 == 0, F.array(label(":A1", "camina por la calle "), label(":A2", "MIRA"), label(":A3", "Camina por la calle"))).alias("action_catalog"), F.when(e % 2 == 1, F.array(label(":O1", "copa"))).alias("object_catalog"),
    )


def _any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


_J = lambda c: f"array_to_string(list_transform({c}, lambda v: trim(lower(v))), ' | ')"
_L = fx._list
_RECOVERED = f"""hi AS (SELECT *, CASE WHEN k % 9 <> 8 THEN list_filter([{_L(ACTIONS)}[k % 8 + 1], CASE WHEN k % 3 = 0 THEN {_L(ACTIONS)}[(k + event_id) % 8 + 1] END], lambda v: v IS NOT NULL AND trim(v) <> '') ELSE [] END AS actions, CASE WHEN k % 4 = 1 THEN [{_L(TALKS)}[(k + event_id) % 5 + 1]] ELSE [] END AS inter,
  CASE WHEN k % 5 = 2 THEN ['Copa', 'silla', 'copa '] ELSE [] END AS objects, [{_L(MOODS)}[k % 3 + 1]] AS emotions, CASE WHEN event_id % 5 = 0 THEN ['discusión'] ELSE [] END AS relations, CASE event_id % 3 WHEN 0 THEN '{EVIDENCE[0]}' WHEN 1 THEN '{EVIDENCE[1]}' END AS evidence, coalesce(CASE WHEN k % 7 <> 6 THEN k % 2 = 0 END, false) AS useful FROM ob),
hj AS (SELECT *, list_concat(actions, inter) AS shown, {_J("actions")} AS ja, {_J("list_concat(actions, inter)")} AS js, {_J("list_concat(list_concat(actions, inter), relations)")} AS jr FROM hi),
hk AS (SELECT *, jr <> '' AND {_any("jr", (*rc.DIALOGUE, "cara a cara"))} AND NOT {_any("js", rc.INDEPENDENT)} AS talk FROM hj),
hl AS (SELECT * REPLACE (CASE WHEN k % 10 = 0 THEN {_L(fx.UTILITIES)}[event_id % {len(fx.UTILITIES)} + 1] WHEN talk THEN 'generic_dialogue_only' WHEN {_any("ja", rc.MOVEMENT)} THEN 'movement' WHEN {_any("ja", rc.STATE)} THEN 'useful_state' WHEN {_any("js", rc.PHYSICAL)} THEN 'physical_interaction'
  WHEN useful AND evidence = '{EVIDENCE[0]}' THEN 'concrete_action' WHEN evidence = '{EVIDENCE[1]}' THEN 'generic_presence_only' WHEN event_id % 4 <> 0 THEN utility ELSE 'unclear' END AS utility,
  CASE WHEN k % 7 > 1 THEN complete WHEN event_id % 4 <> 0 THEN complete ELSE 'unclear' END AS complete, CASE WHEN useful AND k % 3 = 1 THEN 'low' WHEN event_id % 4 <> 0 THEN context ELSE 'unclear' END AS context, CASE WHEN event_id % 4 <> 0 THEN flags ELSE [] END AS flags) FROM hk),
hm AS MATERIALIZED (SELECT * REPLACE (CASE WHEN k % 20 = 0 THEN {_L(fx.SIGNALS)}[event_id % {len(fx.SIGNALS)} + 1] WHEN talk THEN 'generic_dialogue_only' WHEN utility = 'physical_interaction' THEN 'physical_interaction' WHEN utility IN ('concrete_action', 'movement', 'object_activity') THEN 'concrete_activity' ELSE 'none' END AS signal), 
  (SELECT list(x ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT i, CASE WHEN event_id % 2 = 0 AND trim(lower(v)) = 'camina por la calle' THEN event_id || ':A3' WHEN event_id % 2 = 0 AND trim(lower(v)) = 'mira' THEN event_id || ':A2' ELSE event_id || printf(':V9_ACTION_%02d', i) END AS x FROM (SELECT unnest(shown) AS v, generate_subscripts(shown, 1) AS i)) GROUP BY x)) AS action_ids,
  CASE WHEN len(objects) = 0 THEN [] WHEN event_id % 2 = 1 THEN [event_id || ':O1', event_id || ':V9_OBJECT_02'] ELSE [event_id || ':V9_OBJECT_01', event_id || ':V9_OBJECT_02', event_id || ':V9_OBJECT_03'] END AS object_ids FROM hl)"""


def _recovered(spark: SparkSession, d: str) -> DataFrame:
    return rc.recover(_history(spark, d), fx.UTILITIES, fx.SIGNALS)


@query(with_("SELECT", "ob").removesuffix("\nSELECT") + ",\n" + _RECOVERED + f"""
SELECT movie_id, event_id, utility, signal, complete, context, flags, CASE WHEN k % 6 = 5 OR k % 4 = 0 THEN '0' WHEN k % 4 = 1 THEN '1' ELSE '2_plus' END AS people, CASE WHEN talk OR len(list_filter(inter, lambda v: contains(lower(v), 'convers') OR contains(lower(v), 'talking'))) > 0 THEN 'true' ELSE 'false' END AS conversation,
 CASE WHEN utility = 'movement' THEN 'present' ELSE 'none' END AS movement, list_filter(emotions, lambda e: e <> 'neutral') AS reactions, coalesce(action_ids, []) AS action_ids, object_ids FROM hm""")
def p11_historical_recovery(spark: SparkSession, d: str) -> DataFrame:
    return _recovered(spark, d).drop("states", "n_actions")


@query(with_("SELECT", "ob").removesuffix("\nSELECT") + ",\n" + _RECOVERED + f""",
ol AS (SELECT event_id, {_DECIDE} AS old_decision FROM ob), nw AS (SELECT event_id, {_DECIDE.replace("n_actions = 0", "coalesce(len(action_ids), 0) = 0")} AS new_decision FROM hm)
SELECT old_decision, new_decision, count(*) AS n, list(event_id ORDER BY event_id) AS event_ids FROM ol JOIN nw USING (event_id) GROUP BY ALL""")
def p12_recovery_report(spark: SparkSession, d: str) -> DataFrame:
    """The first policy over the observations as they were and as they are recovered."""
    return po.transitions(po.decide(fx.observations(spark, d)), po.decide(_recovered(spark, d)))
