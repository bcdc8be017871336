"""Queries over reusable moments, their policy, response batches, faces and targets.

An event is three consecutive shots of a title; each shot was looked at in its first, middle and last frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.functions.columns import errors, let
from cutlight.operators import faces as fc
from cutlight.operators import geometry as geo
from cutlight.operators import reuse as ru
from cutlight.registry import query
from cutlight.session import cut

_r = lambda c: F.round(F.col(c) + 1e-7, 4).alias(c)
KINDS = ("complete_action", "composition", "reaction", "sustained_state", "unclear")
STATUS = ("complete_action", "incomplete_action", "reusable_state", "unclear")
ASSESSMENTS = ("useful", "weak", "absent", "unclear")
_GIVEN = "lambda x: x IS NOT NULL"


def _sql(names: tuple[str, ...], ctes: str, body: str) -> str:
    return with_("SELECT", *names).removesuffix("\nSELECT") + (f", {ctes}\n" if ctes else "\n") + body


_EVENTS = f"""e0 AS (SELECT *, (shot_ord - 1) // 3 AS ev, movie_id * 10000 + (shot_ord - 1) // 3 AS event, lag(end_frame) OVER w AS pb, coalesce(interaction_id = lag(interaction_id) OVER w, false) OR coalesce(action_id = lag(action_id) OVER w, false) OR coalesce(establishing_id = lag(establishing_id) OVER w, false) OR reverse_shot AS link FROM sh WHERE end_frame > start_frame WINDOW w AS (PARTITION BY movie_id, (shot_ord - 1) // 3 ORDER BY shot_ord)),
e1 AS (SELECT movie_id, ev, event, min(start_frame) AS es, max(end_frame) AS ee, arg_min(k, shot_ord) AS k0, count(*) AS n, list(shot_id ORDER BY shot_ord) AS shot_ids, list(struct_pack(shot_id := shot_id, a := start_frame, b := end_frame, pb := pb, link := link) ORDER BY shot_ord) AS shots FROM e0 GROUP BY ALL),
s0 AS (SELECT movie_id, ev, shot_ord, p, shot_id || ':' || p AS sample_id, CASE p WHEN 0 THEN start_frame WHEN 1 THEN (start_frame + end_frame - 1) // 2 ELSE end_frame - 1 END AS frame, shot_id, ['begin', 'middle', 'end'][p + 1] AS role FROM e0, unnest(range(0, 3)) t(p)),
s1 AS (SELECT movie_id, ev, list(struct_pack(sample_id := sample_id, frame := frame, shot_id := shot_id, role := role) ORDER BY shot_ord, p) AS samples, list(sample_id ORDER BY shot_ord, p) AS all_ids FROM s0 GROUP BY ALL),
em AS (SELECT *, es + CASE WHEN k0 % 4 = 1 THEN 1 ELSE 0 END AS ms, ee - CASE WHEN k0 % 5 = 2 THEN 1 ELSE 0 END + CASE WHEN k0 % 31 = 3 THEN 5 ELSE 0 END AS me, {fx._list(KINDS)}[k0 % 5 + 1] AS kind, {fx._list(fx.COMPLETE)}[(k0 + ev) % 5 + 1] AS complete, {fx._list(STATUS)}[(k0 + ev) % 4 + 1] AS status,
  {fx._list(fx.UTILITIES)}[k0 % 11 + 1] AS utility, {fx._list(fx.CONTEXT)}[ev % 5 + 1] AS context, all_ids[1] AS begin_id, all_ids[-1] AS finish_id, CASE WHEN k0 % 3 <> 0 THEN list_transform(range(2, len(all_ids) + 1, 3), lambda i: all_ids[i]) ELSE []::VARCHAR[] END AS middle_ids, CASE WHEN k0 % 2 = 0 THEN 'supported' ELSE 'unclear' END AS continuity,
  list_concat(list_filter(all_ids, lambda x, i: k0 % 3 <> 0 OR (i + k0) % 9 <> 0), CASE WHEN k0 % 13 = 0 THEN ['SAMPLE_99'] ELSE []::VARCHAR[] END) AS ids FROM e1 JOIN s1 USING (movie_id, ev)),
er AS (SELECT *, list_filter(samples, lambda s: list_contains(ids, s.sample_id)) AS rows, list_filter(shots, lambda s: s.a < me AND s.b > ms) AS inside, len(list_filter(ids, lambda i: NOT list_contains(all_ids, i))) > 0 AS unknown FROM em),
ef AS (SELECT *, list_distinct(list_transform(rows, lambda s: s.frame)) AS frames, list_filter(samples, lambda s: s.sample_id = begin_id)[1].frame AS bf, list_filter(samples, lambda s: s.sample_id = finish_id)[1].frame AS ff, list_transform(list_filter(samples, lambda s: list_contains(middle_ids, s.sample_id)), lambda s: s.frame) AS mf,
  complete = 'true' AND list_contains(ids, begin_id) AND list_contains(ids, finish_id) AND len(middle_ids) > 0 AND len(list_filter(middle_ids, lambda m: NOT list_contains(ids, m))) = 0 AS parts FROM er),
ev16 AS (SELECT *, list_concat(CASE WHEN NOT (es <= ms AND ms < me AND me <= ee) THEN ['moment_outside_event'] ELSE []::VARCHAR[] END, CASE WHEN unknown THEN ['invalid_moment_sample_ids'] ELSE list_filter([CASE WHEN len(frames) < 2 OR len(list_filter(frames, lambda f: f < ms OR f >= me)) > 0 THEN 'insufficient_local_temporal_support' END,
  CASE WHEN len(rows) > 0 AND (list_min(frames) > ms OR list_max(frames) < me - 1) THEN 'moment_bounds_without_visual_support' END, CASE WHEN kind = 'complete_action' AND NOT parts THEN 'local_action_requires_begin_development_completion' END,
  CASE WHEN kind = 'complete_action' AND parts AND NOT (bf = ms AND ff = me - 1 AND len(list_filter(mf, lambda f: NOT (f > ms AND f < me - 1))) = 0) THEN 'local_action_temporal_order' END, CASE WHEN kind = 'sustained_state' AND complete = 'true' THEN 'sustained_state_cannot_claim_action_completion' END,
  CASE WHEN len(list_filter(inside, lambda s: NOT list_contains(list_transform(rows, lambda r: r.shot_id), s.shot_id))) > 0 THEN 'missing_moment_shot_support' END, CASE WHEN len(inside) > 1 AND continuity <> 'supported' THEN 'multishot_continuity_unproven' END], {_GIVEN}) END) AS errs FROM ef)"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    by = Window.partitionBy("movie_id", "ev").orderBy("shot_ord")
    s = fx.shots(spark, d).where("end_frame > start_frame").withColumn("ev", F.floor((F.col("shot_ord") - 1) / 3))
    same = lambda c: F.coalesce(F.col(c) == F.lag(c).over(by), F.lit(False))
    s = s.withColumn("pb", F.lag("end_frame").over(by)).withColumn("link", same("interaction_id") | same("action_id") | same("establishing_id") | F.col("reverse_shot"))
    looks = [(F.col("start_frame"), "begin"), (F.floor((F.col("start_frame") + F.col("end_frame") - 1) / 2), "middle"), (F.col("end_frame") - 1, "end")]
    sample = F.array(*[F.struct(F.concat("shot_id", F.lit(f":{p}")).alias("sample_id"), f.alias("frame"), F.col("shot_id"), F.lit(r).alias("role")) for p, (f, r) in enumerate(looks)])
    shot = F.struct("shot_ord", "shot_id", "start_frame", "end_frame", "pb", "link", "k", sample.alias("looks"))
    g = s.groupBy("movie_id", "ev").agg(F.min("start_frame").alias("es"), F.max("end_frame").alias("ee"), F.sort_array(F.collect_list(shot)).alias("shots"))
    g = g.withColumns({"k0": F.get("shots", 0)["k"], "shot_ids": F.transform("shots", lambda x: x["shot_id"]), "samples": F.flatten(F.transform("shots", lambda x: x["looks"])), "event": F.col("movie_id") * 10000 + F.col("ev")})
    k, ev = F.col("k0"), F.col("ev")
    g = g.withColumn("all_ids", F.transform("samples", lambda x: x["sample_id"]))
    return g.withColumns({
        "ms": F.col("es") + F.when(k % 4 == 1, 1).otherwise(0), "me": F.col("ee") - F.when(k % 5 == 2, 1).otherwise(0) + F.when(k % 31 == 3, 5).otherwise(0), "kind": fx.pick(KINDS, k % 5), "complete": fx.pick(fx.COMPLETE, (k + ev) % 5),
        "status": fx.pick(STATUS, (k + ev) % 4), "utility": fx.pick(fx.UTILITIES, k % 11), "context": fx.pick(fx.CONTEXT, ev % 5), "begin_id": F.get("all_ids", 0), "finish_id": F.element_at("all_ids", -1),
        "middle_ids": F.when(k % 3 != 0, F.filter("all_ids", lambda x, i: i % 3 == 1)).otherwise(F.array().cast("array<string>")), "continuity": F.when(k % 2 == 0, "supported").otherwise("unclear"),
        "ids": F.concat(F.filter("all_ids", lambda x, i: (k % 3 != 0) | ((i + 1 + k) % 9 != 0)), F.when(k % 13 == 0, F.array(F.lit("SAMPLE_99"))).otherwise(F.array().cast("array<string>"))),
    })


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Events with errs: what is wrong with their moment."""
    c = F.col
    return _events(spark, d).withColumn("errs", ru.moment_errors(c("ms"), c("me"), c("es"), c("ee"), c("kind"), c("complete"), c("begin_id"), c("middle_ids"), c("finish_id"), c("ids"), c("continuity"), c("samples"), c("shots")))


@query(_sql(("sh",), _EVENTS, "SELECT movie_id, event, errs AS errors FROM ev16"))
def v16_moment_contract(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("movie_id", "event", F.col("errs").alias("errors"))


_V15 = f"""tp AS (SELECT *, CASE WHEN k0 % 19 = 0 THEN shot_ids[:-2] ELSE shot_ids END AS told, CASE WHEN k0 % 17 = 0 THEN shot_ids[2:] ELSE shot_ids END AS directed, CASE WHEN k0 % 8 = 0 THEN [' '] ELSE ['calm'] END AS states, list_transform(rows, lambda r: r.role) AS roles FROM ev16),
tb AS (SELECT *, [CASE WHEN k0 % 37 = 9 THEN 'event_id' END, CASE WHEN len(told) <> n THEN 'represented_shot_ids' END, CASE WHEN unknown THEN 'unknown_temporal_sample_id' END, CASE WHEN status <> 'unclear' AND NOT (NOT unknown AND len(frames) >= 2) THEN 'insufficient_temporal_support' END] AS head,
  [CASE WHEN status = 'complete_action' AND NOT (complete = 'true' AND len(frames) >= 3 AND list_contains(roles, 'begin') AND list_contains(roles, 'end') AND list_contains(roles, 'middle') AND list_min(frames) = es AND list_max(frames) = ee - 1) THEN 'complete_action_requires_begin_development_end' END] AS ends,
  [CASE WHEN status = 'incomplete_action' AND complete <> 'false' THEN 'incomplete_action_completeness' END, CASE WHEN status = 'reusable_state' AND complete = 'true' THEN 'reusable_state_raw_action_completeness_must_be_false_or_unclear' END, CASE WHEN status = 'reusable_state' AND utility <> 'useful_state' THEN 'reusable_state_requires_useful_state_utility' END,
   CASE WHEN status = 'reusable_state' AND k0 % 8 = 0 THEN 'reusable_state_requires_visible_state' END, CASE WHEN status = 'unclear' AND complete = 'true' THEN 'unclear_moment_cannot_claim_complete_action' END, CASE WHEN len(directed) <> n THEN 'one_focus_directive_per_technical_shot' END] AS tail FROM tp)"""


def _temporal(x: DataFrame, local: bool):
    c, k = F.col, F.col("k0")
    told = F.when(k % 19 == 0, F.slice("shot_ids", 1, F.size("shot_ids") - 1)).otherwise(c("shot_ids"))
    directed = F.when(k % 17 == 0, F.slice("shot_ids", 2, F.size("shot_ids"))).otherwise(c("shot_ids"))
    states = F.array(F.when(k % 8 == 0, " ").otherwise("calm"))
    return ru.temporal_errors(k % 37 != 9, told, c("shot_ids"), c("ids"), c("status"), c("complete"), c("utility"), states, c("es"), c("ee") - 1, c("samples"), directed, local)


@query(_sql(("sh",), _EVENTS + ",\n" + _V15, f"SELECT movie_id, event, list_filter(list_concat(list_concat(head, ends), tail), {_GIVEN}) AS errors FROM tb"))
def v15_temporal_contract(spark: SparkSession, d: str) -> DataFrame:
    x = _events(spark, d)
    return x.select("movie_id", "event", _temporal(x, False).alias("errors"))


@query(_sql(("sh",), _EVENTS + ",\n" + _V15, f"SELECT movie_id, event, list_concat(list_filter(list_concat(list_concat(head, tail), [CASE WHEN status = 'complete_action' AND kind <> 'complete_action' THEN 'complete_action_requires_local_moment' END, CASE WHEN k0 % 23 = 0 THEN 'duplicate_moment_id' END]), {_GIVEN}), errs) AS errors FROM tb"))
def v17_visual_reuse_contract(spark: SparkSession, d: str) -> DataFrame:
    x = _judged(spark, d)
    m = F.struct(F.lit("m1").alias("moment_id"), F.col("kind"))
    moments = F.when(F.col("k0") % 23 == 0, F.array(m, m)).otherwise(F.array(m))
    return x.select("movie_id", "event", ru.reuse_errors(_temporal(x, True), F.col("status"), moments, F.col("errs")).alias("errors"))


_CLASSES = fx._list(sorted(ru.UTILITY_CLASSES))


@query(_sql(("sh",), _EVENTS + f""", j0 AS (SELECT *, unnest(list_concat(range(0, 14), CASE WHEN k0 % 9 = 0 THEN [0] ELSE []::BIGINT[] END)) AS i FROM em),
j1 AS (SELECT movie_id, event, any_value(k0) AS k0, any_value(ev) AS ev, any_value(kind) AS kind, list(struct_pack(c := {_CLASSES}[i + 1], a := {fx._list(ASSESSMENTS)}[(i + k0) % 4 + 1], n := CASE WHEN (i + k0) % 5 <> 0 THEN 1 ELSE 0 END, u := k0 % 15 = 4)) AS js FROM j0 WHERE i <> k0 % 20 GROUP BY movie_id, event),
j2 AS (SELECT *, {_CLASSES}[k0 % 14 + 1] AS mc, k0 % 2 = 0 AS useful, len(list_filter(js, lambda j: j.a IN ('useful', 'unclear'))) > 0 AS open_ FROM j1)""", f"""SELECT movie_id, event, list_filter([CASE WHEN list_sort(list_transform(js, lambda j: j.c)) <> {_CLASSES} THEN 'one_assessment_per_utility_class' END, CASE WHEN k0 % 15 = 4 AND len(list_filter(js, lambda j: j.n > 0)) > 0 THEN 'invalid_utility_citations' END,
 CASE WHEN len(list_filter(js, lambda j: j.a IN ('useful', 'weak') AND j.n = 0)) > 0 THEN 'utility_judgment_requires_visual_citations' END, CASE WHEN useful AND len(list_filter(js, lambda j: j.c = mc AND j.a = 'useful')) = 0 THEN 'moment_utility_assessment_contradiction' END, CASE WHEN k0 % 3 = 0 AND NOT useful THEN 'reusable_requires_supported_moment' END,
 CASE WHEN k0 % 3 = 1 AND (useful OR k0 % 6 = 1 OR open_) THEN 'negative_reuse_requires_complete_resolved_assessment' END, CASE WHEN ev % 2 = 1 AND kind = 'sustained_state' THEN 'sustained_state_contradiction' END], {_GIVEN}) AS errors FROM j2"""))
def v18_utility_contract(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k0")
    at = F.filter(F.concat(F.sequence(F.lit(0), F.lit(13)), F.when(k % 9 == 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))), lambda i: i != k % 20)
    cites = F.array(F.when(k % 15 == 4, "SAMPLE_99").otherwise(F.get("all_ids", 0)))
    classes = sorted(ru.UTILITY_CLASSES)
    judgments = F.transform(at, lambda i: F.struct(fx.pick(classes, i).alias("cls"), fx.pick(ASSESSMENTS, (i + k) % 4).alias("assessment"), F.when((i + k) % 5 != 0, cites).otherwise(F.array().cast("array<string>")).alias("ids")))
    moments = F.array(F.struct(fx.pick(classes, k % 14).alias("cls"), F.col("kind"), (k % 2 == 0).alias("useful")))
    wrong = ru.utility_errors(judgments, F.col("all_ids"), moments, fx.pick(("true", "false", "unclear"), k % 3), k % 6 != 1, F.when(F.col("ev") % 2 == 1, "false").otherwise("true"))
    return _events(spark, d).select("movie_id", "event", wrong.alias("errors"))


_REPLAY = f"""rq0 AS (SELECT *, coalesce({{{", ".join(f"'{a}': '{b}'" for a, b in ru.ALIASES.items())}}}[utility], utility) AS cls, list_filter(shots, lambda s: s.a < list_max(frames) + 1 AND s.b > list_min(frames)) AS seen FROM ev16),
rp AS (SELECT *, CASE WHEN k0 % 6 = 0 THEN 'missing_temporal_visual_moments' WHEN NOT list_contains({_CLASSES}, cls) THEN 'legacy_generic_class_did_not_assess_visual_reuse' WHEN context IN ('high', 'unclear') THEN 'visual_vs_narrative_context_unresolved' WHEN status NOT IN ('reusable_state', 'complete_action') THEN 'local_moment_or_state_usability_unresolved'
  WHEN len(frames) < 2 THEN 'insufficient_temporal_visual_support' WHEN len(seen) > 1 AND len(list_filter(seen, lambda s: s.link AND s.pb > list_min(frames))) < len(seen) - 1 THEN 'asset_cut_continuity_requires_visual_assessment' END AS reason FROM rq0)""".replace("coalesce({", "coalesce(MAP {").replace("}[utility]", "}[utility]")


def _replayed(x: DataFrame) -> DataFrame:
    frames = let(F.col("ids"), lambda ids: F.transform(F.filter("samples", lambda s: F.array_contains(ids, s["sample_id"])), lambda s: s["frame"]))
    x = x.withColumn("cited", frames).withColumn("f0", F.array_min("cited")).withColumn("f1", F.array_max("cited"))
    seen = F.filter("shots", lambda s: (s["start_frame"] < F.col("f1") + 1) & (s["end_frame"] > F.col("f0")))
    carried = F.filter(seen, lambda s: s["link"] & (s["pb"] > F.col("f0")))
    c = F.col
    return x.withColumn("replay", ru.replayed_moment(c("k0") % 6 != 0, c("utility"), c("context"), c("status"), c("cited"), F.size(seen), F.size(carried)))


@query(_sql(("sh",), _EVENTS + ",\n" + _REPLAY, "SELECT movie_id, event, reason, CASE WHEN reason IS NULL THEN cls END AS utility_class, CASE WHEN reason IS NULL THEN CASE WHEN status = 'reusable_state' THEN 'sustained_state' ELSE 'complete_action' END END AS kind, CASE WHEN reason IS NULL THEN list_min(frames) END AS start_frame, CASE WHEN reason IS NULL THEN list_max(frames) + 1 END AS end_frame FROM rp"))
def p05_replayed_moments(spark: SparkSession, d: str) -> DataFrame:
    return _replayed(_events(spark, d)).select("movie_id", "event", "replay.*")


_POLICY = f"""ob0 AS (SELECT *, (ev + movie_id) % 11 <> 0 AS known, CASE WHEN k0 < 6 THEN [{fx._list(fx.FLAGS)}[k0 + 1]] ELSE []::VARCHAR[] END AS flags, CASE WHEN k0 % 4 = 3 THEN reason END AS replay, k0 % 3 <> 1 AS assessed, k0 % 10 = 5 AS blocked FROM rp),
ob1 AS (SELECT *, CASE WHEN NOT known THEN 'missing' WHEN len(flags) > 0 THEN 'flags' WHEN k0 % 37 = 9 THEN 'mismatch' WHEN len(errs) > 0 THEN 'errors' WHEN replay IS NOT NULL THEN 'replay' END AS settled FROM ob0),
st AS (SELECT *, CASE WHEN k0 % 11 = 0 THEN 'WEAK' WHEN k0 % 7 = 0 OR kind = 'unclear' THEN 'REVIEW' WHEN me - ms > 480 AND kind = 'reaction' THEN 'REVIEW' ELSE 'CANDIDATE' END AS state, me - ms > 480 AND kind IN ('sustained_state', 'composition') AS clip FROM ob1 WHERE settled IS NULL),
cl AS (SELECT movie_id, ev, event, state, k0 % 25 AS key, CASE WHEN clip THEN ms + (me - ms - 480) // 2 ELSE ms END AS a, CASE WHEN clip THEN ms + (me - ms - 480) // 2 + 480 ELSE me END AS b FROM st),
ca AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY ev) AS i FROM cl WHERE state = 'CANDIDATE'),
cn AS (SELECT movie_id, max(i) AS n FROM ca GROUP BY movie_id),
fo(movie_id, i, kept) AS (SELECT movie_id, 0::BIGINT, []::STRUCT(m BIGINT, a BIGINT, b BIGINT, key BIGINT)[] FROM cn
 UNION ALL SELECT fo.movie_id, fo.i + 1, CASE WHEN len(list_filter(kept, lambda p: p.key = ca.key OR greatest(0, least(ca.b, p.b) - greatest(ca.a, p.a)) >= 0.8::DOUBLE * least(ca.b - ca.a, p.b - p.a))) > 0 THEN kept ELSE list_append(kept, struct_pack(m := ca.event, a := ca.a, b := ca.b, key := ca.key)) END FROM fo JOIN ca ON ca.movie_id = fo.movie_id AND ca.i = fo.i + 1),
won AS (SELECT unnest(list_transform(kept, lambda p: p.m)) AS event FROM fo JOIN cn ON cn.movie_id = fo.movie_id AND cn.n = fo.i),
pl AS (SELECT cl.event, CASE WHEN state <> 'CANDIDATE' THEN state WHEN won.event IS NOT NULL THEN 'WINDOW' ELSE 'SUPPRESSED' END AS state FROM cl LEFT JOIN won ON won.event = cl.event),
pd AS (SELECT ob1.*, pl.state, CASE WHEN settled = 'missing' THEN 'REVIEW' WHEN settled = 'flags' THEN 'REJECT' WHEN settled IS NOT NULL THEN 'REVIEW' WHEN pl.state = 'WINDOW' THEN 'KEEP' WHEN pl.state = 'REVIEW' OR (pl.state <> 'SUPPRESSED' AND NOT assessed) THEN 'REVIEW' ELSE 'REJECT' END AS first,
  CASE settled WHEN 'missing' THEN ['missing_valid_observation'] WHEN 'flags' THEN ['hard_exclusion:' || flags[1]] WHEN 'mismatch' THEN ['observation_event_mismatch'] WHEN 'errors' THEN errs WHEN 'replay' THEN [replay] ELSE CASE WHEN pl.state = 'WINDOW' THEN ['visually_reusable_moment'] WHEN pl.state = 'REVIEW' OR (pl.state <> 'SUPPRESSED' AND NOT assessed) THEN ['visual_window_not_established'] ELSE ['duplicate_or_weak_visual_utility'] END END AS why FROM ob1 LEFT JOIN pl USING (event)),
pf AS (SELECT movie_id, event, CASE WHEN first = 'REVIEW' AND blocked THEN 'PROVIDER_BLOCKED' ELSE first END AS decision, CASE WHEN first = 'REVIEW' AND blocked THEN CASE WHEN settled = 'missing' THEN ['provider_input_quarantine'] ELSE list_concat(['provider_input_quarantine'], why) END ELSE why END AS reasons, CASE WHEN state = 'WINDOW' THEN 1 ELSE 0 END AS windows, first = 'REVIEW' AND NOT blocked AS again FROM pd)"""


def _policy(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k0")
    x = _replayed(_judged(spark, d)).withColumn("event_id", F.col("event")).select("movie_id", "ev", "event", "event_id", "k0", "kind", "ms", "me", "errs", F.struct("replay.reason").alias("replay"))
    x = cut(x, "judged")  # written once: both tables below are read in several places
    flags = F.when(k < 6, F.array(fx.pick(fx.FLAGS, k))).otherwise(F.array().cast("array<string>"))
    obs = x.select("movie_id", "event_id", ((F.col("ev") + F.col("movie_id")) % 11 != 0).alias("known"), flags.alias("flags"), (k % 37 != 9).alias("same_event"), F.col("errs").alias("errors"), F.when(k % 4 == 3, F.col("replay.reason")).alias("replay"), (k % 3 != 1).alias("assessed"), (k % 10 == 5).alias("blocked"))
    moments = x.select("movie_id", F.col("ev").alias("ord"), "event_id", F.col("event").alias("moment"), "kind", F.col("ms").alias("start_frame"), F.col("me").alias("end_frame"), (k % 25).alias("reuse_key"), (k % 11 == 0).alias("weak"), (k % 7 != 0).alias("clear"))
    return ru.decide_reuse(obs, moments, fx.FPS)


@query(_sql(("sh",), _EVENTS + ",\n" + _REPLAY + ",\n" + _POLICY, "SELECT movie_id, event, decision, reasons, CAST(windows AS BIGINT) AS windows, again FROM pf"))
def p04_policy_v2(spark: SparkSession, d: str) -> DataFrame:
    return _policy(spark, d).withColumnRenamed("event_id", "event")


@query(_sql(("sh",), _EVENTS + ",\n" + _REPLAY + ",\n" + _POLICY, "SELECT movie_id, count(*) FILTER (decision = 'KEEP') AS keep, count(*) FILTER (decision = 'REVIEW') AS review, count(*) FILTER (decision = 'REJECT') AS reject, count(*) FILTER (decision = 'PROVIDER_BLOCKED') AS blocked, CAST(sum(windows) AS BIGINT) AS windows, count(*) FILTER (again) AS again FROM pf GROUP BY movie_id"))
def p07_catalog_replay(spark: SparkSession, d: str) -> DataFrame:
    n = lambda s: F.count_if(F.col("decision") == s)
    return _policy(spark, d).groupBy("movie_id").agg(n("KEEP").alias("keep"), n("REVIEW").alias("review"), n("REJECT").alias("reject"), n("PROVIDER_BLOCKED").alias("blocked"), F.sum("windows").alias("windows"), F.count_if("again").alias("again"))


_PROJECTED = f"""x6 AS (SELECT *, k0 % 6 <> 0 AS temporal, CASE WHEN utility = 'generic_dialogue_only' AND k0 % 2 = 0 THEN 'conversation_scene' ELSE cls END AS cls2, len(list_distinct(ids)) = len(ids) AND NOT unknown AND len(frames) >= 2 AS support,
  CASE WHEN k0 % 6 <> 0 AND status = 'reusable_state' AND utility = 'useful_state' AND k0 % 5 <> 4 AND complete IN ('false', 'unclear') THEN 'sustained_state' WHEN k0 % 6 <> 0 AND status = 'complete_action' AND complete = 'true' THEN 'complete_action' END AS use_kind FROM rp),
y6 AS (SELECT *, list_filter([CASE WHEN NOT list_contains({_CLASSES}, cls2) THEN 'missing_moment_utility_category' END, CASE WHEN NOT support THEN 'missing_temporal_support' END, CASE WHEN context NOT IN ('low', 'medium') THEN 'missing_context_dependency_interpretation' END, CASE WHEN use_kind IS NULL THEN 'missing_action_or_sustained_state_assessment' END], {_GIVEN}) AS absent FROM x6),
sp6 AS (SELECT movie_id, ev, shot_id, min(frame) AS a, max(frame) + 1 AS b, list(sample_id ORDER BY frame, sample_id) AS span_ids FROM (SELECT movie_id, ev, unnest(rows, recursive := true) FROM rp) GROUP BY movie_id, ev, shot_id HAVING count(DISTINCT frame) >= 2),
sq6 AS (SELECT movie_id, ev, arg_max(struct_pack(a := a, b := b, ids := span_ids), (b - a, -a)) AS span FROM sp6 GROUP BY movie_id, ev),
z6 AS (SELECT y6.*, span, coalesce(reason = 'asset_cut_continuity_requires_visual_assessment' AND status = 'reusable_state' AND span IS NOT NULL, false) AS can_save FROM y6 LEFT JOIN sq6 USING (movie_id, ev)),
pj6 AS MATERIALIZED (SELECT *, CASE WHEN len(absent) > 0 THEN absent WHEN reason IS NULL OR can_save THEN [] ELSE [reason] END AS missing FROM z6),
pm6 AS (SELECT *, len(missing) = 0 AND can_save AS saved, CASE WHEN len(missing) = 0 THEN CASE WHEN can_save THEN 'sustained_state' WHEN status = 'reusable_state' THEN 'sustained_state' ELSE 'complete_action' END END AS p_kind,
  CASE WHEN len(missing) = 0 THEN CASE WHEN can_save THEN span.a ELSE list_min(frames) END END AS p_a, CASE WHEN len(missing) = 0 THEN CASE WHEN can_save THEN span.b ELSE list_max(frames) + 1 END END AS p_b FROM pj6)"""


def _projected(x: DataFrame) -> DataFrame:
    """x with p: what its observation supports."""
    c, k = F.col, F.col("k0")
    states = F.when(k % 5 != 4, F.array(F.lit("sitting"))).otherwise(F.array().cast("array<string>"))
    talks = F.when(k % 2 == 0, "true").otherwise("false")
    return x.withColumn("p", ru.compatibility_projection(k % 6 != 0, c("utility"), talks, c("context"), c("status"), c("complete"), states, c("ids"), c("samples"), c("shots"), c("es"), c("ee"), c("replay")))


@query(_sql(("sh",), _EVENTS + ",\n" + _REPLAY + ",\n" + _PROJECTED, """SELECT movie_id, event, missing, list_filter([CASE WHEN NOT list_contains(missing, 'missing_moment_utility_category') THEN 'utility_class=' || cls2 END, CASE WHEN context IN ('low', 'medium') THEN 'visual_context_dependency=' || context END, CASE WHEN support THEN 'temporal_support=' || array_to_string(ids, ',') END,
 CASE WHEN use_kind IS NOT NULL THEN 'moment_usability=usable' END, CASE WHEN use_kind IS NOT NULL THEN 'moment_kind=' || use_kind END, CASE WHEN len(missing) = 0 THEN 'asset_window_eligibility=true' END], lambda x: x IS NOT NULL) AS fields, CASE WHEN temporal THEN 'temporal_v2' ELSE 'existing_observation' END AS origin,
 p_kind AS kind, p_a AS start_frame, p_b AS end_frame, saved FROM pm6"""))
def p06_compatibility_projection(spark: SparkSession, d: str) -> DataFrame:
    x = _projected(_replayed(_events(spark, d)))
    fields = F.transform("p.fields", lambda f: F.concat(f["name"], F.lit("="), f["value"]))
    return x.select("movie_id", "event", F.col("p.missing").alias("missing"), fields.alias("fields"), F.when(F.col("k0") % 6 != 0, "temporal_v2").otherwise("existing_observation").alias("origin"), "p.kind", "p.start_frame", "p.end_frame", "p.saved")


# older observations (k0 % 4 = 3) have no moments of their own: theirs are projected, and checked like any other
_COMPATIBLE = _POLICY.replace("FROM rp),", "FROM rc),", 1).replace("CASE WHEN k0 % 4 = 3 THEN reason END AS replay, k0 % 3 <> 1 AS assessed", "CASE WHEN old AND len(missing) > 0 THEN missing END AS replay, NOT old AND k0 % 3 <> 1 AS assessed")
_COMPATIBLE = _COMPATIBLE.replace("WHEN 'replay' THEN [replay]", "WHEN 'replay' THEN replay").replace("CASE WHEN k0 % 11 = 0 THEN 'WEAK' WHEN k0 % 7 = 0 OR kind = 'unclear' THEN 'REVIEW'", "CASE WHEN NOT old AND k0 % 11 = 0 THEN 'WEAK' WHEN CASE WHEN old THEN NOT sound ELSE k0 % 7 = 0 OR kind = 'unclear' END THEN 'REVIEW'")
_COMPATIBLE = _COMPATIBLE.replace("k0 % 25 AS key", "CASE WHEN old THEN -event ELSE k0 % 25 END AS key")
_RC = """rc0 AS (SELECT *, k0 % 4 = 3 AS old, list_sort(list_transform(rows, lambda r: r.frame)) AS fs, len(list_filter(seen, lambda s: NOT list_contains(list_transform(rows, lambda r: r.shot_id), s.shot_id))) = 0 AS shown FROM pm6),
rc AS (SELECT * EXCLUDE (kind, ms, me, errs), CASE WHEN old THEN p_kind ELSE kind END AS kind, CASE WHEN old THEN p_a ELSE ms END AS ms, CASE WHEN old THEN p_b ELSE me END AS me, CASE WHEN old THEN [] ELSE errs END AS errs,
  saved OR (shown AND (p_kind <> 'complete_action' OR (len(fs) >= 3 AND len(list_filter(fs[2:-2], lambda f: f <= fs[1] OR f >= fs[-1])) = 0))) AS sound FROM rc0)"""


def _compatible(spark: SparkSession, d: str) -> DataFrame:
    c, k = F.col, F.col("k0")
    x = _projected(_replayed(_judged(spark, d))).withColumn("event_id", c("event")).withColumn("old", k % 4 == 3)
    cited = let(c("p.ids"), lambda ids: F.array_sort(F.transform(F.filter("samples", lambda s: F.array_contains(ids, s["sample_id"])), lambda s: F.struct(s["frame"].alias("frame"), s["sample_id"].alias("sample_id")))))
    x = x.withColumn("cited_ids", F.transform(cited, lambda s: s["sample_id"]))
    action = c("p.kind") == "complete_action"
    first, last = F.when(action, F.get("cited_ids", F.lit(0))), F.when(action, F.element_at("cited_ids", -1))
    middle = F.when(action & (F.size("cited_ids") > 2), F.slice("cited_ids", F.lit(2), F.size("cited_ids") - 2)).otherwise(F.array().cast("array<string>"))
    made = ru.moment_errors(c("p.start_frame"), c("p.end_frame"), c("es"), c("ee"), c("p.kind"), c("complete"), first, middle, last, c("p.ids"), F.lit("supported"), c("samples"), c("shots"))
    # written once: both tables below are read in several places; only older moments are looked at
    x = x.withColumn("made", F.when(c("old"), F.size(made)))
    x = cut(x.select("movie_id", "ev", "event", "event_id", "k0", "old", "kind", "ms", "me", "errs", F.struct("p.kind", "p.start_frame", "p.end_frame", "p.missing").alias("p"), "made"), "projected")
    own = lambda old, new: F.when(c("old"), old).otherwise(new)
    none = F.array().cast("array<string>")
    flags = F.when(k < 6, F.array(fx.pick(fx.FLAGS, k))).otherwise(none)
    obs = x.select("movie_id", "event_id", ((c("ev") + c("movie_id")) % 11 != 0).alias("known"), flags.alias("flags"), (k % 37 != 9).alias("same_event"), own(none, c("errs")).alias("errors"), own(c("p.missing"), none).alias("replay"), (~c("old") & (k % 3 != 1)).alias("assessed"), (k % 10 == 5).alias("blocked"))
    moments = x.select(
        "movie_id", c("ev").alias("ord"), "event_id", c("event").alias("moment"), own(c("p.kind"), c("kind")).alias("kind"), own(c("p.start_frame"), c("ms")).alias("start_frame"), own(c("p.end_frame"), c("me")).alias("end_frame"), own(-c("event"), k % 25).alias("reuse_key"),
        (~c("old") & (k % 11 == 0)).alias("weak"), own(c("made") == 0, k % 7 != 0).alias("clear"),
    )
    return ru.decide_reuse(obs, moments, fx.FPS)


_COMPATIBLE_SQL = _EVENTS + ",\n" + _REPLAY + ",\n" + _PROJECTED + ",\n" + _RC + ",\n" + _COMPATIBLE


@query(_sql(("sh",), _COMPATIBLE_SQL, "SELECT movie_id, event, decision, reasons, CAST(windows AS BIGINT) AS windows, again FROM pf"))
def p04_policy_v2_compatible(spark: SparkSession, d: str) -> DataFrame:
    """As p04, older observations through the compatibility projection."""
    return _compatible(spark, d).withColumnRenamed("event_id", "event")


@query(_sql(("sh",), _COMPATIBLE_SQL, "SELECT movie_id, count(*) FILTER (decision = 'KEEP') AS keep, count(*) FILTER (decision = 'REVIEW') AS review, count(*) FILTER (decision = 'REJECT') AS reject, count(*) FILTER (decision = 'PROVIDER_BLOCKED') AS blocked, CAST(sum(windows) AS BIGINT) AS windows, count(*) FILTER (again) AS again FROM pf GROUP BY movie_id"))
def p07_catalog_replay_compatible(spark: SparkSession, d: str) -> DataFrame:
    n = lambda s: F.count_if(F.col("decision") == s)
    return _compatible(spark, d).groupBy("movie_id").agg(n("KEEP").alias("keep"), n("REVIEW").alias("review"), n("REJECT").alias("reject"), n("PROVIDER_BLOCKED").alias("blocked"), F.sum("windows").alias("windows"), F.count_if("again").alias("again"))


@query(_sql(("sh",), _EVENTS, "SELECT movie_id, event, complete AS raw, CASE WHEN status = 'reusable_state' THEN 'true' ELSE complete END AS effective FROM em"))
def p08_temporal_projection(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select("movie_id", "event", F.col("complete").alias("raw"), ru.effective_completeness(F.col("status"), F.col("complete")).alias("effective"))


@query(_sql(("sh",), _EVENTS, "SELECT movie_id, event AS event_id, utility AS label, event || ':ACTION_' || substr(sha256(utility || '|distinct_visible_action_or_reaction|' || array_to_string(ids, ',')), 1, 16) AS action_id FROM ef WHERE k0 % 3 = 1 AND NOT unknown AND len(frames) >= 2"))
def p10_grounded_actions(spark: SparkSession, d: str) -> DataFrame:
    kinds = ("unclear", "distinct_visible_action_or_reaction", "generic_presence_or_movement")
    x = _events(spark, d)
    frames = F.size(F.array_distinct(F.transform(F.filter("samples", lambda s: F.array_contains("ids", s["sample_id"])), lambda s: s["frame"])))
    return ru.grounded_actions(x.select("movie_id", F.col("event").alias("event_id"), F.col("utility").alias("label"), fx.pick(kinds, F.col("k0") % 3).alias("evidence"), "ids", F.col("all_ids").alias("known"), frames.alias("frames")))


@query(_sql(("sh",), _EVENTS + """, w0 AS (SELECT DISTINCT movie_id, event, es, ee, shots, CASE WHEN r = 0 THEN es ELSE es + 1 END AS a, CASE WHEN r = 0 THEN ee ELSE ee - 1 END AS b FROM e1, unnest([0, 1, 1]) t(r))""",
"SELECT movie_id, event AS event_id, substr(sha256('producer_window_v1:' || event || ':' || a || ':' || b), 1, 24) AS window_id, a = es AND b = ee AS whole, list_transform(list_filter(shots, lambda s: s.a < w0.b AND s.b > w0.a), lambda s: s.shot_id || '@' || greatest(s.a, w0.a) || '-' || least(s.b, w0.b)) AS shots FROM w0 WHERE a < b"))
def p16_producer_candidates(spark: SparkSession, d: str) -> DataFrame:
    x = _events(spark, d).select("movie_id", F.col("event").alias("event_id"), F.col("es").alias("event_start"), F.col("ee").alias("event_end"), "shots")
    r = F.explode(F.array(F.lit(0), F.lit(1), F.lit(1)))
    w = x.drop("shots").withColumn("r", r).withColumn("start_frame", F.col("event_start") + F.col("r")).withColumn("end_frame", F.col("event_end") - F.col("r")).drop("r")
    s = x.select("movie_id", "event_id", F.explode("shots").alias("s")).select("movie_id", "event_id", "s.shot_id", "s.start_frame", "s.end_frame")
    got = ru.producer_candidates(w, s)
    return got.withColumn("shots", F.transform("shots", lambda s: F.concat(s["shot_id"], F.lit("@"), s["start_frame"].cast("string"), F.lit("-"), s["end_frame"].cast("string"))))


_RAW = """rs AS (SELECT event_id // 8 AS request_id, event_id, k FROM ev),
raw AS (SELECT request_id, event_id AS e, k FROM rs WHERE k % 9 <> 0 AND k % 33 <> 4 UNION ALL SELECT request_id, event_id, k FROM rs WHERE k % 10 = 1 UNION ALL SELECT request_id, event_id + 1000000000, k FROM rs WHERE k % 25 = 2 UNION ALL SELECT request_id, NULL, k FROM rs WHERE k % 33 = 4),
ans AS (SELECT request_id, e, count(*) AS n, max(CASE WHEN k % 6 <> 2 THEN 'true' ELSE 'false' END) AS valid, bool_or(k % 7 = 3) AS open_ FROM raw GROUP BY ALL)"""


@query(_sql(("ev",), _RAW, "SELECT coalesce(rs.request_id, ans.request_id) AS request_id, coalesce(rs.event_id, e) AS event_id, CASE WHEN rs.event_id IS NULL THEN 'EXTRA' WHEN n IS NULL THEN 'MISSING_FROM_BATCH_RESPONSE' WHEN n > 1 OR valid <> 'true' THEN 'VALIDATION_BLOCKED' WHEN open_ THEN 'VALID_INCONCLUSIVE' ELSE 'VALID' END AS status FROM rs FULL JOIN ans ON ans.request_id = rs.request_id AND ans.e = rs.event_id"))
def p18_response_ingest(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).select(F.floor(F.col("event_id") / 8).alias("request_id"), "event_id", "k")
    k = F.col("k")
    text = lambda i: F.concat(F.lit('{"event_id": '), i.cast("string"), F.lit(', "valid": '), (k % 6 != 2).cast("string"), F.lit(', "inconclusive": '), (k % 7 == 3).cast("string"), F.lit("}"))
    say = lambda cond, raw: e.where(cond).select("request_id", raw.alias("raw"))
    own = text(F.col("event_id"))
    responses = say((k % 9 != 0) & (k % 33 != 4), own).union(say(k % 10 == 1, own)).union(say(k % 25 == 2, text(F.col("event_id") + 1000000000))).union(say(k % 33 == 4, F.lit("no answer {")))
    return ru.ingest_responses(e.select("request_id", "event_id"), responses)


@query(_sql(("ev",), "", "SELECT user_id AS movie_id, event_id, k % 5 <> 0 AND k % 7 <> 0 AND k % 3 <> 0 AND k % 11 <> 0 AS reusable FROM ev"))
def p20_checkpoint_reuse(spark: SparkSession, d: str) -> DataFrame:
    e = fx.observations(spark, d).select("movie_id", "event_id", "k", F.lit("v2").alias("version"), F.concat(F.lit("id"), F.col("k").cast("string")).alias("identity"))
    k = F.col("k")
    saved = e.where(k % 11 != 0).withColumn("identity", F.when(k % 5 == 0, "other").otherwise(F.col("identity"))).withColumn("valid", k % 7 != 0).withColumn("focus", k % 3 != 0)
    return ru.reusable_checkpoints(e, saved, ["movie_id", "event_id"], ["version", "identity"])


@query(_sql(("rec",), "", "SELECT movie_id, event_id, max(r) AS attempt FROM rec WHERE valid AND (event_id + r) % 2 = event_id // 2 % 2 GROUP BY ALL"))
def p21_offline_recovery(spark: SparkSession, d: str) -> DataFrame:
    a = fx.records(spark, d).select("movie_id", "event_id", F.col("r").cast("bigint").alias("attempt"), ((F.col("event_id") + F.col("r")) % 2).alias("identity"), "valid")
    w = fx.observations(spark, d).select("movie_id", "event_id", (F.floor(F.col("event_id") / 2) % 2).alias("identity"))
    return ru.recovered(a, w)


_FOCUS = ("woman", "man", "multiple_people", "action_region", "environment", "unclear", "ghost")
_PLACES = ("left", "center", "right", "multiple", "unclear")
_NEEDS = ("none", "sequence", "simultaneous", "unclear", "always")


@query(_sql(("sh",), f"dr AS (SELECT movie_id, shot_id, k, {fx._list(_FOCUS)}[event_id % 7 + 1] AS subject, {fx._list(_PLACES)}[k % 5 + 1] AS place, {fx._list(_NEEDS)}[k // 5 % 5 + 1] AS need FROM sh)", f"""SELECT movie_id, shot_id, list_filter([CASE WHEN k % 17 = 0 THEN 'focus_reason:missing_required_field' END, CASE WHEN subject = 'ghost' THEN 'focus_subject:unsupported_enum' END, CASE WHEN need = 'always' THEN 'interaction_requirement:unsupported_enum' END,
 CASE WHEN (subject IN ('woman', 'man') AND place NOT IN ('left', 'center', 'right')) OR (subject = 'multiple_people' AND place <> 'multiple') THEN 'focus_position:incompatible_focus_position' END, CASE WHEN k % 8 = 0 THEN 'target_person_ids:duplicate_person_id' END], {_GIVEN}) AS errors FROM dr"""))
def v10_directive_rules(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    x = fx.shots(spark, d).select(
        "movie_id", "shot_id", fx.pick(_FOCUS, F.col("event_id") % 7).alias("focus_subject"), F.when(k % 17 != 0, "seen").alias("focus_reason"), F.lit(False).alias("preserve_secondary_subject"),
        fx.pick(_NEEDS, F.floor(k / 5) % 5).alias("interaction_requirement"), fx.pick(_PLACES, k % 5).alias("focus_position"), F.when(k % 8 == 0, F.array(F.lit("P1"), F.lit("P1"))).otherwise(F.array(F.lit("P1"))).alias("target_person_ids"),
    )
    return x.select("movie_id", "shot_id", directive_errors().alias("errors"))


def directive_errors():
    """field:reason of each fault of a focus directive in the columns that it is named for (fixed values: fields and vocabularies)."""
    c, rules = F.col, []
    for f in ("shot_id", "focus_subject", "focus_reason", "preserve_secondary_subject", "interaction_requirement", "focus_position"):
        rules.append((c(f).isNull(), f"{f}:missing_required_field"))
    for f, known in (("focus_subject", _FOCUS[:6]), ("interaction_requirement", _NEEDS[:4]), ("focus_position", _PLACES)):
        rules.append((~c(f).isin(*known), f"{f}:unsupported_enum"))
    allowed = F.when(c("focus_subject").isin("woman", "man"), c("focus_position").isin("left", "center", "right")).when(c("focus_subject") == "multiple_people", c("focus_position") == "multiple").otherwise(True)
    rules.append((c("focus_position").isin(*_PLACES) & ~allowed, "focus_position:incompatible_focus_position"))
    rules.append((F.size(F.array_distinct("target_person_ids")) < F.size("target_person_ids"), "target_person_ids:duplicate_person_id"))
    return errors(*rules)


@query(_sql(("sh",), _EVENTS + """, dv AS (SELECT *, list_concat(list_concat(CASE WHEN k0 % 17 = 0 THEN shot_ids[:-2] ELSE shot_ids END, CASE WHEN k0 % 12 = 0 THEN [shot_ids[1]] ELSE []::VARCHAR[] END), CASE WHEN k0 % 14 = 0 THEN ['FULL_SHOT_X'] ELSE []::VARCHAR[] END) AS got FROM e1)""",
"SELECT movie_id, event, list_filter(shot_ids, lambda s: NOT list_contains(got, s)) AS missing, list_filter(shot_ids, lambda s: len(list_filter(got, lambda g: g = s)) > 1) AS duplicate, list_filter(got, lambda g: NOT list_contains(shot_ids, g)) AS unexpected FROM dv"))
def v19_focus_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    k, none = F.col("k0"), F.array().cast("array<string>")
    x = _events(spark, d).withColumn("got", F.concat(F.when(k % 17 == 0, F.slice("shot_ids", 1, F.size("shot_ids") - 1)).otherwise(F.col("shot_ids")), F.when(k % 12 == 0, F.slice("shot_ids", 1, 1)).otherwise(none), F.when(k % 14 == 0, F.array(F.lit("FULL_SHOT_X"))).otherwise(none)))
    twice = F.filter("shot_ids", lambda s: F.size(F.filter("got", lambda g: g == s)) > 1)
    return x.select("movie_id", "event", F.array_except("shot_ids", "got").alias("missing"), twice.alias("duplicate"), F.array_except("got", "shot_ids").alias("unexpected"))


def _people(spark: SparkSession, d: str) -> DataFrame:
    return fx.boxes(spark, d).select("*", F.struct("x", "y", "w", "h").alias("box"))


@query(_sql(("bx",), """nm AS MATERIALIZED (SELECT *, 'P' || row_number() OVER (PARTITION BY movie_id, shot_id, sample ORDER BY x + w / 2, y + h / 2, confidence DESC, person) AS label FROM bx),
ip AS (SELECT movie_id, shot_id, sample, any_value(k) AS k, list(struct_pack(label := label, x := x, y := y, w := w, h := h)) AS people FROM nm GROUP BY ALL),
iq AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'P1' WHEN k % 9 = 0 THEN 'FULL_SHOT_X:P1' ELSE shot_id || ':P' || (1 + k % 4) END AS identity, 'P' || CASE WHEN k % 11 = 0 OR k % 9 = 0 THEN 1 ELSE 1 + k % 4 END AS label FROM ip),
ib AS (SELECT *, list_filter(people, lambda p: p.label = iq.label)[1] AS b FROM iq),
ir AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'malformed_person_identity' WHEN k % 9 = 0 THEN 'cross_shot_person_identity' WHEN b IS NULL THEN 'missing_local_target' WHEN len(list_filter(people, lambda p: p.label <> ib.label AND greatest(0, least(p.x + p.w, b.x + b.w) - greatest(p.x, b.x)) * greatest(0, least(p.y + p.h, b.y + b.h) - greatest(p.y, b.y))
  >= 0.95::DOUBLE * (p.w * p.h + b.w * b.h - greatest(0, least(p.x + p.w, b.x + b.w) - greatest(p.x, b.x)) * greatest(0, least(p.y + p.h, b.y + b.h) - greatest(p.y, b.y))))) > 0 THEN 'ambiguous_reference_geometry' END AS reason FROM ib)""",
"SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, identity, CASE WHEN reason IS NULL THEN label END AS local, reason FROM ir"))
def b03_person_identities(spark: SparkSession, d: str) -> DataFrame:
    people = geo.number_persons(fx.boxes(spark, d))
    k = F.col("k")
    named = F.when(k % 11 == 0, "P1").when(k % 9 == 0, "FULL_SHOT_X:P1").otherwise(F.concat("shot_id", F.lit(":P"), (1 + k % 4).cast("string")))
    asked = fx.boxes(spark, d).select("movie_id", "shot_id", "sample", "k").distinct().select("movie_id", "shot_id", "sample", named.alias("identity"))
    return fc.resolve_identities(asked, people)


@query(_sql(("bx",), """tg AS (SELECT *, (person + k) % 4 = 0 AS fore, (person + event_id) % 2 = 0 AS face, [0.25, 0.5, 0.75, NULL][k % 4 + 1] * 1920 AS goal FROM bx),
t1 AS (SELECT * FROM tg QUALIFY NOT fore OR bool_and(fore) OVER (PARTITION BY movie_id, shot_id, sample)), t2 AS (SELECT * FROM t1 QUALIFY face OR NOT bool_or(face) OVER (PARTITION BY movie_id, shot_id, sample)),
t3 AS (SELECT *, count(*) OVER (PARTITION BY movie_id, shot_id, sample) AS n FROM t2)""",
"SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, CAST(person AS INTEGER) AS person FROM t3 WHERE n = 1 OR goal IS NOT NULL QUALIFY row_number() OVER (PARTITION BY movie_id, shot_id, sample ORDER BY coalesce(abs(x + w / 2 - goal), 0), confidence DESC, person) = 1"))
def b08_spatial_target(spark: SparkSession, d: str) -> DataFrame:
    b = fx.boxes(spark, d)
    x = b.select("movie_id", "shot_id", "sample", "person", "x", "w", "confidence", ((F.col("person") + F.col("k")) % 4 == 0).alias("foreground"), ((F.col("person") + F.col("event_id")) % 2 == 0).alias("face"))
    wanted = b.select("movie_id", "shot_id", "sample", fx.pick(("left", "center", "right", "none"), F.col("k") % 4).alias("where")).distinct()
    return fc.choose_target(x, wanted, 1920.0)


_FACES = """fa AS (SELECT movie_id, shot_id, sample, person AS face, x + w / 3 AS fx, y + h / 20 AS fy, w / 3 AS fw, w / 3 AS fh FROM bx WHERE (person + k) % 3 <> 0),
fp AS (SELECT fa.*, person, x, y, w, h, greatest(0, least(fx + fw, x + w) - greatest(fx, x)) * greatest(0, least(fy + fh, y + h) - greatest(fy, y)) / greatest(1, fw * fh) AS own FROM fa JOIN bx ON bx.movie_id = fa.movie_id AND bx.shot_id = fa.shot_id AND bx.sample = fa.sample),
fl AS (SELECT movie_id, shot_id, sample, face, list(struct_pack(x := x, w := w, own := own)) AS people FROM fp GROUP BY ALL),
fb AS (SELECT fp.* FROM fp JOIN fl ON fl.movie_id = fp.movie_id AND fl.shot_id = fp.shot_id AND fl.sample = fp.sample AND fl.face = fp.face WHERE x <= fx + fw / 2 AND fx + fw / 2 <= x + w AND y <= fy + fh / 2 AND fy + fh / 2 <= y + h * 0.8::DOUBLE AND fw <= w * 1.1::DOUBLE AND own >= 0.8
  AND coalesce(own - list_max(list_transform(list_filter(people, lambda o: abs(o.x - fp.x) + abs(o.w - fp.w) > 2), lambda o: o.own)) >= 0.15, true))"""


@query(_sql(("bx",), _FACES, "SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, CAST(person AS INTEGER) AS target, CAST(min(face) AS INTEGER) AS face FROM fb GROUP BY movie_id, shot_id, sample, person HAVING count(*) = 1"))
def b11_face_binding(spark: SparkSession, d: str) -> DataFrame:
    p = _people(spark, d)
    face = F.struct((F.col("x") + F.col("w") / 3).alias("x"), (F.col("y") + F.col("h") / 20).alias("y"), (F.col("w") / 3).alias("w"), (F.col("w") / 3).alias("h"))
    faces = p.where((F.col("person") + F.col("k")) % 3 != 0).select("movie_id", "shot_id", "sample", F.col("person").alias("face"), face.alias("box"))
    return fc.bind_faces(faces, p)


@query(_sql(("bx",), """fc AS (SELECT movie_id, shot_id, sample, person, k, x, y, w / 3 AS w, w / 3 AS h, event_id % 7 * 200 AS l, greatest(w / 3 * 0.12::DOUBLE, 8) AS need FROM bx)""",
"""SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS sample, CAST(person AS INTEGER) AS person, CASE WHEN k % 10 = 3 OR k % 13 = 0 THEN 'AMBIGUOUS' WHEN x <= 1 OR x + w >= 1919 OR y <= 1 OR y + h >= 799 OR NOT (w + 2 * need <= 600 AND x >= need AND x + w <= 1920 - need) THEN 'SOURCE_LIMIT' WHEN least(x - l, l + 600 - x - w) < need THEN 'REPAIR' ELSE 'PASS' END AS decision,
 CASE WHEN k % 10 = 3 THEN 'semantic_target_binding_unresolved' WHEN k % 13 = 0 THEN 'face_detection_inconclusive' WHEN x <= 1 OR x + w >= 1919 OR y <= 1 OR y + h >= 799 THEN 'source_face_already_clipped' WHEN NOT (w + 2 * need <= 600 AND x >= need AND x + w <= 1920 - need) THEN 'face_exceeds_vertical_crop' WHEN least(x - l, l + 600 - x - w) < 0 THEN 'face_partially_clipped_but_source_has_room'
 WHEN least(x - l, l + 600 - x - w) < need AND x - l < l + 600 - x - w THEN 'primary_face_too_close_to_left_edge' WHEN least(x - l, l + 600 - x - w) < need THEN 'primary_face_too_close_to_right_edge' ELSE 'primary_face_safe' END AS reason FROM fc"""))
def b13_face_assessment(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    face = F.when(k % 13 != 0, F.struct("x", "y", (F.col("w") / 3).alias("w"), (F.col("w") / 3).alias("h")))
    x = fx.boxes(spark, d).withColumn("a", fc.assess_face(face, F.col("event_id") % 7 * 200, 600.0, 1920.0, 800.0, k % 10 != 3))
    return x.select("movie_id", "shot_id", "sample", "person", "a.*")


@query(_sql(("sh",), "", "SELECT movie_id, shot_id, CASE WHEN k % 9 = 0 THEN false WHEN k % 7 = 0 THEN true ELSE NOT (value / 40 + greatest(2, k / 4 * 0.2::DOUBLE) < k / 4) END AS holds FROM sh"))
def b19_boundary_provenance(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    return fx.shots(spark, d).select("movie_id", "shot_id", fc.boundary_holds(F.when(k % 9 != 0, k / 4), F.when(k % 7 != 0, F.col("value") / 40)).alias("holds"))


@query(_sql(("fs",), "", "SELECT movie_id, shot_id, CAST(sample AS INTEGER) AS frame FROM fs QUALIFY row_number() OVER (PARTITION BY movie_id, shot_id ORDER BY CASE WHEN sample = 1 THEN laplacian - 1 ELSE laplacian END DESC, sample) = 1"))
def w13_best_thumbnail(spark: SparkSession, d: str) -> DataFrame:
    f = fx.frame_stats(spark, d).select("movie_id", "shot_id", F.col("sample").alias("frame"), F.when(F.col("sample") == 1, F.col("laplacian") - 1).otherwise(F.col("laplacian")).alias("sharpness"))
    return fc.best_thumbnail(f, ["movie_id", "shot_id"])


@query(_sql(("sh",), "pe AS (SELECT movie_id, shot_id, list_transform(range(0, k % 4), lambda i: struct_pack(p := CASE WHEN (i + k) % 3 = 0 THEN NULL WHEN (i * k) % 2 = 0 THEN 'woman' ELSE 'man' END, r := CASE WHEN (i + event_id) % 2 = 0 THEN 'primary' ELSE 'secondary' END)) AS people FROM sh)",
"SELECT movie_id, shot_id, CAST(len(people) AS BIGINT) AS people_count, ['not_applicable', 'single_subject', 'two_person', 'group'][len(people) + 1] AS composition, CASE len(list_distinct(list_transform(people, lambda p: p.p))) WHEN 0 THEN NULL WHEN 1 THEN list_filter(list_transform(people, lambda p: p.p), lambda x: x IS NOT NULL)[1] ELSE 'mixed' END AS presentation, CASE WHEN len(list_filter(people, lambda p: p.r = 'primary')) > 0 THEN list_filter(people, lambda p: p.r = 'primary')[1].p ELSE people[1].p END AS \"primary\" FROM pe"))
def l07_people_summary(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    some = F.when(k % 4 > 0, F.sequence(F.lit(0).cast("bigint"), k % 4 - 1)).otherwise(F.array().cast("array<bigint>"))
    people = F.transform(some, lambda i: F.struct(F.when((i + k) % 3 == 0, F.lit(None).cast("string")).when((i * k) % 2 == 0, "woman").otherwise("man").alias("presentation"), F.when((i + F.col("event_id")) % 2 == 0, "primary").otherwise("secondary").alias("role")))
    return fx.shots(spark, d).select("movie_id", "shot_id", fc.people_summary(people).alias("p")).select("movie_id", "shot_id", "p.*")


@query(_sql(("lg",), "la AS (SELECT movie_id, event_id, arg_max(status, (ts_us, fingerprint, l_suppkey, l_extendedprice)) AS status FROM lg WHERE stage = 'finalization' GROUP BY ALL)", "SELECT movie_id, event_id // 8 AS batch, count(*) AS events, bool_and(status NOT IN ('PENDING', 'RUNNING', 'FAILED_RETRYABLE', 'STALE')) AS complete FROM la GROUP BY ALL"))
def l10_batch_finalization(spark: SparkSession, d: str) -> DataFrame:
    """A batch is complete if none of its events' latest finalization must run (again)."""
    x = fx.stage_log(spark, d).where("stage = 'finalization'").groupBy("movie_id", "event_id").agg(F.max_by("status", F.struct("ts_us", "fingerprint", "l_suppkey", "l_extendedprice")).alias("status"))
    return x.groupBy("movie_id", F.floor(F.col("event_id") / 8).alias("batch")).agg(F.count(F.lit(1)).alias("events"), F.bool_and(~F.col("status").isin("PENDING", "RUNNING", "FAILED_RETRYABLE", "STALE")).alias("complete"))


@query(_sql(("ass", "fil"), "fn AS (SELECT asset, count(*) AS n FROM fil GROUP BY asset)", "SELECT movie_id, asset, coalesce(n, 0) = 5 AND size % 6 <> 0 AND asset % 7 <> 0 AND (vertical = 'PASS' OR review = 'APPROVED') AS reusable FROM ass LEFT JOIN fn USING (asset)"))
def l11_rendition_reuse(spark: SparkSession, d: str) -> DataFrame:
    """A rendition is taken over if its package is complete, fingerprint and version are today's, and it may be published."""
    files = fx.asset_files(spark, d).groupBy("asset").agg(F.count(F.lit(1)).alias("n"))
    a = fx.assets(spark, d).withColumn("then", F.sha2(F.concat("name", F.when(F.col("size") % 6 == 0, "x").otherwise("")).cast("binary"), 256)).withColumn("now", F.sha2(F.col("name").cast("binary"), 256)).withColumn("version", F.when(F.col("asset") % 7 == 0, "old").otherwise("new"))
    ok = (F.coalesce("n", F.lit(0)) == len(fx.MEMBERS)) & (F.col("then") == F.col("now")) & (F.col("version") == "new") & ((F.col("vertical") == "PASS") | (F.col("review") == "APPROVED"))
    return a.join(files, "asset", "left").select("movie_id", "asset", ok.alias("reusable"))


@query(_sql(("fil",), "", "SELECT asset % 20 AS movie_id, bool_and(sha = recorded_sha) AS unchanged FROM fil GROUP BY ALL"))
def l13_inventory_signature(spark: SparkSession, d: str) -> DataFrame:
    """Is a title's inventory the same multiset of files as the recorded one? Differences of counts, so nothing is sorted."""
    f = fx.asset_files(spark, d).withColumn("movie_id", F.col("asset") % 20)
    both = F.explode(F.array(F.struct("sha", F.lit(1).alias("n")), F.struct(F.col("recorded_sha").alias("sha"), F.lit(-1).alias("n")))).alias("f")
    net = f.select("movie_id", "asset", "name", both).groupBy("movie_id", "asset", "name", "f.sha").agg(F.sum("f.n").alias("n"))
    return net.groupBy("movie_id").agg(F.bool_and(F.col("n") == 0).alias("unchanged"))


@query(_sql(("ass",), "", "SELECT movie_id, asset, asset % 9 <> 0 AND asset % 10 <> 0 AS matches FROM ass"))
def j09_registry_matches(spark: SparkSession, d: str) -> DataFrame:
    """An asset matches if exactly one registry row has its id, name and window; a changed name or a second row is tampering."""
    a = fx.assets(spark, d).select("movie_id", "asset", "name", "size")
    twice = F.explode(F.when(F.col("asset") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    reg = a.select("asset", F.when(F.col("asset") % 9 == 0, F.concat("name", F.lit("?"))).otherwise(F.col("name")).alias("r_name"), F.col("size").alias("r_size"), twice.alias("copy"))
    same = F.col("name").eqNullSafe(F.col("r_name")) & F.col("size").eqNullSafe(F.col("r_size"))
    return a.join(reg, "asset", "left").groupBy("movie_id", "asset").agg((F.count_if(same) == 1).alias("matches"))


@query(_sql(("ass", "fil"), "fv AS (SELECT asset, count(*) = 5 AND bool_and(sha = recorded_sha) AS good FROM fil GROUP BY asset)", "SELECT movie_id, asset, coalesce(good, false) AND size > 0 AS valid FROM ass LEFT JOIN fv USING (asset)"))
def v22_asset_metadata(spark: SparkSession, d: str) -> DataFrame:
    f = fx.asset_files(spark, d).groupBy("asset").agg((F.count(F.lit(1)) == len(fx.MEMBERS)).alias("whole"), F.bool_and(F.col("sha") == F.col("recorded_sha")).alias("same"))
    return fx.assets(spark, d).join(f, "asset", "left").select("movie_id", "asset", (F.coalesce(F.col("whole") & F.col("same"), F.lit(False)) & (F.col("size") > 0)).alias("valid"))
