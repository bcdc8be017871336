"""Queries over crop plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.operators import crops
from cutlight.plans import tracks as pt
from cutlight.registry import query

WIDTH, HEIGHT = 1920.0, 480.0
_ROLES = ("none", "sequence", "simultaneous", "unclear")
_SIDES = ("left", "center", "right", "unclear")
_BOX = ("x", "y", "w", "h")


def _inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Shots with directives of all kinds: none at all, nobody named, names that are wrong in each way, one or two persons, regions; shots that were not sampled; faces found by themselves."""
    s, k, e = fx.dealt_shots(spark, d), F.col("k"), F.col("event_id")
    p = lambda *ids: F.array(*[F.lit(i) if isinstance(i, str) else i for i in ids])
    own = F.concat("shot_id", F.lit(":P1"))
    wrong = {5: p("P1", "P1"), 6: p("OTHER:P1"), 7: p("P9"), 8: p("p1"), 9: F.array().cast("array<string>")}
    targets = F.when(k % 4 == 0, F.lit(None).cast("array<string>"))
    for at, ids in wrong.items():
        targets = targets.when(k % 13 == at, ids)
    targets = targets.when((e % 3 == 2) | (k % 5 == 1), p(own, "P2")).otherwise(p(own))
    region = F.struct(*[F.lit(float(v)).alias(c) for c, v in zip(_BOX, (700, 100, 200, 200))])
    directives = s.where(k % 17 != 4).select(
        "movie_id", "shot_id", fx.pick(crops.SUBJECTS, e % 6).alias("subject"), F.when(k % 8 == 0, "secondary").otherwise("primary").alias("role"), fx.pick(_ROLES, F.floor(k / 6) % 4).alias("need"),
        (k % 11 == 3).alias("secondary"), fx.pick(_SIDES, F.floor(e / 6) % 4).alias("place"), targets.alias("targets"), F.when(k % 9 == 2, F.array(region)).alias("regions"),
    )
    shots = s.select("movie_id", "shot_id", F.lit(-0.5).alias("start"), F.when(k % 2 == 0, 4.5).otherwise(3.0).alias("end"), fx.pick(("left", "center", "right"), k % 3).alias("position"))
    looked = k % 19 != 7
    persons = pt._boxes(spark, d).where(looked)
    seen = F.struct("sample", "person", *_BOX, "confidence", ((F.col("person") == 2) & (k % 5 == 1)).alias("foreground"), F.lit(False).alias("face"))
    found = F.struct(
        "sample", F.lit(11).alias("person"), (F.col("x") + F.col("w") * 0.3).alias("x"), "y", (F.col("w") * 0.4).alias("w"), (F.col("h") * 0.2).alias("h"), F.lit(0.7).alias("confidence"), F.lit(False).alias("foreground"), F.lit(True).alias("face"),
    )
    boxes = persons.select("movie_id", "shot_id", F.inline(F.when((k % 7 == 2) & (F.col("person") == 1) & (F.col("sample") <= 2), F.array(seen, found)).otherwise(F.array(seen))))
    wide = F.col("w") * F.when(k % 6 == 1, 1.2).otherwise(0.4)
    face = F.struct((F.col("x") + F.col("w") * 0.3).alias("x"), (F.col("y") + F.col("h") * 0.05).alias("y"), wide.alias("w"), (F.col("h") * 0.25).alias("h"))
    faces = persons.where((k + F.col("sample") + F.col("person")) % 4 != 1).select("movie_id", "shot_id", "sample", F.col("person").alias("face"), face.alias("box"))
    return {"shots": shots, "samples": pt._samples(spark, d, looked), "boxes": boxes, "faces": faces, "directives": directives}


_ID = "'^([A-Za-z0-9_][A-Za-z0-9_.-]*):P([1-9][0-9]*)$'"
_ON = lambda a, b, more="": f"{a}.movie_id = {b}.movie_id AND {a}.shot_id = {b}.shot_id" + "".join(f" AND {a}.{c} = {b}.{c}" for c in more.split())
_OVER = lambda a, b: f"greatest(0, least({a}.x + {a}.w, {b}.x + {b}.w) - greatest({a}.x, {b}.x)) * greatest(0, least({a}.y + {a}.h, {b}.y + {b}.h) - greatest({a}.y, {b}.y))"
_IOU = lambda a, b: f"{_OVER(a, b)} / ({a}.w * {a}.h + {b}.w * {b}.h - {_OVER(a, b)})"


def _sql(wish: str, everybody: str) -> str:
    return pt._HEAD + pt._WALKED + f""",
cd AS MATERIALIZED (SELECT movie_id, shot_id, k, k % 17 <> 4 AS directed, k % 19 <> 7 AS looked, CASE WHEN k % 17 = 4 THEN 'unclear' ELSE {fx._list(crops.SUBJECTS)}[event_id % 6 + 1] END AS subject,
  k % 17 = 4 OR k % 8 <> 0 AS prime, CASE WHEN k % 17 = 4 THEN 'none' ELSE {fx._list(_ROLES)}[k // 6 % 4 + 1] END AS need, k % 17 <> 4 AND k % 11 = 3 AS sec,
  CASE WHEN k % 17 <> 4 THEN [480, 960, 1440, NULL][event_id // 6 % 4 + 1] END AS side,
  CASE WHEN k % 17 = 4 OR k % 4 = 0 THEN NULL WHEN k % 13 = 5 THEN ['P1', 'P1'] WHEN k % 13 = 6 THEN ['OTHER:P1'] WHEN k % 13 = 7 THEN ['P9'] WHEN k % 13 = 8 THEN ['p1'] WHEN k % 13 = 9 THEN []::VARCHAR[]
   WHEN event_id % 3 = 2 OR k % 5 = 1 THEN [shot_id || ':P1', 'P2'] ELSE [shot_id || ':P1'] END AS targets, k % 17 <> 4 AND k % 9 = 2 AS act, CASE WHEN k % 2 = 0 THEN 4.5 ELSE 3.0 END::DOUBLE AS en FROM sh),
ci AS (SELECT movie_id, shot_id, nth, CASE WHEN regexp_full_match(tid, 'P[1-9][0-9]*') THEN shot_id || ':' || tid ELSE tid END AS tid FROM (SELECT movie_id, shot_id, unnest(targets) AS tid, generate_subscripts(targets, 1) AS nth FROM cd WHERE looked)),
cj AS (SELECT *, regexp_extract(tid, {_ID}, 1) AS owner, TRY_CAST(regexp_extract(tid, {_ID}, 2) AS BIGINT) AS lab FROM ci),
tw AS (SELECT DISTINCT a.movie_id, a.shot_id, a.label FROM tb a JOIN tb b ON {_ON("a", "b", "sample")} AND a.label <> b.label WHERE a.sample = 2 AND {_IOU("a", "b")} >= 0.95),
ck AS (SELECT j.movie_id, j.shot_id, nth, lab, CASE WHEN owner = '' THEN 'malformed_person_identity' WHEN owner <> j.shot_id THEN 'cross_shot_person_identity' WHEN t.label IS NULL THEN 'missing_local_target' WHEN tw.label IS NOT NULL THEN 'ambiguous_reference_geometry' END AS reason
  FROM cj j LEFT JOIN tb t ON {_ON("t", "j")} AND t.sample = 2 AND t.label = lab LEFT JOIN tw ON {_ON("tw", "j")} AND tw.label = lab),
cw AS (SELECT movie_id, shot_id, arg_min(reason, nth) FILTER (reason IS NOT NULL) AS wrong, list(lab ORDER BY nth) AS labs FROM ck GROUP BY ALL),
ce AS (SELECT cd.*, labs, CASE WHEN targets IS NULL THEN NULL WHEN NOT looked OR len(targets) = 0 OR len(list_distinct(targets)) <> len(targets) THEN 'invalid_target_person_ids' WHEN wrong IS NOT NULL THEN wrong WHEN len(list_distinct(labs)) <> len(labs) THEN 'ambiguous_local_target' END AS error FROM cd LEFT JOIN cw ON {_ON("cw", "cd")}),
cf AS MATERIALIZED (SELECT *, subject IN ('woman', 'man', 'multiple_people') AS person, subject IN ('woman', 'man') AND coalesce(len(targets), 0) = 1 AND need <> 'simultaneous' AND NOT sec AS one, subject IN ('woman', 'man', 'multiple_people') AND coalesce(len(targets), 0) >= 2 AS several,
  need = 'simultaneous' OR subject = 'multiple_people' OR sec AS preserve FROM ce),
c1 AS MATERIALIZED (SELECT r.movie_id, r.shot_id, r.sample, r.t, r.x, r.y, r.w, r.h, count(*) OVER (PARTITION BY r.movie_id, r.shot_id) = 5 AS whole_ FROM cf JOIN wr r ON {_ON("r", "cf")} AND r.target = labs[1] WHERE error IS NULL AND one),
cg AS MATERIALIZED (SELECT r.* FROM cf JOIN wr r ON {_ON("r", "cf")} AND list_contains(labs, r.target) WHERE error IS NULL AND several),
cm AS (SELECT movie_id, shot_id, t, count(*) AS n, min(sample) AS sample, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM cg GROUP BY movie_id, shot_id, t),
cc AS (SELECT DISTINCT a.movie_id, a.shot_id FROM cg a JOIN cg b ON {_ON("a", "b", "t")} AND a.target < b.target WHERE {_IOU("a", "b")} >= 0.95),
cs AS (SELECT m.movie_id, m.shot_id FROM cm m LEFT JOIN cc ON {_ON("cc", "m")} WHERE cc.movie_id IS NULL GROUP BY ALL HAVING sum(n) = 10 AND min(n) = 2 AND max(n) = 2),
ca AS MATERIALIZED (SELECT movie_id, shot_id, sample, person, x, y, w, h, confidence, person = 2 AND k % 5 = 1 AS fg, false AS face FROM tb_b WHERE k % 19 <> 7
  UNION ALL SELECT movie_id, shot_id, sample, 11, x + w * 0.3::DOUBLE, y, w * 0.4::DOUBLE, h * 0.2::DOUBLE, 0.7::DOUBLE, false, true FROM tb_b WHERE k % 19 <> 7 AND k % 7 = 2 AND person = 1 AND sample <= 2),
cb AS (SELECT *, bool_and(fg) OVER (PARTITION BY movie_id, shot_id, sample) AS allfg FROM ca),
cv AS (SELECT *, bool_or(face) OVER (PARTITION BY movie_id, shot_id, sample) AS anyface FROM cb WHERE allfg OR NOT fg),
cl AS MATERIALIZED (SELECT movie_id, shot_id, sample, list({{'x': x, 'y': y, 'w': w, 'h': h, 'c': confidence}} ORDER BY person) AS l FROM cv WHERE face OR NOT anyface GROUP BY ALL),
fr(movie_id, shot_id, sample, last, p) AS (SELECT movie_id, shot_id, -1, NULL::DOUBLE, NULL::STRUCT(x DOUBLE, y DOUBLE, w DOUBLE, h DOUBLE, c DOUBLE) FROM cf WHERE targets IS NULL AND looked
 UNION ALL SELECT movie_id, shot_id, sample, coalesce(p.x + p.w / 2, last), p FROM (SELECT fr.movie_id, fr.shot_id, fr.sample + 1 AS sample, last, CASE WHEN l IS NULL THEN NULL
   WHEN last IS NOT NULL THEN list_sort(list_transform(l, lambda b, i: {{'d': abs(b.x + b.w / 2 - last), 'i': i, 'b': b}}))[1].b WHEN len(l) = 1 THEN l[1]
   WHEN side IS NOT NULL THEN list_sort(list_transform(l, lambda b, i: {{'d': abs(b.x + b.w / 2 - side) / 1920, 'c': -b.c, 'i': i, 'b': b}}))[1].b END AS p
  FROM fr JOIN cf ON {_ON("cf", "fr")} LEFT JOIN cl ON {_ON("cl", "fr")} AND cl.sample = fr.sample + 1 WHERE fr.sample < 4)),
ct AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY movie_id, shot_id ORDER BY sample) AS o FROM (SELECT movie_id, shot_id, sample, t::DOUBLE AS t, x, y, w, h FROM c1
  UNION ALL SELECT m.movie_id, m.shot_id, m.sample, m.t::DOUBLE, m.x, m.y, m.w, m.h FROM cm m JOIN cs ON {_ON("cs", "m")}
  UNION ALL SELECT fr.movie_id, fr.shot_id, sample, CASE WHEN k = 77 AND sample = 3 THEN 2 ELSE sample END::DOUBLE, p.x, p.y, p.w, p.h FROM fr JOIN cf ON {_ON("cf", "fr")} WHERE p IS NOT NULL)),
fo AS MATERIALIZED (SELECT f.*, coalesce((one AND error IS NULL AND c.movie_id IS NOT NULL) OR (several AND cs.movie_id IS NOT NULL), false) AS resolved FROM cf f LEFT JOIN (SELECT DISTINCT movie_id, shot_id FROM c1 WHERE whole_) c ON {_ON("c", "f")} LEFT JOIN cs ON {_ON("cs", "f")}),
hp AS MATERIALIZED (SELECT ct.* FROM ct JOIN fo ON {_ON("fo", "ct")} WHERE one AND resolved AND prime),
hf AS (SELECT movie_id, shot_id, sample, person, x + w * 0.3::DOUBLE AS x, y + h * 0.05::DOUBLE AS y, w * CASE WHEN k % 6 = 1 THEN 1.2::DOUBLE ELSE 0.4::DOUBLE END AS w, h * 0.25::DOUBLE AS h FROM tb_b WHERE (k + sample + person) % 4 <> 1),
hm AS (SELECT p.movie_id, p.shot_id, p.sample, p.x AS px, p.w AS pw, f.person, f.x, f.y, f.w, f.h, {_OVER("f", "p")} / greatest(1, f.w * f.h) AS own FROM hp p JOIN hf f ON {_ON("f", "p", "sample")}
  WHERE f.x + f.w / 2 BETWEEN p.x AND p.x + p.w AND f.y + f.h / 2 BETWEEN p.y AND p.y + p.h * 0.8::DOUBLE AND f.w <= p.w * 1.1::DOUBLE),
hr AS (SELECT f.movie_id, f.shot_id, f.sample, f.person, f.own, f.x, f.y, f.w, f.h, max({_OVER("f", "b")} / greatest(1, f.w * f.h)) FILTER (abs(b.x - f.px) + abs(b.w - f.pw) > 2) AS rival FROM hm f JOIN tb b ON {_ON("b", "f", "sample")} WHERE own >= 0.8 GROUP BY ALL),
hb AS (SELECT movie_id, shot_id, sample, any_value(x) AS x, any_value(y) AS y, any_value(w) AS w, any_value(h) AS h FROM hr WHERE coalesce(own - rival >= 0.15, true) GROUP BY ALL HAVING count(*) = 1),
hg AS (SELECT p.movie_id, p.shot_id, p.sample, coalesce(b.x, p.x) AS x, coalesce(b.w, p.w) AS w, greatest(coalesce(b.w, p.w) * 0.12::DOUBLE, 8) AS m FROM hp p LEFT JOIN hb b ON {_ON("b", "p", "sample")}),
hl AS (SELECT *, greatest(0, x + w + m - 360) AS lo, least(1560, x - m) AS hi, greatest(0, x + w + m - 360) <= least(1560, x - m) AND NOT (x <= 1 OR x + w >= 1919 OR x + w + m - 360 > x - m) AS fits FROM hg),
ar AS MATERIALIZED (SELECT ct.movie_id, ct.shot_id, o, t, greatest(0, least(1560, {wish})) AS x, CASE WHEN fits THEN lo WHEN NOT fits THEN 0 END::DOUBLE AS lo, CASE WHEN fits THEN hi WHEN NOT fits THEN 1560 END::DOUBLE AS hi, fits FROM ct LEFT JOIN hl g ON {_ON("g", "ct", "sample")}),
ap AS (SELECT *, greatest(lo, least(hi, x)) AS p FROM ar),
ag AS MATERIALIZED (SELECT movie_id, shot_id, max(p) - min(p) < 360 * 0.06::DOUBLE AND coalesce(max(lo) <= min(hi), true) AS still, max(lo) AS cl, min(hi) AS ch, median(p) AS med, max(o) AS n, bool_and(fits) AS safe FROM ap GROUP BY ALL),
am(movie_id, shot_id, o, t, x, lo, hi) AS (SELECT p.movie_id, p.shot_id, o, t, p, lo, hi FROM ap p WHERE o = 1
 UNION ALL SELECT a.movie_id, a.shot_id, a.o, a.t, greatest(a.lo, least(a.hi, greatest(m.x - 0.08::DOUBLE * 360 * greatest(0, a.t - m.t), least(m.x + 0.08::DOUBLE * 360 * greatest(0, a.t - m.t), CASE WHEN abs(a.p - m.x) < 360 * 0.06::DOUBLE THEN m.x ELSE a.p END)))), a.lo, a.hi
 FROM am m JOIN ap a ON {_ON("a", "m")} AND a.o = m.o + 1),
an AS (SELECT m.*, g.n, f.en FROM am m JOIN ag g ON {_ON("g", "m")} AND NOT still JOIN fo f ON {_ON("f", "m")}),
ay AS (SELECT movie_id, shot_id, -1 AS o, -0.5::DOUBLE AS t, greatest(cl, least(ch, med)) AS x FROM ag WHERE still UNION ALL SELECT movie_id, shot_id, 0, -0.5, x FROM an WHERE o = 1 UNION ALL SELECT movie_id, shot_id, o, t, x FROM an WHERE o > 1 OR lo IS NOT NULL
  UNION ALL SELECT movie_id, shot_id, 9, en, greatest(lo, least(hi, x)) FROM an WHERE o = n AND en > t),
az AS (SELECT movie_id, shot_id, list([round(t, 4), round(x + 1e-7, 3)] ORDER BY o) AS anchors, median(x) AS mx FROM ay GROUP BY ALL),
pf AS (SELECT movie_id, shot_id, min(x) AS x, max(x + w) - min(x) AS w FROM ct GROUP BY ALL), pa AS (SELECT movie_id, shot_id, min(x) AS x, max(x + w) - min(x) AS w FROM ca GROUP BY ALL),
pq AS (SELECT f.*, pf.x AS fx, CASE WHEN {everybody} AND pa.x IS NOT NULL AND NOT several THEN pa.x ELSE pf.x END AS qx, CASE WHEN {everybody} AND pa.x IS NOT NULL AND NOT several THEN pa.w ELSE pf.w END AS qw FROM fo f LEFT JOIN pf ON {_ON("pf", "f")} LEFT JOIN pa ON {_ON("pa", "f")}),
pr AS (SELECT *, CASE WHEN act THEN least(qx, 700) ELSE qx END AS rx, CASE WHEN act THEN greatest(qx + qw, 900) - least(qx, 700) ELSE qw END AS rw FROM pq),
ph AS (SELECT *, rx IS NOT NULL AND rw <= 302.4::DOUBLE AS fits FROM pr),
po AS (SELECT *, CASE WHEN fits AND (preserve OR act OR fx IS NULL) THEN 'composition' WHEN fx IS NOT NULL THEN 'track' ELSE 'fallback' END AS how, NOT fits AND rx IS NOT NULL AND (preserve OR act) AS impossible, [0, 780, 1560][k % 3 + 1]::DOUBLE AS spot FROM ph),
pz AS (SELECT po.*, CASE how WHEN 'track' THEN z.mx WHEN 'composition' THEN greatest(0, least(1560, rx + rw / 2 - 180)) ELSE spot END AS mx, z.anchors AS zs, prime AND one AND CASE WHEN resolved THEN NOT g.safe ELSE looked END AS face_review FROM po LEFT JOIN az z ON {_ON("z", "po")} LEFT JOIN ag g ON {_ON("g", "po")})
SELECT movie_id, shot_id, CASE WHEN one THEN 'semantic_bound_geometry' WHEN several THEN 'semantic_bound_multi_geometry' ELSE 'bounded_linear' END AS mode, CASE WHEN person AND targets IS NOT NULL THEN resolved END AS bound, how, round(rx + 1e-7, 3) AS required_x, round(rw + 1e-7, 3) AS required_w,
 CASE WHEN how = 'track' THEN zs ELSE [[-0.5::DOUBLE, round(mx + 1e-7, 3)]] END AS anchors, round(mx + 1e-7, 3) AS x, impossible, face_review, impossible OR (person AND fx IS NULL) OR (person AND targets IS NOT NULL AND NOT resolved) OR face_review OR NOT directed AS review,
 CASE WHEN targets IS NOT NULL THEN coalesce(error, CASE WHEN NOT one AND NOT several THEN 'insufficient_required_participants' END) END AS refused FROM pz"""


def _plan(spark: SparkSession, d: str, strategy: str) -> DataFrame:
    r = lambda c: F.round(F.col(c) + 1e-7, 3)
    x = crops.crop_plans(**_inputs(spark, d), width=WIDTH, height=HEIGHT, strategy=strategy)
    tracked = ("invalid_target_person_ids", "malformed_person_identity", "cross_shot_person_identity", "missing_local_target", "ambiguous_reference_geometry", "ambiguous_local_target", "insufficient_required_participants")
    anchors = F.transform("anchors", lambda a: F.array(F.round(a["t"], 4), F.round(a["x"] + 1e-7, 3)))
    return x.select(
        "movie_id", "shot_id", "mode", "bound", "how", r("required.x").alias("required_x"), r("required.w").alias("required_w"), anchors.alias("anchors"), r("x").alias("x"), "impossible", "face_review", "review", F.when(F.col("reason").isin(*tracked), F.col("reason")).alias("refused"),
    )


@query(_sql("ct.x + ct.w / 2 - 180", "preserve"))
def b14_crop_plans(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d, "subject_focus")


@query(_sql("coalesce(g.x + g.w / 2, ct.x + ct.w / 2) - 180", "preserve"))
def b14_crop_plans_by_face(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d, "face_priority")


@query(_sql("ct.x + ct.w / 2 - 180", "true"))
def b14_crop_plans_of_interaction(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d, "interaction_aware")
