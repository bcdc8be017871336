"""Queries over asset packages and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight import fixtures as fx
from cutlight.fixtures import with_
from cutlight.operators import narrative as nv
from cutlight.operators import publish as pb
from cutlight.registry import query

_PACK = """, want AS (SELECT movie_id, asset, m FROM ass, unnest(['horizontal.mp4', 'metadata.json', 'thumbnail.jpg', 'vertical.mp4', 'validation.json']) q(m)),
pk AS (SELECT want.movie_id, want.asset, coalesce(list_sort(list(m) FILTER (sha IS NULL)), []::VARCHAR[]) AS missing, coalesce(list_sort(list(m) FILTER (sha <> recorded_sha)), []::VARCHAR[]) AS mismatched FROM want LEFT JOIN fil ON fil.asset = want.asset AND fil.name = m GROUP BY want.movie_id, want.asset),
rd AS (SELECT pk.movie_id, pk.asset, list_filter([CASE WHEN len(missing) > 0 THEN 'incomplete' END, CASE WHEN len(mismatched) > 0 THEN 'hash_mismatch' END, CASE WHEN NOT (vertical = 'PASS' OR review = 'APPROVED') AND review = 'PENDING' THEN 'review_pending' END, CASE WHEN NOT (vertical = 'PASS' OR review = 'APPROVED') AND review <> 'PENDING' THEN 'vertical_not_passed' END], lambda x: x IS NOT NULL) AS reasons FROM pk JOIN ass ON ass.asset = pk.asset)
"""


def _with_packages(body: str) -> str:
    return with_("SELECT", "ass", "fil").removesuffix("\nSELECT") + _PACK + body


def _packages(spark: SparkSession, d: str) -> DataFrame:
    return pb.completeness(fx.assets(spark, d), fx.asset_files(spark, d), list(fx.MEMBERS))


def _ready(spark: SparkSession, d: str) -> DataFrame:
    return pb.readiness(fx.assets(spark, d), _packages(spark, d))


@query(_with_packages("SELECT movie_id, asset, missing, mismatched, len(missing) = 0 AS complete FROM pk"))
def l06_package_completeness(spark: SparkSession, d: str) -> DataFrame:
    return _packages(spark, d)


@query(_with_packages("SELECT movie_id, asset, len(reasons) = 0 AS ready, reasons FROM rd"))
def l02_publication_readiness(spark: SparkSession, d: str) -> DataFrame:
    return _ready(spark, d)


@query(_with_packages("SELECT *, CASE WHEN incomplete + mismatched + unresolved = 0 THEN 'HANDOFF_COMPLETE' ELSE 'BLOCKED' END AS verdict FROM (SELECT movie_id, count(*) AS assets, count(*) FILTER (len(reasons) = 0) AS approved, count(*) FILTER (list_contains(reasons, 'incomplete')) AS incomplete, count(*) FILTER (list_contains(reasons, 'hash_mismatch')) AS mismatched, count(*) FILTER (list_contains(reasons, 'review_pending')) AS unresolved FROM rd GROUP BY movie_id)"))
def l05_closing_manifest(spark: SparkSession, d: str) -> DataFrame:
    return pb.closing_manifest(_ready(spark, d))


@query(_with_packages("SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM rd) GROUP BY reason"))
def a19_reason_frequency(spark: SparkSession, d: str) -> DataFrame:
    return pb.reason_frequency(_ready(spark, d))


@query(with_("SELECT movie_id, count(*) FILTER (vertical = 'PASS' OR review = 'APPROVED') AS promoted, count(*) FILTER (vertical <> 'PASS' AND review = 'PENDING') AS pending, count(*) FILTER (vertical <> 'PASS' AND review NOT IN ('APPROVED', 'PENDING')) AS insufficient FROM ass GROUP BY movie_id", "ass"))
def l04_review_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    return pb.review_counts(fx.assets(spark, d))


@query(with_("SELECT asset, name, CASE WHEN b IS NULL THEN 'MISSING' WHEN a IS NULL THEN 'ORPHAN' WHEN a = b THEN 'IDENTICAL' ELSE 'DIFFERENT' END AS state FROM (SELECT asset, name, sha AS a FROM fil WHERE asset % 7 <> 0) FULL JOIN (SELECT asset, name, recorded_sha AS b FROM fil WHERE asset % 8 <> 0) USING (asset, name)", "fil"))
def s08_inventory_comparison(spark: SparkSession, d: str) -> DataFrame:
    f = fx.asset_files(spark, d)
    return pb.inventory_comparison(f.where("asset % 7 <> 0").select("asset", "name", "sha"), f.where("asset % 8 <> 0").select("asset", "name", F.col("recorded_sha").alias("sha")), ["asset", "name"])


@query(with_("SELECT movie_id, asset, printf('M%02d_%03d', movie_id, asset) AS asset_id, count(*) OVER (PARTITION BY movie_id, name) > 1 AS collides FROM ass", "ass"))
def l01_asset_identity(spark: SparkSession, d: str) -> DataFrame:
    return pb.identities(fx.assets(spark, d)).select("movie_id", "asset", "asset_id", "collides")


from cutlight.plans.narrative import _chunk_sql  # noqa: E402


@query(_chunk_sql("SELECT movie_id, chunk, CASE WHEN r THEN CASE WHEN NOT i THEN 'ORPHAN' ELSE 'IDENTICAL' END ELSE 'MISSING' END AS state FROM (SELECT DISTINCT movie_id, chunk, true AS i, (movie_id + chunk) % 9 <> 0 AS r FROM chk UNION ALL SELECT DISTINCT movie_id, 99, false, true FROM chk WHERE movie_id % 25 = 0)"))
def s07_chunk_correspondence(spark: SparkSession, d: str) -> DataFrame:
    chunks = nv.chunk_cues(fx.cues(spark, d), 60.0, 10.0).select("movie_id", "chunk", F.lit("").alias("sha")).distinct()
    orphan = chunks.where("movie_id % 25 = 0").select("movie_id", F.lit(99).cast("bigint").alias("chunk"), "sha").distinct()
    return pb.inventory_comparison(chunks, chunks.where("(movie_id + chunk) % 9 <> 0").union(orphan), ["movie_id", "chunk"])
