"""Exact duplicates by a persistent digest index, bucketed and sorted by digest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight.llm.scratch import materialise, new_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text_col: str = "text"):
    """SHA-256, in hex, of the text with A-Z lower-cased; a null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.sha2(F.translate(text, _UPPER, _LOWER).cast("binary"), 256)


class DigestIndex:
    """digest, keep_id, group_size, first: a table of Parquet files bucketed and sorted by digest under one path.

    The row of a digest that is first names what stays; later batches that bring copies of it add rows with their number. Looking up new digests is a
    sort-merge anti-join in which only the new side moves: the index has the join's partitioning on disk. A batch is appended by one
    write. The path may be opened again later, by another session, with the same number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets, self.table = spark, path, buckets, f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT, group_size BIGINT, first BOOLEAN) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def kept(self) -> DataFrame:
        """digest, keep_id, group_size over all batches: one row per digest."""
        return self.read().groupBy("digest").agg(F.max(F.when(F.col("first"), F.col("keep_id"))).alias("keep_id"), F.sum("group_size").alias("group_size"))

    def new_only(self, groups: DataFrame) -> DataFrame:
        """Rows of groups (digest, ...) whose digest is not in the index."""
        return groups.join(self.read().where("first").select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """groups: digest, keep_id, group_size, first; one row per digest, first where the index does not have it."""
        ordered = groups.select("digest", "keep_id", "group_size", "first").repartition(self.buckets, "digest")
        ordered.write.mode("append").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def close(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest(text_col).alias("digest"))


def ingest(index: DigestIndex, rows: DataFrame) -> DataFrame:
    """Add rows (doc_id, digest) to the index; the groups (digest, keep_id, group_size) that are new to it.

    keep_id is the largest id of the batch (null if all are null); copies meet in partial aggregates before they move. Copies of what the index already holds
    are dropped, whatever their ids, and counted.
    """
    groups = materialise(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    fresh = materialise(index.new_only(groups), "fresh")
    copies = groups.join(fresh.select("digest"), "digest", "left_anti")
    index.append(fresh.withColumn("first", F.lit(True)).unionByName(copies.withColumn("first", F.lit(False))))
    return fresh


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index_path: str | None = None, buckets: int = 64, batches: int = 2) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    An empty docs gives no rows. Other columns of docs are not read. Very long texts are hashed whole. Of equal texts (A-Z lower-cased, null as empty) in docs the row with the largest doc_id
    stays; rows that repeat that doc_id stay together. A row without doc_id stays only where no equal text has one. docs come to the index in batches of about as many rows each, the largest
    ids first and those without id last: what the anti-join finds in the index is a copy of a row with a larger id. index_path: an index that earlier runs filled; texts it
    holds are copies, keep_id names the row that stayed then, and group_size counts the rows of all runs. Without it the index begins empty in the shared folder.
    """
    spark = docs.sparkSession
    rows = materialise(digests(docs, id_col, text_col), "digests")
    cuts = rows.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0] if batches > 1 else None
    edges = sorted(set(cuts or []), reverse=True)
    parts = [rows.where(F.col("doc_id") > low) if n == 0 else rows.where((F.col("doc_id") > low) & (F.col("doc_id") <= edges[n - 1])) for n, low in enumerate(edges)]
    parts.append(rows.where(F.col("doc_id").isNull() | (F.col("doc_id") <= edges[-1])) if edges else rows)
    index = DigestIndex(spark, index_path or new_path(spark, "digest-index"), buckets)
    try:
        for part in parts:
            ingest(index, part)
        held = materialise(index.kept(), "held")  # both sides of the last join move, so a hot digest can be split
    finally:
        index.close()
    return rows.join(held, "digest").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
"""
