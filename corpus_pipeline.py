"""A corpus from documents to token files in five stages, each over all that the stage before it kept.

Every stage but the last returns the columns it was given, whatever their names (names that a stage uses for itself included). Rows with null or empty texts are clean, alone in
their group and free of benchmark items; as they have no words, the mixture takes none of them. Rows that share a doc_id
go or stay together, except that copies of one row are each counted in the mixture. Ties are broken by the least doc_id
(groups) or by hash, size and text (mixture). Long texts are read whole. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cutlight.llm import jaccard_join, mixing, queries, tiling, token_store, toxicity
from cutlight.llm.scratch import materialise


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels, calls toxic go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id stays."""
    return jaccard_join.one_of_each_group(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source up to its target, a row for each copy taken."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids, and from them a row for each document: doc_id, start, n_tokens, ids_crc32."""
    return token_store.tokenize(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", without_benchmarks),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", tokens),
]
#: Similarity joins, tiling and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again before the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{i}")
    return docs
