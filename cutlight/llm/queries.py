"""The queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutlight.llm import chat, collocations, exact_dedup, html_wrapper, jaccard_join, mixing, packing, resampling, secret_scan, tiling, token_store, toxicity, url_filter
from cutlight.llm.scratch import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(_table(spark, sf_dir, "pages"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.tokenize(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents")))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    return chat.summary(materialise(chat.formatted(chat.expand(rows.unionByName(more))), "chat"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_source_mixing, op3_exact_dedup, op4_url_filters, op5_benchmark_decontamination,
        op6_token_output, op7_secret_scans, op8_ngram_jaccard_join, op9_chat_formatting, op10_toxicity,
        op11_phrase_collocations, op12_importance_resampling, op13_sequence_packing,
    )
}
SQL: dict[str, str] = {
    "op2_source_mixing": mixing.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op4_url_filters": url_filter.ORACLE,
    "op9_chat_formatting": chat.ORACLE,
    "op11_phrase_collocations": collocations.ORACLE,
    "op12_importance_resampling": resampling.ORACLE,
}
