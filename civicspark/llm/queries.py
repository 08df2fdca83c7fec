"""The queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import bpe, chat, extraction, filter_audit, hard_negatives, jaccard_join, langid, packing, pii, recursive_bpe, secret_scan, topk, vector_dedup
from civicspark.llm.support import pinned, table


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.secret_digests(docs, secret_scan.train(docs))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control_case(table(spark, sf_dir, "conversations"))
    return chat.conversation_digests(turns, vocabulary("byte_bpe_50k.json"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    net = langid.train(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), net).drop("text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"), word_pattern(), "<|endoftext|>", 50256).drop("ids")


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint")))
    return hard_negatives.mine(moved, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.documents_by_mask(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(pinned(counts, "filter-masks"))


def op13_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recursive_bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), word_pattern())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_bpe, op3_jaccard_join, op4_secrets, op5_pii, op6_top_k, op7_chat, op8_language, op9_packing, op10_vector_dedup,
                                op11_hard_negatives, op12_filter_audit, op13_recursive_bpe)
}
ORACLES: dict[str, str] = {"op11_hard_negatives": hard_negatives.ORACLE, "op12_filter_audit": filter_audit.ORACLE}
