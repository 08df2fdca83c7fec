"""From documents to packed sequences: language, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is written
as Parquet and read again before the next.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import jaccard_join, langid, packing, secret_scan
from civicspark.llm.queries import vocabulary, word_pattern
from civicspark.llm.support import join_small, pinned, table

#: A document whose best language is less certain than this is rejected, as is one without letters.
LEAST_CERTAIN = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the network knows (operator 8, trained on the labelled rows)."""
    docs = docs.select(*COLUMNS)
    told = langid.predict(docs, langid.train(docs))
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_CERTAIN)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id (operator 3).

    Of several rows of one id one stays; rows without an id stay.
    """
    docs = docs.select(*COLUMNS)
    grouped = pinned(jaccard_join.join(docs), "duplicate-groups")
    gone = grouped.where("doc_id <> component_id").select("doc_id").distinct()
    kept = join_small(docs, gone, ["doc_id"], "left_anti", gone.count(), jaccard_join.COPIED)
    repeated = grouped.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    n = repeated.count()
    if not n:
        return kept
    once = join_small(kept, repeated, ["doc_id"], "left_semi", n, jaccard_join.COPIED).groupBy("doc_id").agg(
        F.min(F.struct("text", "lang", "source", "n_chars")).alias("d")).select("doc_id", "d.*")
    return join_small(kept, repeated, ["doc_id"], "left_anti", n, jaccard_join.COPIED).unionByName(once)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by its kind in brackets (operator 4)."""
    docs = docs.select(*COLUMNS)
    found = secret_scan.scan(docs, secret_scan.train(docs))
    masked = found.withColumn("text", secret_scan.masked(F.col("text"), F.col("secrets")))
    return masked.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the curve (operator 9)."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"), word_pattern(), "<|endoftext|>", 50256).drop("ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
