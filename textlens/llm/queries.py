"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm import (contain, filter_audit, hardneg, licenses, mixing, nbsvm, partjoin, pii, shards, subspace,
                          superkmer, topk, url_lm)
from textlens.llm.common import table
from textlens.session import apply_defaults

#: A document is rejected below this score.
QUALITY_BAR = 0.3


def _held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def quality_model(docs: DataFrame, labels: DataFrame) -> nbsvm.Model:
    """Fitted on labelled rows that are not held out."""
    return nbsvm.fit(docs.filter(~_held_out()), labels)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("p", 6).alias("p"), "kept")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return url_lm.judge(table(spark, sf_dir, "pages"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return subspace.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return shards.place(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return superkmer.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return partjoin.components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return nbsvm.score(docs, model).select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score",
                                           (F.col("score") >= QUALITY_BAR).cast("int").alias("predicted"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return contain.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_item", "n_common", F.round("containment", 6).alias("containment"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return topk.search(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", label))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_url_filter, op3_embedding_near_dedup, op4_sharding, op5_pii,
                                   op6_substring_dedup, op7_ngram_jaccard, op8_quality, op9_decontamination,
                                   op10_license_scan, op11_topk_search, op12_hard_negatives, op13_filter_audit)}
