"""From raw documents to training shards: five stages, each one operator.

Every stage but the last returns the columns of its documents, as they are.
Rows with null ids are documents like others; a stage that drops rows drops
them by what its operator finds in that row, never by position or by an id that
another row shares.  Columns of any other name pass through, also where an
operator has one of that name: the input's are set aside meanwhile.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm import contain, mixing, nbsvm, partjoin, shards
from textlens.llm.common import bitmap, cut_lineage, marked, table
from textlens.llm.queries import QUALITY_BAR, quality_model
from textlens.session import apply_defaults

BITMAP_BITS = 1 << 23


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns renamed that are called like one of ``names``, or no plain name, and what selects the columns
    as they were."""
    taken, back = {c.lower() for c in (*docs.columns, *names)}, {}
    for c in docs.columns:
        plain = c.isidentifier()
        new = c if plain else "column"
        while (c.lower() in names or not plain) and new.lower() in taken:
            new += "_"
        taken.add(new.lower())
        back[c] = new
    return (docs.select(*[F.col(_name(c)).alias(new) for c, new in back.items()]),
            [F.col(_name(new)).alias(c) for c, new in back.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Every row is judged by its own text, a null or empty one as a text without
    words; without usable labels all scores are 0.5, so nothing goes.
    """
    apply_defaults(spark)
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    rows, own = _aside(docs, "_quality")
    return nbsvm.score(rows, model, out_col="_quality").filter(F.col("_quality") >= QUALITY_BAR).select(*own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: of its smallest id the text with the smallest hash.

    Rows without words or without an id are in no group and stay.  Rows that
    share an id are told apart by their texts; of rows that share both, one stays.
    """
    apply_defaults(spark)
    groups = cut_lineage(partjoin.components(docs).filter("n_shingles > 0 and doc_id is not null"), "groups")
    texts = groups.groupBy("group_key", "component_id", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    first = texts.filter("doc_id = component_id").groupBy("group_key").agg(F.min("text_key").alias("least"))
    texts = texts.join(first, "group_key").withColumn(
        "goes", (F.col("doc_id") != F.col("component_id")) | (F.col("text_key") != F.col("least")))
    # written, so that what is narrow and of known size meets the documents, and is made once
    texts = cut_lineage(texts.filter("goes or rows > 1").select("doc_id", "text_key", "goes", "rows"), "copies")

    def keys(rows: str) -> DataFrame:
        return texts.filter(rows).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))

    bit = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")), F.lit(BITMAP_BITS))
    bits = bitmap(texts.withColumn("_bit", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(BITMAP_BITS))), "_bit", BITMAP_BITS)
    rows, own = _aside(docs, "_id", "_key")
    # a bitmap of fixed size lets most texts stay where they are; only those that it marks meet the exact keys
    clear = rows.filter(~marked(bits)(bit)).select(*own)
    rows = rows.filter(marked(bits)(bit))
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    left = rows.join(keys("goes"), same, "left_anti")
    again = cut_lineage(keys("not goes and rows > 1"), "again")
    if again.isEmpty():
        return clear.unionByName(left.select(*own))
    one = left.join(again, same, "left_semi").withColumn("_key", F.xxhash64("text")).dropDuplicates(["doc_id", "_key"])
    return clear.unionByName(left.join(again, same, "left_anti").select(*own)).unionByName(one.select(*own))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    A row goes for its own text only, also where others share its id or where
    the id is null; null and blank texts hold nothing.
    """
    apply_defaults(spark)
    hits = contain.contained(docs, table(spark, sf_dir, "benchmark"))
    hits = cut_lineage(hits.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "hits")
    rows, own = _aside(docs, "_id", "_key")
    return rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")),
                     "left_anti").select(*own)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that meets the target weights.

    Id, source, language and text decide; null sources and languages are values
    of their own, and rows that share an id are kept or go by the probability of their cell.
    """
    apply_defaults(spark)
    rows, own = _aside(docs, "topic", "tokens", "p", "kept", "_cell")
    return mixing.mix(rows).filter("kept").select(*own)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left, one row for each of its rows; equal texts share a shard."""
    apply_defaults(spark)
    return shards.place(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("shard", shard)]

#: The classifier's stage is beyond SQL; the tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
