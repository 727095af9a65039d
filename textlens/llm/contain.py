"""Benchmark decontamination: size-partitioned MinHash containment search (operator 9).

Items and documents are sets of word shingles.  Items are partitioned by
their number n of shingles.  An item's signature is its k smallest shingle
hashes (bottom-k MinHash); k depends on the size partition: a document that
holds at least ``bar`` of n shingles misses at most n - ceil(bar * n) of them, so
with k one more than that it holds some hash of the signature.  Candidates
found by these hashes are therefore all there are; they must also be large
enough, and are then verified on the shingles themselves.

Only DataFrame functions are used.  The signatures are joined with the
documents' shingle hashes; Spark sends them to all tasks where they are small
(by size) and shuffles both sides otherwise.

Items of fewer than ``SHINGLE`` words are one shingle of that length; documents
are then shingled at these few lengths, too, so such an item is found wherever
its words stand together.

Defined results: a text is lower-cased and split at blanks; fewer than
``SHINGLE`` words make one shingle; a null or blank text holds nothing, and
such an item is found nowhere; items with a null id are left out; documents
with a null id are reported with a null id; rows that repeat (id and text)
are reported once; empty tables give an empty result; other columns do not
matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage

SHINGLE = 5


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def _shingles(df: DataFrame, text: str, size: int, *keep: str, short: tuple[int, ...] = ()) -> DataFrame:
    """A row per shingle: its words as columns w0, w1 ... and the text's number of words.

    ``short`` has lengths under ``size``: runs of so many words in longer texts are shingles as well (null words follow).
    """
    df = df.select(*keep, _words(text).alias("w")).filter(F.size("w") > 0)
    none = F.array().cast("array<string>")

    def runs(k: int) -> Column:
        n = F.greatest(F.size("w") - (k - 1), F.lit(1))
        return F.arrays_zip(*((F.slice("w", i + 1, n) if i < k else none).alias(f"w{i}") for i in range(size)))

    every = [runs(size), *(F.when(F.size("w") > k, runs(k)).otherwise(F.slice(runs(size), 1, 0)) for k in short)]
    rows = df.select(*keep, F.size("w").alias("n_words"), F.explode(F.concat(*every) if short else every[0]).alias("s"))
    return rows.select(*keep, "n_words", "s.*")


def _hash(size: int) -> Column:
    return F.xxhash64(*(f"w{i}" for i in range(size)))


def _text(size: int) -> Column:
    return F.concat_ws(" ", *(f"w{i}" for i in range(size)))


def _same_row(a: str, b: str) -> Column:
    """Rows of one text under one id, null ids included."""
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def contained(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", bar: float = 0.75,
              size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, item_id, n_item, n_common, containment) of each document that holds ``bar`` of an item.

    ``text_key`` is xxhash64 of the document's text; with the id it names the row.
    """
    share = math.ceil(bar * 1000)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_key"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).filter("item_id is not null")
    count = F.size(_words("text")).alias("n")
    short = tuple(sorted(r.n for r in items.select(count).filter(f"n between 1 and {size - 1}").distinct().collect()))  # few
    own = (_shingles(items, "text", size, "item_id").select("item_id", _text(size).alias("shingle"), _hash(size).alias("h"))
           .distinct())
    sizes = (own.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
             .withColumn("need", F.ceil(F.col("n_item") * share / 1000)))
    own = own.join(sizes, "item_id")
    by_hash = own.select("item_id", "n_item", "need", "h").distinct()
    ranked = by_hash.selectExpr("*", "row_number() over (partition by item_id order by h) as place")
    signature = ranked.filter("place <= n_item - need + 1").select("h", "item_id", "n_item", "need")
    hashes = _shingles(docs, "text", size, "doc_id", "text_key", short=short).select("doc_id", "text_key", "n_words", _hash(size).alias("h"))
    # a document with fewer shingles than an item needs cannot hold it
    found = (hashes.join(signature, "h").filter(F.greatest(F.col("n_words") - (size - 1), F.lit(1)) >= F.col("need"))
             .select("doc_id", "text_key", "item_id").distinct())
    # read three times: written, so that the documents are searched once and numbers of a known size meet their texts
    found = cut_lineage(found, "found")
    rows = cut_lineage(found.select("doc_id", "text_key").distinct(), "rows")
    texts = docs.alias("d").join(rows.alias("r"), _same_row("d", "r"), "left_semi")
    held = _shingles(texts, "text", size, "doc_id", "text_key", short=short).select("doc_id", "text_key", _text(size).alias("shingle"))
    common = (held.join(own.select("shingle", "item_id", "n_item", "need"), "shingle").distinct()
              .groupBy("doc_id", "text_key", "item_id", "n_item", "need").agg(F.count(F.lit(1)).alias("n_common"))
              .filter("n_common >= need"))
    common = common.alias("c").join(found.alias("f"), _same_row("c", "f") & (F.col("c.item_id") == F.col("f.item_id")), "left_semi")
    return common.select("doc_id", "text_key", "item_id", "n_item", "n_common",
                         (F.col("n_common") / F.col("n_item")).alias("containment"))
