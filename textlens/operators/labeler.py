"""M7: score a post together with all its comments and copy results back.

N2 flattens post + comments into one text list (position 0 = the post).  A
scorer with a column expression scores the list in place (N3 is by position);
any other one runs on the flat rows, and the results are re-nested by position.
The re-nested list is the document's own comment array, so its size is bounded
by the input record, not by a key's popularity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.constants import LABEL_TO_SENTIMENT
from textlens.functions.text import clean_text
from textlens.operators.scoring import Scorer
from textlens.session import cut_lineage

DEFAULT_MODEL_VERSION = "lexicon-v1"


def to_sentiment(label: Column) -> Column:
    """Model label -> lower-case enum (only known labels map)."""
    m = F.create_map(*[x for k, v in LABEL_TO_SENTIMENT.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, label)


def label_posts(posts: DataFrame, scorer: Scorer,
                model_version: str = DEFAULT_MODEL_VERSION) -> DataFrame:
    """Every post row with sentiment, score and model version set on the post
    and on each comment (P9, P10)."""
    texts = F.concat(F.array(F.col("post.content")), F.transform(F.col("post.comments"), lambda c: c["content"]))
    if hasattr(scorer, "columns"):
        cleaned = F.transform(texts, lambda t: clean_text(F.coalesce(t, F.lit(""))))
        scored = F.transform(scorer.columns(cleaned), lambda r: F.struct(to_sentiment(r["label"]).alias("s"), r["confidence"].alias("c")))
        return _with_results(posts.withColumn("_res", scored), model_version).drop("_res")
    # every row is a document of its own, however often a post is delivered; its id is
    # written with it, as it is used on both sides of the join
    keyed = cut_lineage(posts.withColumn("_pk", F.monotonically_increasing_id()), "posts")
    flat = keyed.select(F.posexplode(texts).alias("_pos", "_txt"), "_pk")
    # the row id carries (post, position): results re-nest without a join back
    rows = flat.select(F.struct("_pk", "_pos").alias("_rid"),
                        clean_text(F.coalesce(F.col("_txt"), F.lit(""))).alias("_text"))
    scored = scorer(rows)
    res = (scored.groupBy(F.col("_rid._pk").alias("_pk"))
                 .agg(F.sort_array(F.collect_list(F.struct(
                     F.col("_rid._pos").alias("_pos"), to_sentiment(F.col("label")).alias("s"),
                     F.col("confidence").alias("c")))).alias("_res")))
    return _with_results(keyed.join(res, "_pk", "left"), model_version).drop("_pk", "_res")


def _with_results(out: DataFrame, model_version: str) -> DataFrame:
    """``_res`` (post first, then its comments) copied into the post."""
    first = F.col("_res")[0]
    mv = F.lit(model_version)
    comments = F.transform(F.col("post.comments"), lambda c, i: c.withField(
        "sentiment", F.col("_res")[i + 1]["s"]).withField(
        "sentiment_score", F.col("_res")[i + 1]["c"]).withField("model_version", mv))
    post = (F.col("post").withField("sentiment", first["s"])
                         .withField("sentiment_score", first["c"])
                         .withField("model_version", mv)
                         .withField("comments", comments))
    return out.withColumn("post", post)
