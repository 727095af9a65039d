"""I1-I3 + S11/S12: a failed document keeps its batch pending; a re-run after
the fix delivers everything once and marks the batch processed."""

import json
import os

from pyspark.sql import functions as F

from textlens.operators.ingest import IngestStore, ingest
from textlens.sources.sinks import upsert


def scorer(rows):
    return rows.select("_rid", F.lit("Positive").alias("label"), F.lit(0.9).alias("confidence"))


def env(spark, bad: bool):
    docs = []
    for i in range(3):
        post = {"id": f"p{i}", "desc": f"text {i}", "createTime": 1700000000 + i}
        if bad and i == 1:
            post.pop("createTime")
        docs.append(("tiktok", "tiktok-1", "pending", "2024-01-01T00:00:00Z", json.dumps({"post": post})))
    return spark.createDataFrame(docs, "platform string, batch_id string, status string, "
                                       "extracted_at string, raw_payload string")


def test_retry_after_failure(spark, tmp_folder):
    store = IngestStore(spark, tmp_folder)
    r1 = ingest(env(spark, bad=True), scorer, store)
    assert (r1["docs"], r1["failed"]) == (3, 1)
    assert store.posts.current().count() == 2
    assert store.ledger.current().first().status == "pending"
    r2 = ingest(env(spark, bad=False), scorer, store)
    assert (r2["docs"], r2["failed"]) == (3, 0)
    posts = store.posts.current()
    assert posts.count() == 3 and posts.select("post.platform_post_id").distinct().count() == 3
    assert store.ledger.current().first().status == "processed"
    r3 = ingest(env(spark, bad=False), scorer, store)           # nothing pending any more
    assert r3["docs"] == 0 and store.posts.current().count() == 3


def test_upsert_latest_wins(spark):
    cur = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], "k string, v long, s string")
    new = spark.createDataFrame([("a", 2, "new"), ("a", 2, "new")], "k string, v long, s string")
    out = {r.k: r.s for r in upsert(cur, new, ["k"], [F.col("v")]).collect()}
    assert out == {"a": "new", "b": "keep"}


def test_a_part_begun_under_a_token_is_completed(spark, tmp_folder):
    from textlens.sources.sinks import AppendTable
    t = AppendTable(spark, tmp_folder)
    t.append(spark.range(4).toDF("id"), 1, "q-0")
    os.remove(os.path.join(tmp_folder, "part=1-q-0", "_SUCCESS"))
    assert t.rows() is None and t.part_of("q-0") == 1 and t.part_of("q-1") is None and t.last() == 1
    t.append(spark.range(3).toDF("id"), 1, "q-0")
    t.append(spark.range(9).toDF("id"), 1, "q-0")            # whole already
    t.append(spark.range(2).toDF("id"), 2, "q-1")
    assert t.parts() == [1, 2] and t.rows().count() == 5


def test_latest_version_is_found_on_narrow_rows(spark, tmp_folder):
    from textlens.sources.sinks import latest_per_key
    rows = [(f"k{i % 5}", i // 2, "wide " * 50 + str(i)) for i in range(40)] + [(None, 1, "n1"), (None, 2, "n2")]
    spark.createDataFrame(rows, "k string, v long, `_at` string").repartition(4).write.parquet(tmp_folder + "/t")
    out = latest_per_key(spark.read.parquet(tmp_folder + "/t"), ["k"], [F.col("v")])
    want = {}
    for k, v, s in rows:
        want[k] = max(want.get(k, -1), v)
    assert {r.k: r.v for r in out.select("k", "v").collect()} == want and out.count() == 6


def test_only_the_target_collection_is_ingested(spark, tmp_folder):
    from textlens.operators.ingest import batch_targets
    docs = frame(spark, [envelope(0), envelope(1, batch="tiktok-2"), envelope(2, batch="tiktok-2"), envelope(3, batch="tiktok-3")])
    docs = docs.withColumn("collection", F.when(F.col("batch_id") == "tiktok-2", "profiles")
                           .when(F.col("batch_id") == "tiktok-1", "posts_with_comments"))
    assert [tuple(r) for r in batch_targets(docs).collect()] == [("tiktok", 3, 1, 2)]
    store = IngestStore(spark, tmp_folder)
    assert ingest(docs, scorer, store)["docs"] == 1 and state(store) == {("tiktok-1", 1, 0, "processed")}


def envelope(i, batch="tiktok-1", **post):
    body = {"id": f"p{i}", "desc": f"text {i}", "createTime": 1700000000 + i, **post}
    body = {k: v for k, v in body.items() if v is not None}
    return ("tiktok", batch, "pending", "2024-01-01T00:00:00Z", json.dumps({"post": body}))


def frame(spark, docs):
    return spark.createDataFrame(docs, "platform string, batch_id string, status string, "
                                       "extracted_at string, raw_payload string")


def state(store):
    return {(r.batch_id, r.n_docs, r.n_failed, r.status) for r in store.ledger.current().collect()}


def test_late_document_reopens_its_batch(spark, tmp_folder):
    store = IngestStore(spark, tmp_folder)
    first = [envelope(0), envelope(1)]
    ingest(frame(spark, first), scorer, store)
    assert state(store) == {("tiktok-1", 2, 0, "processed")}
    assert ingest(frame(spark, first + [envelope(2)]), scorer, store)["docs"] == 3
    assert state(store) == {("tiktok-1", 3, 0, "processed")}
    assert store.posts.current().count() == 3


def test_increments_fix_failures_and_survive_replays(spark, tmp_folder):
    store = IngestStore(spark, tmp_folder)

    def step(*docs):
        ingest(frame(spark, docs), scorer, store, incremental=True)
        return state(store)
    assert step(envelope(0), envelope(1, createTime=None)) == {("tiktok-1", 2, 1, "pending")}
    assert step(envelope(0), envelope(1, createTime=None)) == {("tiktok-1", 2, 1, "pending")}    # replayed
    assert store.quarantine.current().count() == 1 and store.posts.current().count() == 1
    assert step(envelope(1)) == {("tiktok-1", 2, 0, "processed")}
    assert step(envelope(3, batch="tiktok-2")) == {("tiktok-1", 2, 0, "processed"), ("tiktok-2", 1, 0, "processed")}
    assert store.posts.current().count() == 3


def test_an_unfinished_part_is_not_read(spark, tmp_folder):
    from textlens.sources.sinks import AppendTable
    t = AppendTable(spark, tmp_folder)
    assert t.current() is None and t.append(spark.range(3).toDF("id")) == 1
    os.makedirs(os.path.join(tmp_folder, "part=2"))
    assert t.parts() == [1] and t.append(spark.range(2).toDF("id")) == 3 and t.current().count() == 5
