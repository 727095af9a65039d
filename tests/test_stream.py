"""The Structured Streaming form delivers the same posts as the batch run."""

import os

import pytest
from pyspark.sql import functions as F

from textlens.operators.ingest import IngestStore, ingest
from textlens.session import scratch_path
from textlens.sources import tables as T
from textlens.streaming.ingest_stream import start_ingest_stream

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def scorer(rows):
    return rows.select("_rid", F.when(F.length("_text") % 2 == 0, "Positive").otherwise("Negative")
                       .alias("label"), (F.length("_text") % 7 / 10.0 + 0.3).alias("confidence"))


def snapshot(store):
    return sorted((r.platform, r.post.platform_post_id, r.post.sentiment, r.post.sentiment_score,
                   tuple(c.sentiment for c in r.post.comments))
                  for r in store.posts.current().collect())


def test_stream_equals_batch(spark):
    env = T.envelopes(spark, SF)
    batch = IngestStore(spark, scratch_path(spark, "batch"))
    ingest(env, scorer, batch)
    src = scratch_path(spark, "env")
    env.repartitionByRange(3, "conv_id").write.parquet(src)
    stream = IngestStore(spark, scratch_path(spark, "stream"))
    q = start_ingest_stream(spark, src, env.schema, scorer, stream, scratch_path(spark, "ck"),
                            max_files_per_trigger=1)
    q.awaitTermination()
    assert snapshot(stream) == snapshot(batch)
    ledger = {(r.platform, r.batch_id): (r.n_docs, r.status) for r in stream.ledger.current().collect()}
    want = {(r.platform, r.batch_id): (r.n_docs, r.status) for r in batch.ledger.current().collect()}
    assert ledger == want


def test_a_replayed_micro_batch_adds_no_part(spark, monkeypatch):
    """The run dies between posts and documents; the replay of the epoch completes its parts."""
    env = T.envelopes(spark, SF)
    src, progress = scratch_path(spark, "env"), scratch_path(spark, "ck")
    env.repartitionByRange(3, "conv_id").write.parquet(src)
    store = IngestStore(spark, scratch_path(spark, "stream"))

    def run():
        start_ingest_stream(spark, src, env.schema, scorer, store, progress, max_files_per_trigger=1).awaitTermination()

    def stop(*args):
        raise RuntimeError("lost between posts and documents")
    with monkeypatch.context() as m:
        m.setattr("textlens.operators.ingest.ext.failures", stop)
        with pytest.raises(Exception, match="lost between"):
            run()
    assert store.posts.parts() == [1] and store.documents.parts() == []
    first = store.posts.rows().inputFiles()
    run()
    assert store.posts.parts() == store.quarantine.parts() == store.documents.parts() == [1, 2, 3]
    assert set(first) <= set(store.posts.rows().inputFiles())
    whole = IngestStore(spark, scratch_path(spark, "batch"))
    ingest(env, scorer, whole)
    assert snapshot(store) == snapshot(whole)
    assert store.posts.rows().count() == whole.posts.rows().count()
