"""Incremental batch ingest I1-I3 with batch discovery S4-S7 and outcomes A14/A15.

All platforms and batches are one DataFrame.  Every run appends the documents
it read, each with its outcome; the ledger is an aggregation of them.  So a
document that arrives after its batch was processed is seen to be new, a fixed
re-delivery replaces the failure of the same document, and a replay (of a run
or of a micro-batch) changes no count.  Order of commits (I3): posts, then
quarantine, then documents; a crash in between re-reads the batch
(at-least-once; the upsert makes the replay harmless).  A run with a ``token``
(a micro-batch) keeps its number and its parts when it is replayed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.constants import PLATFORMS, TARGET_COLLECTION
from textlens.operators import extract as ext
from textlens.operators.labeler import DEFAULT_MODEL_VERSION, label_posts
from textlens.operators.scoring import Scorer
from textlens.session import cut_lineage
from textlens.sources.sinks import AppendTable, latest_per_key

BATCH_KEYS = ("platform", "batch_id")


def in_collection(envelopes: DataFrame, collection: str = TARGET_COLLECTION) -> DataFrame:
    """The documents of the target collection; all, where envelopes name none."""
    return envelopes.filter(F.col("collection") == collection) if "collection" in envelopes.columns else envelopes


def batch_targets(envelopes: DataFrame, platforms: Sequence[str] = PLATFORMS,
                  collection: str = TARGET_COLLECTION) -> DataFrame:
    """A14 per platform: pending batches of any collection, those of the target one, and those skipped for another."""
    batches = (envelopes.filter(F.col("platform").isin(*platforms) & (F.col("status") == "pending"))
                        .groupBy(*BATCH_KEYS).agg(F.bool_or(F.col("collection") == collection).alias("target")))
    return batches.groupBy("platform").agg(
        F.count(F.lit(1)).alias("n_pending"), F.count_if("target").alias("n_target"),
        F.count_if(~F.coalesce("target", F.lit(False))).alias("n_skipped"))


def pending_batches(envelopes: DataFrame, platforms: Sequence[str] = PLATFORMS) -> DataFrame:
    """S4/S5/S6/A15/F10 in one aggregation: batches with at least one pending
    document, with the count of all their documents (whatever their status)."""
    return (envelopes.filter(F.col("platform").isin(*platforms))
                     .groupBy(*BATCH_KEYS)
                     .agg(F.count(F.lit(1)).alias("n_docs"),
                          F.count_if(F.col("status") == "pending").alias("n_pending"))
                     .filter(F.col("n_pending") > 0))


def batch_documents(envelopes: DataFrame, batches: DataFrame) -> DataFrame:
    """Every document of the selected batches (semi join on the batch key)."""
    return envelopes.join(batches.select(*BATCH_KEYS), list(BATCH_KEYS), "left_semi")


def batch_outcomes(extracted: DataFrame) -> DataFrame:
    """Per batch: documents, failures, and the status it moves to."""
    return (extracted.groupBy(*BATCH_KEYS)
                     .agg(F.count(F.lit(1)).alias("n_docs"),
                          F.count_if(F.col("error").isNotNull()).alias("n_failed"))
                     .withColumn("status", F.when(F.col("n_failed") == 0, "processed")
                                 .otherwise("pending")))


def ingest_summary(outcomes: DataFrame, pending: DataFrame) -> DataFrame:
    """A14 per platform: pending batches, batches now processed, docs, failures."""
    o = outcomes.groupBy("platform").agg(
        F.count_if(F.col("status") == "processed").alias("n_processed"),
        F.sum("n_docs").alias("n_docs"), F.sum("n_failed").alias("n_failed"))
    p = pending.groupBy("platform").agg(F.count(F.lit(1)).alias("n_pending_batches"))
    return p.join(o, "platform", "left").select(
        "platform", "n_pending_batches",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("n_processed", "n_docs", "n_failed")])


def ledger_of(documents: DataFrame) -> DataFrame:
    """``platform, batch_id, n_docs, n_failed, status, run`` from the documents read.

    A run that read a whole batch (``whole``) starts its list of documents
    anew; of each document the latest delivery counts, and of copies in one
    delivery the one crawled last (a failure if they tie).
    """
    base = documents.filter("whole").groupBy(*BATCH_KEYS).agg(F.max("run").alias("_base"))
    live = (documents.join(base, list(BATCH_KEYS), "left")
                     .filter(F.col("run") >= F.coalesce("_base", F.lit(0))))
    docs = live.groupBy(*BATCH_KEYS, "doc_key").agg(
        F.max(F.struct("run", "extracted_at", "failed")).alias("_d"))
    return (docs.groupBy(*BATCH_KEYS)
                .agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("_d.failed").alias("n_failed"),
                     F.max("_d.run").alias("run"))
                .select(*BATCH_KEYS, "n_docs", "n_failed",
                        F.when(F.col("n_failed") == 0, "processed").otherwise("pending").alias("status"),
                        "run"))


def post_keys():
    """Upsert key of a post: (platform, platform_post_id)."""
    return (F.col("platform"), F.col("post.platform_post_id"))


def latest_posts(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, post_keys(), [F.col("post.crawled_at"), F.col("delivery")])


def latest_failures(rows: DataFrame) -> DataFrame:
    """A failed document once, however often it was delivered as it is."""
    return latest_per_key(rows, ["platform", "batch_id", "doc_hash"], [F.col("delivery")])


@dataclass
class IngestStore:
    """Posts (latest version of each), quarantine, documents read and the ledger over them."""
    spark: SparkSession
    root: str

    @property
    def posts(self) -> AppendTable:
        return AppendTable(self.spark, f"{self.root}/posts", latest_posts)

    @property
    def quarantine(self) -> AppendTable:
        return AppendTable(self.spark, f"{self.root}/quarantine", latest_failures)

    @property
    def documents(self) -> AppendTable:
        return AppendTable(self.spark, f"{self.root}/documents")

    @property
    def ledger(self) -> AppendTable:
        return AppendTable(self.spark, f"{self.root}/documents", ledger_of)

    def next_run(self, token: str | None = None) -> int:
        """A number above all others; of a replayed delivery the one that it began with."""
        tables = (self.posts, self.quarantine, self.documents)
        begun = [n for n in (t.part_of(token) for t in tables) if n is not None] if token else []
        return begun[0] if begun else max(t.last() for t in tables) + 1


def document_hash(envelopes: DataFrame, doc_id: str | None = None) -> Column:
    """Content identity of one delivered document (its id, crawl time and payload)."""
    payload = F.col("raw_payload")
    if dict(envelopes.dtypes)["raw_payload"] == "variant":
        payload = F.to_json(payload)
    named = [F.col(doc_id).cast("string").alias("i")] if doc_id else []
    return F.sha2(F.to_json(F.struct(*named, F.col("extracted_at").cast("string").alias("t"),
                                     payload.alias("p"))), 256)


def unread_batches(envelopes: DataFrame, documents: DataFrame | None,
                   platforms: Sequence[str] = PLATFORMS, doc_id: str | None = None) -> DataFrame:
    """S4 against the ledger: batches with a pending document that no run has read without failure."""
    pend = envelopes.filter(F.col("platform").isin(*platforms) & (F.col("status") == "pending"))
    if documents is not None:
        # only what was read of the batches at hand is compared: a run shuffles no more of the history than that
        read = (documents.filter(~F.col("failed")).select(*BATCH_KEYS, "doc_hash")
                         .join(pend.select(*BATCH_KEYS).distinct(), list(BATCH_KEYS), "left_semi"))
        pend = (pend.select(*BATCH_KEYS, document_hash(envelopes, doc_id).alias("doc_hash"))
                    .join(read, [*BATCH_KEYS, "doc_hash"], "left_anti"))
    return pend.select(*BATCH_KEYS).distinct()


def ingest(envelopes: DataFrame, scorer: Scorer, store: IngestStore,
           model_version: str = DEFAULT_MODEL_VERSION,
           platforms: Sequence[str] = PLATFORMS, incremental: bool = False,
           doc_id: str | None = None, token: str | None = None) -> dict:
    """Process the batches that hold a pending document not read yet.

    Batch mode reads such a batch whole, so its list of documents starts anew.
    ``incremental`` (the streaming form) processes exactly the pending
    documents of this input and adds them to what the ledger knows.
    ``doc_id`` names the column that identifies a document in its batch;
    without it (or where it is null) that is the post's id, else the content.
    ``token`` names a delivery of the same documents whenever it is replayed;
    its parts are then written once.  Envelopes with a ``collection`` are
    read from the target collection only.
    """
    envelopes = in_collection(envelopes)
    if incremental:
        docs = envelopes.filter(F.col("platform").isin(*platforms)
                                & (F.col("status") == "pending"))
    else:
        docs = batch_documents(envelopes, unread_batches(envelopes, store.documents.rows(),
                                                         platforms, doc_id))
    docs = (docs.withColumn("doc_hash", document_hash(docs, doc_id))
                .withColumn("doc_crawled", F.col("extracted_at").cast("string")))
    extracted = cut_lineage(ext.extract(docs, keep=tuple(
        c for c in docs.columns if c not in ("platform", "batch_id", "raw_payload", "status",
                                             "extracted_at"))))
    run = store.next_run(token)
    delivery = F.lit(run).cast("bigint")

    # S11 first: deliver every valid post (idempotent on replay)
    valid = ext.valid_posts(extracted).drop("doc_hash", "doc_crawled")
    store.posts.append(label_posts(valid, scorer, model_version).withColumn("delivery", delivery), run, token)

    # Failures are kept, not raised
    store.quarantine.append(ext.failures(extracted).withColumn("delivery", delivery), run, token)

    # S12 after the upsert committed
    keys = ([F.col(doc_id).cast("string")] if doc_id else []) + [
        F.col("post.platform_post_id"), F.col("doc_hash")]
    store.documents.append(extracted.select(
        *BATCH_KEYS, F.coalesce(*keys).alias("doc_key"), "doc_hash",
        F.col("doc_crawled").alias("extracted_at"), F.col("error").isNotNull().alias("failed"),
        F.lit(not incremental).alias("whole"), delivery.alias("run")), run, token)
    counts = batch_outcomes(extracted).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("n_docs").alias("docs"),
        F.sum("n_failed").alias("failed")).first()
    return {"run": run, "batches": counts["batches"], "docs": counts["docs"] or 0,
            "failed": counts["failed"] or 0}
