"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (or views Spark derives from them) in
whole; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.functions.text import clean_text, word_count
from textlens.functions.labels import is_known_label
from textlens.operators import curate as cur
from textlens.session import cut_lineage
from textlens.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- curation --------------------------------------------------------------

def curated_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.curate(T.corpus(spark, sf_dir), conventions=T.CORPUS_CONVENTIONS)


@query("clean_text")
def q_clean_text(spark, sf_dir):
    docs = T.read_table(spark, sf_dir, "documents")
    cleaned = clean_text(F.col("text"))
    return docs.select("doc_id", cleaned.alias("cleaned"),
                       word_count(cleaned).cast("int").alias("n_words"))


@query("map_labels")
def q_map_labels(spark, sf_dir):
    rows = cur.normalize_labelled(T.corpus(spark, sf_dir), conventions=T.CORPUS_CONVENTIONS,
                                  keep_unknown=True)
    return rows.select("row_id", "sentiment", is_known_label(F.col("sentiment")).alias("is_known"))


@query("curate_corpus")
def q_curate_corpus(spark, sf_dir):
    return curated_corpus(spark, sf_dir).select("row_id", "text", "sentiment", "source_file",
                                                F.col("label_id").cast("int"))


@query("curation_funnel")
def q_curation_funnel(spark, sf_dir):
    return cur.funnel(T.corpus(spark, sf_dir), conventions=T.CORPUS_CONVENTIONS)


@query("label_distribution")
def q_label_distribution(spark, sf_dir):
    return cur.label_distribution(curated_corpus(spark, sf_dir))


@query("conflicting_texts")
def q_conflicting_texts(spark, sf_dir):
    return cur.conflicting_texts(T.corpus(spark, sf_dir), conventions=T.CORPUS_CONVENTIONS)


# --- metrics ---------------------------------------------------------------

from textlens.operators import metrics as met  # noqa: E402
from textlens.operators import split as spl  # noqa: E402


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return met.confusion_matrix(T.scores(spark, sf_dir))


@query("classification_report")
def q_classification_report(spark, sf_dir):
    return met.classification_report(T.scores(spark, sf_dir))


@query("epoch_metrics")
def q_epoch_metrics(spark, sf_dir):
    s = T.scores(spark, sf_dir)
    per_lang = met.present_label_metrics(s, by=["lang"]).withColumnRenamed("lang", "slice")
    overall = met.present_label_metrics(s).select(F.lit("all").alias("slice"), "*")
    return per_lang.unionByName(overall)


@query("class_weights")
def q_class_weights(spark, sf_dir):
    return met.class_weights(curated_corpus(spark, sf_dir))


@query("best_epoch")
def q_best_epoch(spark, sf_dir):
    return met.best_epoch(T.run_log(spark, sf_dir))


# --- grouped split ---------------------------------------------------------

@query("group_label_counts")
def q_group_label_counts(spark, sf_dir):
    return spl.group_label_counts(T.split_input(spark, sf_dir), [0, 1, 2])


@query("split_targets")
def q_split_targets(spark, sf_dir):
    t = spl.split_targets(T.split_input(spark, sf_dir))
    return t.withColumn("target", F.round("target", 6))


@query("grouped_split")
def q_grouped_split(spark, sf_dir):
    return spl.grouped_split(T.split_input(spark, sf_dir)).select(
        "row_id", "dup_group", "label_id", "split")


@query("split_summary")
def q_split_summary(spark, sf_dir):
    return spl.split_summary(spl.grouped_split(T.split_input(spark, sf_dir)))


# --- scoring and audit -----------------------------------------------------

from textlens.functions.labels import label_name  # noqa: E402
from textlens.operators import audit as aud  # noqa: E402
from textlens.constants import SPLIT_SEED, TARGET_COLLECTION, TEST_SIZE  # noqa: E402
from textlens.operators import evaluate as ev  # noqa: E402
from textlens.operators.rank import with_rank  # noqa: E402
from textlens.operators import scoring as sco  # noqa: E402


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a human label (labels table): toxic -> Negative,
    quality -> Positive, else Neutral; dealt by id, as their texts are taken apart."""
    T.register_tables(spark, sf_dir, ("documents", "labels"))
    return spark.sql("""
        select d.doc_id, d.text,
          case when l.toxic = 1 then 2 when l.quality = 1 then 0 else 1 end as label_id
        from labels l join documents d on l.doc_id = d.doc_id""").repartition("doc_id")


def lexicon_scorer(spark: SparkSession, sf_dir: str) -> sco.Scorer:
    """The lexicon model of a dataset, fitted on each call."""
    return sco.linear_scorer(*sco.lexicon_weights(labelled_docs(spark, sf_dir)))


def predictions(out: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return out.select(id_col, F.col("label").alias("pred"), F.round("confidence", 6).alias("confidence"))


@query("score_linear")
def q_score_linear(spark, sf_dir):
    """Weights of any number of terms, joined to the exploded tokens."""
    docs = T.read_table(spark, sf_dir, "documents")
    scorer = sco.LinearScorer(*sco.lexicon_weights(labelled_docs(spark, sf_dir)))
    return predictions(sco.score(docs, scorer, "text", "doc_id"))


@query("score_projection")
def q_score_projection(spark, sf_dir):
    """The rows of ``score_linear`` from a model that each task loads once: no token leaves its row."""
    docs = T.read_texts(spark, sf_dir, "documents", "doc_id")
    return predictions(sco.score(docs, lexicon_scorer(spark, sf_dir), "text", "doc_id"))


@query("score_hashed")
def q_score_hashed(spark, sf_dir):
    """The lexicon model by slot: vectors of a fixed size, whatever the vocabulary."""
    docs = T.read_texts(spark, sf_dir, "documents", "doc_id")
    return predictions(sco.score(docs, sco.lexicon_model(labelled_docs(spark, sf_dir)), "text", "doc_id"))


@query("label_table")
def q_label_table(spark, sf_dir):
    docs = T.read_texts(spark, sf_dir, "documents", "doc_id")
    out = sco.label_table(docs, lexicon_scorer(spark, sf_dir), "text", "doc_id")
    return out.select("doc_id", "lang", "source", "sentiment", "confidence")


@query("audit_candidates")
def q_audit_candidates(spark, sf_dir):
    # the merged, curated corpus with named labels is what gets audited
    merged = cut_lineage(curated_corpus(spark, sf_dir).select(
        "row_id", "text", F.col("sentiment").alias("label"), "source_file"), "curated")
    reviewed = labelled_docs(spark, sf_dir).select("text")     # an earlier round
    out = aud.audit_candidates(merged, lexicon_scorer(spark, sf_dir), [reviewed])
    return out.withColumn("conf", F.round("conf", 6))


# --- ingest: extraction ----------------------------------------------------

from textlens.functions.jsonpath import iso_text  # noqa: E402
from textlens.operators import extract as ext  # noqa: E402


def extracted_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.extract(T.envelopes(spark, sf_dir), keep=("conv_id",))


def post_columns(df: DataFrame) -> DataFrame:
    p = F.col("post")
    return df.select(
        "conv_id", "platform", "batch_id", p["platform_post_id"].alias("platform_post_id"),
        p["author_handle"].alias("author_handle"), p["author_name"].alias("author_name"),
        p["content"].alias("content"), p["url"].alias("url"),
        *[p[c].alias(c) for c in ("like_count", "comment_count", "share_count", "view_count")],
        iso_text(p["published_at"]).alias("published_at"), iso_text(p["crawled_at"]).alias("crawled_at"),
        F.size(p["comments"]).cast("bigint").alias("n_comments"))


def _platform_query(platform: str):
    def q(spark, sf_dir):
        ok = ext.valid_posts(extracted_envelopes(spark, sf_dir)).filter(F.col("platform") == platform)
        return post_columns(ok)
    return q


for _p in ("x", "instagram", "tiktok"):
    query(f"extract_{_p}")(_platform_query(_p))


@query("extract_comments")
def q_extract_comments(spark, sf_dir):
    ok = ext.valid_posts(extracted_envelopes(spark, sf_dir))
    c = ok.select("conv_id", "platform", F.posexplode(F.col("post.comments")).alias("pos", "c"))
    return c.select("conv_id", "platform", F.col("pos").cast("bigint").alias("pos"),
                    F.col("c.platform_comment_id").alias("platform_comment_id"),
                    F.col("c.author_handle").alias("author_handle"), F.col("c.content").alias("content"),
                    F.col("c.like_count").alias("like_count"),
                    iso_text(F.col("c.published_at")).alias("published_at"))


@query("extract_failures")
def q_extract_failures(spark, sf_dir):
    return ext.failures(extracted_envelopes(spark, sf_dir)).select("conv_id", "platform", "batch_id", "error")


# --- ingest: labelling, batches, upsert ------------------------------------

from textlens.operators import ingest as ing  # noqa: E402
from textlens.operators.labeler import label_posts  # noqa: E402
from textlens.sources import sinks  # noqa: E402


def labelled_posts(spark: SparkSession, sf_dir: str, pending_only: bool = False) -> DataFrame:
    env = T.envelopes(spark, sf_dir)
    if pending_only:
        env = ing.batch_documents(env, ing.pending_batches(env))
    ok = cut_lineage(ext.valid_posts(ext.extract(env, keep=("conv_id",))))
    return label_posts(ok, lexicon_scorer(spark, sf_dir), "lexicon-v1")


def flat_labels(df: DataFrame, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    item = lambda x: F.struct(x["sentiment"].alias("s"), x["sentiment_score"].alias("c"),
                              x["model_version"].alias("m"))
    texts = F.concat(F.array(item(F.col("post"))), F.transform(F.col("post.comments"), item))
    return df.select(*keys, F.posexplode(texts).alias("pos", "r")).select(
        *keys, F.col("pos").cast("bigint").alias("pos"), F.col("r.s").alias("sentiment"),
        F.round("r.c", 6).alias("sentiment_score"), F.col("r.m").alias("model_version"))


@query("label_posts")
def q_label_posts(spark, sf_dir):
    return flat_labels(labelled_posts(spark, sf_dir))


@query("label_posts_repeats")
def q_label_posts_repeats(spark, sf_dir):
    """Every post delivered twice, the second time with other text: each copy keeps its own label."""
    ok = cut_lineage(ext.valid_posts(ext.extract(T.envelopes(spark, sf_dir), keep=("conv_id",))))
    twice = F.concat_ws(" ", F.col("post.content"), F.col("post.content"))
    again = ok.withColumn("post", F.col("post").withField("content", twice))
    both = ok.withColumn("copy", F.lit(1)).unionByName(again.withColumn("copy", F.lit(2)))
    labelled = label_posts(both, lexicon_scorer(spark, sf_dir), "lexicon-v1")
    return flat_labels(labelled, ("conv_id", "copy"))


@query("pending_batches")
def q_pending_batches(spark, sf_dir):
    return ing.pending_batches(T.envelopes(spark, sf_dir))


@query("batch_outcomes")
def q_batch_outcomes(spark, sf_dir):
    env = T.envelopes(spark, sf_dir)
    docs = ing.batch_documents(env, ing.pending_batches(env))
    return ing.batch_outcomes(ext.extract(docs))


@query("ingest_summary")
def q_ingest_summary(spark, sf_dir):
    env = T.envelopes(spark, sf_dir)
    pend = ing.pending_batches(env)
    return ing.ingest_summary(ing.batch_outcomes(ext.extract(ing.batch_documents(env, pend))), pend)


@query("ingest_targets")
def q_ingest_targets(spark, sf_dir):
    """Pending batches by whether they are in the target collection; every eighth batch is in another."""
    other = F.when(F.col("conv_id") % 8 == 3, "profiles").otherwise(TARGET_COLLECTION)
    return ing.batch_targets(T.envelopes(spark, sf_dir).withColumn("collection", other))


@query("upsert_posts")
def q_upsert_posts(spark, sf_dir):
    """Two deliveries: every valid post, then a replay of the pending batches."""
    first = labelled_posts(spark, sf_dir).withColumn("delivery", F.lit(1).cast("bigint"))
    replay = labelled_posts(spark, sf_dir, pending_only=True).withColumn("delivery", F.lit(2).cast("bigint"))
    merged = sinks.upsert(first, replay, ing.post_keys(), [F.col("post.crawled_at"), F.col("delivery")])
    return merged.select("platform", F.col("post.platform_post_id").alias("platform_post_id"),
                         "delivery", F.col("post.sentiment").alias("sentiment"),
                         F.size("post.comments").cast("bigint").alias("n_comments"))


# --- near duplicates -------------------------------------------------------

from textlens.operators import neardup as nd  # noqa: E402
from textlens.operators import tfidf as tfi  # noqa: E402


@query("tfidf_top_terms")
def q_tfidf_top_terms(spark, sf_dir):
    docs = T.read_table(spark, sf_dir, "documents")
    t = tfi.top_terms(docs, k=5)
    return t.select(F.col("id").alias("doc_id"), F.col("rank").cast("int").alias("rank"), "term",
                    F.col("tf").cast("bigint").alias("tf"), F.col("df").cast("bigint").alias("df"),
                    F.round("weight", 6).alias("weight"))


@query("near_dup_pairs")
def q_near_dup_pairs(spark, sf_dir):
    docs = T.read_table(spark, sf_dir, "documents")
    p = nd.near_dup_pairs(docs)
    return p.select("rep_a", "rep_b", F.round("similarity", 6).alias("similarity"),
                    "copies_a", "copies_b")


@query("near_dup_groups")
def q_near_dup_groups(spark, sf_dir):
    docs = T.read_table(spark, sf_dir, "documents")
    return nd.near_dup_groups(docs).select(F.col("id").alias("doc_id"), "dup_group")


@query("cluster_stats")
def q_cluster_stats(spark, sf_dir):
    docs = T.read_table(spark, sf_dir, "documents")
    return nd.cluster_stats(nd.near_dup_groups(docs))


# --- streaming ingest, CSV sources, baseline ---------------------------------

from textlens.session import scratch_path  # noqa: E402
from textlens.sources import csv_files  # noqa: E402
from textlens.streaming.ingest_stream import start_ingest_stream  # noqa: E402


def streamed(spark: SparkSession, sf_dir: str, deliveries: list[DataFrame]) -> ing.IngestStore:
    """A store fed by one Structured Streaming query that is started anew, from its checkpoint, on each delivery
    of files; a delivery has as many files as Spark makes of it."""
    src, progress = scratch_path(spark, "envelopes"), scratch_path(spark, "stream-ckpt")
    store, scorer = ing.IngestStore(spark, scratch_path(spark, "ingest")), lexicon_scorer(spark, sf_dir)
    for rows in deliveries:
        rows.write.mode("append").parquet(src)
        start_ingest_stream(spark, src, rows.schema, scorer, store, progress, "lexicon-v1", doc_id="conv_id").awaitTermination()
    return store


@query("ingest_stream")
def q_ingest_stream(spark, sf_dir):
    """Envelopes land as files in two deliveries; a Structured Streaming query ingests them."""
    env = T.envelopes(spark, sf_dir)
    store = streamed(spark, sf_dir, [env.filter(F.col("conv_id") % 3 != 0), env.filter(F.col("conv_id") % 3 == 0)])
    posts = store.posts.current()
    return posts.select("platform", F.col("post.platform_post_id").alias("platform_post_id"),
                        F.col("post.sentiment").alias("sentiment"),
                        F.round("post.sentiment_score", 6).alias("sentiment_score"),
                        F.size("post.comments").cast("bigint").alias("n_comments"))


def ledger_and_posts(store: ing.IngestStore) -> DataFrame:
    """The ledger with the posts that each batch has delivered."""
    posts = store.posts.current().groupBy(*ing.BATCH_KEYS).agg(F.count(F.lit(1)).alias("n_posts"))
    return (store.ledger.current().join(posts, list(ing.BATCH_KEYS), "left")
            .select(*ing.BATCH_KEYS, "n_docs", "n_failed", "status",
                    F.coalesce("n_posts", F.lit(0)).cast("bigint").alias("n_posts")))


@query("ingest_late_arrivals")
def q_ingest_late_arrivals(spark, sf_dir):
    """Two runs: a seventh of the documents reach their batches only after the first."""
    env = T.envelopes(spark, sf_dir)
    store = ing.IngestStore(spark, scratch_path(spark, "ingest"))
    scorer = lexicon_scorer(spark, sf_dir)
    ing.ingest(env.filter(F.col("conv_id") % 7 != 3), scorer, store, doc_id="conv_id")
    ing.ingest(env, scorer, store, doc_id="conv_id")
    return ledger_and_posts(store)


@query("ingest_stream_retry")
def q_ingest_stream_retry(spark, sf_dir):
    """A stream of all documents, then of the failed ones once more, mended."""
    mended = T.envelopes(spark, sf_dir, faults=False).filter(F.col("conv_id") % 17 == 5)
    store = streamed(spark, sf_dir, [T.envelopes(spark, sf_dir), mended])
    return ledger_and_posts(store)


@query("csv_curate_corpus")
def q_csv_curate_corpus(spark, sf_dir):
    """The corpus written as CSV batches, loaded back through S1-S3 and curated."""
    folder = scratch_path(spark, "csv")
    corpus = T.corpus(spark, sf_dir).withColumnRenamed("label_raw", "sentiment")
    (corpus.repartitionByRange("row_id").sortWithinPartitions("row_id")
           .select("text", "sentiment", "source_file")
           .write.option("header", True).option("escape", '"')
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
           .csv(folder))
    curated, _ = csv_files.load_dataset(spark, folder, T.CORPUS_CONVENTIONS)
    return curated.select("text", "sentiment", "source_file")


#: CSV batches of the corpus: separator, encoding, header -> column
CSV_BATCHES = (
    (",", "UTF-8", {"text": "text", "label": "label_raw", "source_file": "source_file"}),
    ("\t", "UTF-8", {"Tweet": "text", "source_file": "source_file", "Sentiment": "label_raw"}),
    (",", "ISO-8859-1", {"id": "row_id", " TARGET": "label_raw", "Text": "text", "source_file": "source_file"}),
    ("\t", "ISO-8859-1", {"sentence": "text", "class": "label_raw"}),
    # two text and two label columns: the first by priority, the first by place
    (",", "UTF-8", {"content": "row_id", "label": "label_raw", "text": "text", "class": "row_id", "source_file": "source_file"}),
    (",", "UTF-8", {"id": "row_id", "text": "text"}),
)


def csv_batches(spark: SparkSession, sf_dir: str) -> str:
    """The corpus as a folder of CSV files named ``b<batch>-...``, with line breaks and quotes inside the texts."""
    folder, fs = scratch_path(spark, "csv-batches"), spark._jvm.org.apache.hadoop.fs
    root = fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(root)
    broken = F.expr("replace(replace(text, '. ', concat('.', chr(10))), ' the ', ' \"the\" ')")
    corpus = T.corpus(spark, sf_dir).withColumn("text", broken)
    for k, (sep, encoding, columns) in enumerate(CSV_BATCHES):
        part = corpus.filter(F.col("row_id") % len(CSV_BATCHES) == k)
        if encoding != "UTF-8":
            part = part.withColumn("text", F.regexp_replace("text", r"[^\x{00}-\x{FF}]", "?"))
        out = scratch_path(spark, "csv-batch")
        (part.select(*[F.col(c).cast("string").alias(name) for name, c in columns.items()])
             .write.option("header", True).option("escape", '"').option("sep", sep).option("encoding", encoding)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(out))
        for st in files.listStatus(fs.Path(out)):
            name = st.getPath().getName()
            if name.endswith(".csv"):
                files.rename(st.getPath(), fs.Path(root, f"b{k}-{name}"))
    return folder


def batch_of(file: str = "file"):
    return F.substring(file, 2, 1).cast("int")


@query("csv_dialects")
def q_csv_dialects(spark, sf_dir):
    """Both separators, both encodings and fields with line breaks, read back row by row."""
    rows, _ = csv_files.load_labelled(spark, csv_batches(spark, sf_dir))
    return rows.select(batch_of().alias("batch"), F.md5("text").alias("text_md5"), "label_raw", "source_file")


@query("csv_folder_report")
def q_csv_folder_report(spark, sf_dir):
    """S3: usable rows and skipped files, by batch."""
    report = csv_files.file_report(spark, csv_batches(spark, sf_dir), T.CORPUS_CONVENTIONS)
    return report.groupBy(batch_of().alias("batch"), "sep").agg(
        F.sum("n_usable").alias("n_usable"), F.bool_or("multiline").alias("multiline"),
        F.bool_and(F.coalesce(F.col("skipped") == csv_files.NO_COLUMNS, F.lit(False))).alias("unlabelled"))


#: gradient steps of the registered baseline; its oracle takes as many
BASELINE_STEPS = 30


def baseline_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: curate -> near-dup groups -> grouped split -> fit -> the scored validation rows."""
    from textlens.operators.baseline import fit_baseline
    data = cut_lineage(corpus_with_groups(spark, sf_dir), "grouped")
    split = cut_lineage(spl.grouped_split(data), "split")
    model = fit_baseline(split.filter(F.col("split") == "train"), max_iter=BASELINE_STEPS)
    return sco.score(split.filter(F.col("split") == "val"), model, "text", "row_id")


@query("baseline_scores")
def q_baseline_scores(spark, sf_dir):
    return predictions(baseline_predictions(spark, sf_dir), "row_id")


@query("baseline_metrics")
def q_baseline_metrics(spark, sf_dir):
    """M1 + M5: the report of the baseline on its validation rows."""
    pred = baseline_predictions(spark, sf_dir)
    return met.classification_report(pred.select(label_name(F.col("label_id")).alias("actual"),
                                                 F.col("label").alias("predicted")))


def stored_run(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A split of the labelled documents and the hashed lexicon model of its training rows, written."""
    docs = T.read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("n_chars").alias("dup_group"))
    rows = labelled_docs(spark, sf_dir).withColumnRenamed("doc_id", "row_id").join(docs, "row_id")
    split = cut_lineage(spl.grouped_split(rows), "split")
    model_path, split_path = scratch_path(spark, "model"), scratch_path(spark, "stored-split")
    model = sco.lexicon_model(split.filter(F.col("split") == "train"))
    model.trained_on = ev.save_split(split, split_path)
    model.save(spark, model_path)
    return model_path, split_path


@query("evaluate_stored")
def q_evaluate_stored(spark, sf_dir):
    """M5: a written model and a written split are read back, checked and evaluated; nothing is fitted by steps."""
    return ev.evaluate_stored(spark, *stored_run(spark, sf_dir))["classification_report"]


@query("run_report")
def q_run_report(spark, sf_dir):
    """Parameters, split, labels, report and confusion matrix of a stored run as one table."""
    return ev.run_report(spark, *stored_run(spark, sf_dir), {"test_size": TEST_SIZE, "seed": SPLIT_SEED})


@query("audit_ranked")
def q_audit_ranked(spark, sf_dir):
    """O1: the audit's candidates with their place, most confident first."""
    return with_rank(q_audit_candidates(spark, sf_dir), [F.desc("conf"), F.asc("text"), F.asc("row_id")])


@query("post_payloads")
def q_post_payloads(spark, sf_dir):
    """Labelled posts serialised as whole-record JSON."""
    lp = labelled_posts(spark, sf_dir)
    return lp.select("conv_id", ext.to_payload(F.col("post")).alias("payload"))


@query("payload_posts")
def q_payload_posts(spark, sf_dir):
    """The posts' fields, read back from the payloads; raw documents must be JSON values, not text."""
    return payload_fields(spark, sf_dir, ("platform", "platform_post_id", "author_handle", "author_name", "content", "url",
                                          "published_at", "crawled_at", "model_version"),
                          ("like_count", "comment_count", "share_count", "view_count"), "$")


@query("payload_comments")
def q_payload_comments(spark, sf_dir):
    """The comments nested in the payloads, by place."""
    return payload_fields(spark, sf_dir, ("platform_comment_id", "author_handle", "content", "published_at", "model_version"),
                          ("like_count",), "$.comments")


def payload_fields(spark: SparkSession, sf_dir: str, texts: tuple, counts: tuple, path: str) -> DataFrame:
    doc = q_post_payloads(spark, sf_dir).select("conv_id", F.parse_json("payload").alias("v"))
    if path != "$":
        doc = (doc.select("conv_id", F.posexplode(F.variant_get("v", path, "array<variant>")).alias("pos", "v"))
                  .withColumn("pos", F.col("pos").cast("bigint")))
    return doc.select(*[c for c in doc.columns if c != "v"],
                      *[F.variant_get("v", f"$.{c}", "string").alias(c) for c in texts],
                      *[F.variant_get("v", f"$.{c}", "bigint").alias(c) for c in counts],
                      F.variant_get("v", "$.sentiment", "string").alias("sentiment"),
                      F.round(F.variant_get("v", "$.sentiment_score", "double"), 6).alias("sentiment_score"),
                      F.expr("schema_of_variant(variant_get(v, '$.raw_payload', 'variant')) like 'OBJECT%'").alias("raw_is_object"))


# --- the reference flow: curate -> near-duplicate groups -> grouped split ----

def corpus_with_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = cut_lineage(curated_corpus(spark, sf_dir), "curated")
    groups = nd.near_dup_groups(curated, "row_id", "text").withColumnRenamed("id", "row_id")
    return curated.join(groups, "row_id")


@query("corpus_dup_groups")
def q_corpus_dup_groups(spark, sf_dir):
    return corpus_with_groups(spark, sf_dir).select("row_id", "dup_group")


@query("corpus_split_summary")
def q_corpus_split_summary(spark, sf_dir):
    data = cut_lineage(corpus_with_groups(spark, sf_dir), "grouped")
    return spl.split_summary(spl.grouped_split(data))
