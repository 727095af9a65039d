"""Label-noise audit (M6): rows whose stored label the model confidently disputes.

normalise (no numeric mapping) -> drop texts already audited (anti-join on
the cleaned text) -> score -> disagreement at >= threshold -> most confident
first -> optional top-N -> ``[source], text, sentiment, pred, conf``.
The anti-join runs before scoring: the scorer is the expensive step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.constants import AUDIT_THRESHOLD, SOURCE_COL
from textlens.functions.labels import is_known_label
from textlens.functions.text import capitalize, clean_text, strip_ws
from textlens.operators.scoring import Scorer


def text_keys(cleaned: Column) -> list[Column]:
    """128 bits that stand for a cleaned text, so that rows meet by numbers."""
    return [F.xxhash64(cleaned).alias("_h1"), F.xxhash64(F.lit(1), cleaned).alias("_h2")]


def audited_keys(rounds: Sequence[DataFrame], text: str = "text") -> DataFrame | None:
    """Keys of the cleaned texts of earlier rounds (rounds without a text column skipped)."""
    parts = [r.filter(F.col(text).isNotNull()).select(clean_text(F.col(text)).alias("text")).select(*text_keys(F.col("text")))
             for r in rounds if text in r.columns]
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def audit_rows(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """F1-F3 of the audit: null drop, clean, strip + capitalise, allow-list."""
    out = (df.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
             .withColumn(text, clean_text(F.col(text)))
             .withColumn(label, capitalize(strip_ws(F.col(label).cast("string")))))
    return out.filter(is_known_label(F.col(label)))


def audit_candidates(df: DataFrame, scorer: Scorer, earlier: Sequence[DataFrame] = (),
                     threshold: float = AUDIT_THRESHOLD, top_n: int | None = None,
                     text: str = "text", label: str = "label", id_col: str = "row_id") -> DataFrame:
    rows = audit_rows(df, text, label)
    seen = audited_keys(earlier)
    if seen is not None:                       # F7/J5/O6: keeps duplicates
        rows = rows.select("*", *text_keys(F.col(text))).join(seen, ["_h1", "_h2"], "left_anti").drop("_h1", "_h2")
    # the scorer cleans what it is given, as the prediction helper does: the
    # audited text is cleaned twice (cleaning is not idempotent on every input)
    if hasattr(scorer, "column"):
        scored = rows.withColumn("_s", scorer.column(clean_text(F.col(text)))).withColumns(
            {"_pred": F.col("_s.label"), "_conf": F.col("_s.confidence")})
    else:
        rows = rows.withColumn("_rid", F.col(id_col)).withColumn("_text", clean_text(F.col(text)))
        preds = scorer(rows.select("_rid", "_text")).select(
            "_rid", F.col("label").alias("_pred"), F.col("confidence").alias("_conf"))
        scored = rows.join(preds, "_rid")
    cand = scored.filter((F.col("_pred") != F.col(label)) & (F.col("_conf") >= threshold))
    cols = ([F.col(SOURCE_COL).alias("source")] if SOURCE_COL in df.columns else []) + [
        F.col(text).alias("text"), F.col(label).alias("sentiment"),
        F.col("_pred").alias("pred"), F.col("_conf").alias("conf"), F.col(id_col)]
    cand = cand.select(*cols)
    if top_n:                                  # 0 / None = no limit
        cand = cand.orderBy(F.desc("conf"), "text", id_col).limit(int(top_n))
    return cand


def _file_system(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def written_rounds(spark, root: str) -> list[str]:
    """The audit rounds that were written in full under ``root``."""
    fs, p = _file_system(spark, root)
    if not fs.exists(p):
        return []
    found = [st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName().startswith("round=")]
    return [r for r in found if fs.exists(_file_system(spark, f"{r}/_SUCCESS")[1])]


def earlier_rounds(spark, paths: Sequence[str]) -> list[DataFrame]:
    """A17 inputs: earlier audit CSVs in name order; missing files are skipped."""
    from textlens.sources.csv_files import read_csv
    out = []
    for path in sorted(paths, key=lambda s: s.rsplit("/", 1)[-1]):
        fs, p = _file_system(spark, path)
        if fs.exists(p):
            out.append(read_csv(spark, path))
    return out


def audit_csv(spark, corpus_path: str, earlier_paths: Sequence[str], scorer: Scorer, out_root: str,
              threshold: float = AUDIT_THRESHOLD, top_n: int | None = None,
              stamp: str | None = None) -> str:
    """M6 end to end: corpus CSV (``text``, ``label``[, ``source_file``]) ->
    candidates, most confident first, written as a new audit round (S9).

    The rounds already under ``out_root`` count as earlier ones, besides
    ``earlier_paths``.  Files of a round follow the order of its rows.
    """
    from textlens.sources.csv_files import read_csv
    from textlens.sources.sinks import write_audit_round
    corpus = read_csv(spark, corpus_path).withColumnRenamed("_row", "row_id")
    earlier = earlier_rounds(spark, [*earlier_paths, *written_rounds(spark, out_root)])
    cand = audit_candidates(corpus, scorer, earlier, threshold, top_n)
    return write_audit_round(cand.orderBy(F.desc("conf"), "text", "row_id").drop("row_id"), out_root, stamp)
