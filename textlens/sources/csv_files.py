"""Labelled CSV batches (S1-S3, P1-P5) and the CSV labelling job (M3 + S8).

All files of a folder are found, understood and parsed by a constant number of
jobs (``csv_scan``): separator and encoding per file, text and label column by
name, records split at line breaks outside quotes.  Values equal to pandas'
missing-value tokens are nulls.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.constants import SOURCE_COL
from textlens.session import cut_lineage
from textlens.sources import csv_scan
from textlens.sources.csv_scan import resolve_columns

__all__ = ["CsvDialect", "LoadReport", "file_report", "label_csv", "list_csv", "load_dataset", "load_labelled", "read_csv",
           "resolve_columns", "sniff", "usable_per_file"]

NO_COLUMNS, NO_ROWS = "no text or label column", "no usable rows"


@dataclass
class CsvDialect:
    sep: str
    encoding: str       # "UTF-8" or "ISO-8859-1"
    multiline: bool = True      # a field holds a line break


@dataclass
class LoadReport:
    usable: dict[str, int] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Every ``*.csv`` of a folder, sorted by name (file listing only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = [st.getPath().toString() for st in fs.listStatus(p)
           if st.isFile() and st.getPath().getName().lower().endswith(".csv")]
    return sorted(out, key=lambda s: s.rsplit("/", 1)[-1])


def _files(spark: SparkSession, path: str) -> list[str]:
    """The file, or the files of the folder, in name order."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.getFileStatus(p).isDirectory():
        return [path]
    return sorted(st.getPath().toString() for st in fs.listStatus(p)
                  if st.isFile() and not st.getPath().getName().startswith(("_", ".")))


def _known(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The blocks of all files; raises for files that cannot be read."""
    known = csv_scan.blocks(spark, paths, SOURCE_COL)
    bad = known.filter("error is not null").select("file", "error").distinct().limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r['file']}: {r['error']}" for r in bad))
    if known.select("file").distinct().count() < len(paths):
        there = {r["file"] for r in known.select("file").distinct().collect()}      # no more than were listed
        raise ValueError("; ".join(f"{p.rsplit('/', 1)[-1]}: the file is empty" for p in paths if p.rsplit("/", 1)[-1] not in there))
    return known


def sniff(spark: SparkSession, path: str) -> CsvDialect:
    """Resolve separator and encoding; raise when no combination works."""
    r = _known(spark, [path]).first()
    return CsvDialect(r["sep"], r["encoding"], r["multiline"])


def _about(at) -> list:
    return ["file", "block", "case", "carry", F.struct("sep", "encoding", "head_at", at.alias("at")).alias("about")]


def read_csv(spark: SparkSession, path: str, keep_names: bool = False) -> DataFrame:
    """All columns of a file, or of a folder's files, as strings; header names lower-cased and stripped
    unless ``keep_names``; pandas' NA tokens become nulls; ``_row`` follows the order of files and rows.

    The columns are those of the first file; those of other files are found by their names.
    """
    paths = _files(spark, path)
    known = _known(spark, paths)
    base = paths[0].rsplit("/", 1)[-1]
    names = known.filter(F.col("file") == base).first()["names"]
    picked = F.transform(F.array(*[F.lit(c) for c in names]), lambda c: (F.array_position("names", c) - 1).cast("int"))
    own = F.array(*[F.lit(i) for i in range(len(names))])
    at = F.when(F.col("names") == F.array(*[F.lit(c) for c in names]), own).otherwise(picked)
    rows = csv_scan.parsed(spark, paths, known.select(*_about(at)), len(names))
    order = F.col("place")
    if len(paths) > 1:
        number = spark.createDataFrame([(p.rsplit("/", 1)[-1], i) for i, p in enumerate(paths)], "file string, _n long")
        rows, order = rows.join(number, "file"), F.shiftleft("_n", 44) + F.col("place")     # files under 16 TB
    out = names if keep_names else [c.lower().strip() for c in names]
    return rows.select(*[F.col(f"c{i}") for i in range(len(names))], order.alias("_row")).toDF(*out, "_row")


def load_labelled(spark: SparkSession, folder: str, known: DataFrame | None = None) -> tuple[DataFrame, LoadReport]:
    """Every usable file as ``file, row_id, text, label_raw, source_file, origin``; unusable
    files are skipped and reported.  ``row_id`` is the place of a row in its file."""
    paths = list_csv(spark, folder)
    if not paths:
        raise FileNotFoundError(f"{folder} holds no .csv file")
    known = _known(spark, paths) if known is None else known
    report = LoadReport()
    for r in known.filter("text_at < 0 or label_at < 0").select("file").distinct().collect():
        report.skipped[r["file"]] = NO_COLUMNS
    if len(report.skipped) == len(paths):
        raise ValueError(f"none of the {len(paths)} files in {folder} has a text and a label column")
    used = known.filter("text_at >= 0 and label_at >= 0")
    rows = csv_scan.parsed(spark, paths, used.select(*_about(F.array("text_at", "label_at", "source_at"))), 3)
    return rows.select("file", F.col("place").alias("row_id"), F.col("c0").alias("text"), F.col("c1").alias("label_raw"),
                       F.col("c2").alias("source_file"),
                       F.when(F.col("own"), F.col("c2")).otherwise(F.col("file")).alias("origin")), report


def usable_per_file(loaded: DataFrame, conventions=None) -> DataFrame:
    """A2 per file: rows left after null drop, label mapping and allow-list."""
    from textlens.operators.curate import normalize_labelled
    rows = normalize_labelled(loaded, "text", "label_raw", "origin", conventions)
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_usable"))


def file_report(spark: SparkSession, folder: str, conventions=None) -> DataFrame:
    """S3 as a table: ``file, sep, encoding, multiline, n_usable, skipped`` (the reason, or null) of every file."""
    known = _known(spark, list_csv(spark, folder))
    loaded, _ = load_labelled(spark, folder, known)
    files = known.filter("block = 0").select("file", "sep", "encoding", "multiline",
                                             ((F.col("text_at") < 0) | (F.col("label_at") < 0)).alias("_no"))
    out = files.join(usable_per_file(loaded, conventions), "file", "left")
    n = F.coalesce("n_usable", F.lit(0))
    return out.select("file", "sep", "encoding", "multiline", n.alias("n_usable"),
                      F.when(F.col("_no"), NO_COLUMNS).when(n == 0, NO_ROWS).alias("skipped"))


def load_dataset(spark: SparkSession, folder: str, conventions=None):
    """The curated corpus of a folder of labelled CSVs plus the load report."""
    from textlens.operators.curate import curate
    loaded, report = load_labelled(spark, folder)
    loaded = cut_lineage(loaded, "csv")         # parsed once
    for r in usable_per_file(loaded, conventions).collect():     # one row per file
        report.usable[r["file"]] = r["n_usable"]
    for path in list_csv(spark, folder):
        name = path.rsplit("/", 1)[-1]
        if name not in report.usable and name not in report.skipped:
            report.skipped[name] = NO_ROWS
    curated = curate(loaded, "text", "label_raw", "origin", ("file", "row_id"), conventions,
                     keep=("text", "sentiment", "source_file"))
    return curated, report


def label_csv(spark: SparkSession, input_path: str, output_path: str, scorer,
              text_col: str = "text") -> DataFrame:
    """M3 + S8: label every row of a CSV and write all columns + results."""
    from textlens.operators.scoring import label_table
    from textlens.sources.sinks import write_csv
    df = read_csv(spark, input_path, keep_names=True)
    out = label_table(df, scorer, text_col, "_row").orderBy("_row").drop("_row")
    write_csv(out, output_path)
    return out
