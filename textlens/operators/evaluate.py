"""M5: a stored model evaluated on a stored split, without fitting anything.

A split is stored as its rows and one row of facts about them: their number and
a fingerprint of (id, label, side), which does not depend on their order.  A
model keeps the fingerprint of the split it was fitted on.  On evaluation both
are read back and checked against each other, then the validation rows are
scored in one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.functions.labels import label_name
from textlens.operators.metrics import classification_report, confusion_matrix, evaluate
from textlens.operators.scoring import HashedModel, score
from textlens.operators.split import split_summary
from textlens.session import cut_lineage


def fingerprint(split: DataFrame, id_col: str = "row_id", label: str = "label_id") -> tuple[int, str]:
    """Number of rows and order-free hash of (id, label, side); repeated rows change it, too."""
    row = F.xxhash64(F.col(id_col).cast("string"), F.col(label).cast("int"), "split")
    r = split.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("x"),
                  F.coalesce(F.sum(F.shiftrightunsigned(row, 32)), F.lit(0)).alias("s")).first()
    return r["n"], f"{r['n']}:{r['x']}:{r['s']}"


def save_split(split: DataFrame, path: str, id_col: str = "row_id", text: str = "text", label: str = "label_id") -> str:
    """Writes ``id, text, label, split`` and their facts; returns the fingerprint."""
    spark = split.sparkSession
    split.select(F.col(id_col).alias("row_id"), F.col(text).alias("text"), F.col(label).cast("int").alias("label_id"),
                 "split").write.parquet(f"{path}/rows")
    n, mark = fingerprint(spark.read.parquet(f"{path}/rows"))
    spark.createDataFrame([(n, mark)], "n_rows long, fingerprint string").write.parquet(f"{path}/facts")
    return mark


def load_split(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The rows of a stored split and its fingerprint; raises where they are not those that were written."""
    rows, facts = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/facts").first()
    n, mark = fingerprint(rows)
    if mark != facts["fingerprint"]:
        raise ValueError(f"the split should have {facts['n_rows']} rows ({facts['fingerprint']}), {n} were read ({mark})")
    return rows, mark


def scored_split(spark: SparkSession, model_path: str, split_path: str, side: str = "val") -> DataFrame:
    """(row_id, actual, predicted, confidence) of the stored rows of one side."""
    model = HashedModel.load(spark, model_path)
    rows, mark = load_split(spark, split_path)
    if model.trained_on and model.trained_on != mark:
        raise ValueError(f"the model was fitted on another split: {model.trained_on}, not {mark}")
    strange = rows.filter(~F.col("label_id").between(0, len(model.labels) - 1)).limit(1).collect()
    if strange:
        raise ValueError(f"the split holds label {strange[0]['label_id']}, the model knows {len(model.labels)} labels")
    out = score(rows.filter(F.col("split") == side), model, "text", "row_id")
    return out.select("row_id", label_name(F.col("label_id")).alias("actual"), F.col("label").alias("predicted"), "confidence")


def evaluate_stored(spark: SparkSession, model_path: str, split_path: str) -> dict[str, DataFrame]:
    """The classification report and the confusion matrix of the stored validation rows."""
    return evaluate(scored_split(spark, model_path, split_path))


def _long(section: str, df: DataFrame, names: list[str], values: list[str]) -> DataFrame:
    """Rows (section, name, value): every value column of every row, named by the row's names and the column."""
    long = df.select(*names, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(names, values, "_column", "value")
    parts = [*names, *(["_column"] if len(values) > 1 else [])]
    return long.select(F.lit(section).alias("section"), F.concat_ws(".", *parts).alias("name"), "value").filter("value is not null")


def run_report(spark: SparkSession, model_path: str, split_path: str, parameters: dict[str, float]) -> DataFrame:
    """One long table (section, name, value) of a run: parameters, split sizes, labels of the training rows,
    classification report and confusion matrix.  The validation rows are scored once."""
    rows, _ = load_split(spark, split_path)
    scored = cut_lineage(scored_split(spark, model_path, split_path).select("actual", "predicted"), "scored")
    sizes = split_summary(rows)
    labels = (rows.filter("split = 'train'").groupBy(label_name(F.col("label_id")).alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    given = spark.createDataFrame([(k, float(v)) for k, v in parameters.items()], "name string, value double")
    parts = [_long("parameter", given, ["name"], ["value"]),
             _long("split", sizes, [], [c for c in sizes.columns if c != "empty_labels"]),
             _long("train_label", labels, ["label"], ["n"]),
             _long("report", classification_report(scored), ["label"], ["precision", "recall", "f1", "support"]),
             _long("confusion", confusion_matrix(scored), ["actual", "predicted"], ["n"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
