"""M1 baseline, M3+S8 CSV labelling, M4 ad-hoc prediction, S13 report tables."""

import glob
import os

import pandas as pd
from pyspark.sql import functions as F

from textlens.operators.baseline import fit_baseline
from textlens.operators.metrics import evaluate, save_report
from textlens.operators.scoring import LinearScorer, predict_texts, score
from textlens.sources.csv_files import label_csv


def toy(spark):
    rows = []
    for i in range(30):
        rows.append((f"great good happy day {i % 5}", 0))
        rows.append((f"plain normal usual day {i % 5}", 1))
        rows.append((f"awful bad sad day {i % 5}", 2))
    return spark.createDataFrame(rows, "text string, label_id int")


def test_baseline_learns_separable_classes(spark):
    df = toy(spark)
    model = fit_baseline(df, max_iter=200)
    probe = spark.createDataFrame([(1, "good happy"), (2, "normal usual"), (3, "bad sad")],
                                  "id long, text string")
    out = {r.id: r.label for r in score(probe, model, "text", "id").collect()}
    assert out == {1: "Positive", 2: "Neutral", 3: "Negative"}


def lexicon(spark):
    w = spark.createDataFrame([("good", 2.0, 0.0, -2.0), ("bad", -2.0, 0.0, 2.0)],
                              "term string, w0 double, w1 double, w2 double")
    return LinearScorer(w, [0.0, 0.5, 0.0])


def test_predict_texts_and_ties(spark):
    sc = lexicon(spark)
    got = {r.text: (r.label, round(r.confidence, 4))
           for r in predict_texts(spark, ["good day", "bad day", "", "good bad"], sc).collect()}
    assert got["good day"][0] == "Positive" and got["bad day"][0] == "Negative"
    assert got[""][0] == "Neutral" and got["good bad"][0] == "Neutral"


def test_label_csv_keeps_rows_and_columns(spark, tmp_folder):
    src = os.path.join(tmp_folder, "in.csv")
    pd.DataFrame({"id": [1, 2, 3], "text": ["good one", None, "bad @x http://y"]}).to_csv(src, index=False)
    out_dir = os.path.join(tmp_folder, "out")
    label_csv(spark, f"file://{src}", f"file://{out_dir}", lexicon(spark))
    written = pd.concat(pd.read_csv(p) for p in sorted(glob.glob(os.path.join(out_dir, "*.csv"))))
    assert list(written.columns) == ["id", "text", "sentiment", "confidence"]
    assert written["id"].tolist() == [1, 2, 3]
    assert written["sentiment"].tolist() == ["Positive", "Neutral", "Negative"]
    assert all(round(c, 4) == c for c in written["confidence"])


def test_evaluate_and_report(spark, tmp_folder):
    scored = spark.createDataFrame([("Positive", "Positive"), ("Neutral", "Negative")],
                                   "actual string, predicted string")
    tables = evaluate(scored)
    base = save_report(tables, f"file://{tmp_folder}", "r1")
    back = spark.read.parquet(f"{base}/confusion_matrix")
    assert back.count() == 9 and back.agg(F.sum("n")).first()[0] == 2
