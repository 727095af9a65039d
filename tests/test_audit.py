"""M6 (FIXTURES §4): threshold inclusive, agreement dropped, earlier rounds
excluded, top_n 0 = no limit."""

import re

import numpy as np
from pyspark.sql import functions as F

from textlens.operators.audit import audit_candidates
from textlens.operators.scoring import IteratorScorer


def fake_scorer(spark, table):
    preds = spark.createDataFrame(table, "_text string, label string, confidence double")

    def score(rows):
        return rows.join(preds, "_text").select("_rid", "label", "confidence")
    return score


def test_audit_rules(spark):
    rows = spark.createDataFrame(
        [(1, "one two", "Positive"), (2, "three four", "Positive"), (3, "five six", "Negative"),
         (4, "seen before", "Positive"), (5, "seven eight", " neutral ")],
        "row_id long, text string, label string")
    sc = fake_scorer(spark, [("one two", "Negative", 0.90), ("three four", "Negative", 0.8999),
                             ("five six", "Negative", 0.99), ("seen before", "Negative", 0.99),
                             ("seven eight", "Positive", 0.95)])
    earlier = [spark.createDataFrame([("seen  before",)], "text string")]
    out = audit_candidates(rows, sc, earlier)
    assert sorted(r.row_id for r in out.collect()) == [1, 5]
    top = audit_candidates(rows, sc, earlier, top_n=1).collect()
    assert [r.row_id for r in top] == [5]
    assert audit_candidates(rows, sc, earlier, top_n=0).count() == 2


def test_audit_csv_round_trip(spark, tmp_folder):
    import glob
    import os

    import pandas as pd

    from textlens.operators.audit import audit_csv
    corpus = os.path.join(tmp_folder, "merged.csv")
    pd.DataFrame({"Text ": ["one two", "five six", "seen before"], "Label": ["Positive", "Negative", "Positive"],
                  "source_file": ["a", "b", "c"]}).to_csv(corpus, index=False)
    prev = os.path.join(tmp_folder, "label_audit_1.csv")
    pd.DataFrame({"text": ["seen before"], "sentiment": ["Positive"], "pred": ["Negative"],
                  "conf": [0.99]}).to_csv(prev, index=False)
    sc = fake_scorer(spark, [("one two", "Negative", 0.95), ("five six", "Negative", 0.99),
                             ("seen before", "Negative", 0.99)])
    out = audit_csv(spark, f"file://{corpus}", [f"file://{prev}", f"file://{tmp_folder}/missing.csv"],
                    sc, f"file://{tmp_folder}/rounds", stamp="t1")
    rows = pd.concat(pd.read_csv(p) for p in glob.glob(os.path.join(out.replace("file://", ""), "*.csv")))
    assert list(rows.columns) == ["source", "text", "sentiment", "pred", "conf"]
    assert rows["text"].tolist() == ["one two"]
    # a second round finds the first one by itself, a third finds an empty one
    again = audit_csv(spark, f"file://{corpus}", [f"file://{prev}"], sc, f"file://{tmp_folder}/rounds", stamp="t2")
    assert not any(len(pd.read_csv(p)) for p in glob.glob(os.path.join(again.replace("file://", ""), "*.csv")))
    third = audit_csv(spark, f"file://{corpus}", [], sc, f"file://{tmp_folder}/rounds", stamp="t3")
    rows = pd.concat(pd.read_csv(p) for p in glob.glob(os.path.join(third.replace("file://", ""), "*.csv")))
    assert rows["text"].tolist() == ["seen before"]


def test_each_row_is_scored_once_and_texts_meet_by_keys(spark):
    """Filters on the prediction are not pushed below it, nor to the earlier rounds; whole texts are not join keys."""
    rows = spark.createDataFrame([(i, f"some text {i}", "Positive") for i in range(40)], "row_id long, text string, label string")
    rows = rows.repartition(2, "row_id")
    seen = spark.createDataFrame([("some text 3",), (None,)], "text string")
    scorer = IteratorScorer(lambda: None, lambda _, texts: np.tile([0.01, 0.01, 0.98], (len(texts), 1)))
    out = audit_candidates(rows, scorer, [seen])
    p = out._jdf.queryExecution().executedPlan().toString()
    assert p.count("ArrowEvalPython") == 1 and not re.search(r"hashpartitioning\(text|Join \[text", p)
    assert {r.row_id for r in out.collect()} == set(range(40)) - {3}
