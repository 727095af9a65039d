"""Numeric conventions per origin (FIXTURES §4)."""

from pyspark.sql import functions as F

from textlens.functions.labels import normalize_label


def labels(spark, rows, conventions=None):
    df = spark.createDataFrame(rows, "raw string, origin string")
    return [r[0] for r in df.select(normalize_label(F.col("raw"), F.col("origin"), conventions)).collect()]


def test_default_and_file_conventions(spark):
    f4 = "sentimen_twitter_labeled_4.csv"
    rows = [("0", "a.csv"), ("1", "a.csv"), ("2", "a.csv"), ("0", f4), ("1", f4), ("2", f4),
            ("00", "a.csv"), (" nEGATIVE ", "a.csv"), ("-0", "a.csv"), ("00", f4)]
    assert labels(spark, rows) == ["Positive", "Neutral", "Negative", "Neutral", "Positive", "Negative",
                                   "Positive", "Negative", "Positive", "00"]


def test_unmapped_pass_through(spark):
    rows = [("-1", "a"), ("3", "a"), ("positif", "a"), ("", "a"), ("--1", "a")]
    assert labels(spark, rows) == ["-1", "3", "Positif", "", "--1"]


def test_null_origin_uses_default(spark):
    assert labels(spark, [("1", None)], {"x": {"1": "Positive"}}) == ["Neutral"]
