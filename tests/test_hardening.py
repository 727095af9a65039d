"""Cases off the clean path: bad values, odd headers, few classes, rows without an id."""

import os

from pyspark.sql import functions as F

from textlens.functions.jsonpath import count_or_zero, iso_instant, python_int, unix_seconds
from textlens.operators.baseline import fit_baseline
from textlens.operators.scoring import LinearScorer, label_table
from textlens.sources.csv_files import label_csv, read_csv


def test_bad_numbers_and_times_never_stop_the_job(spark):
    vals = ['1700000000', '"1700000000"', '1700000000000', '9.5e12', '"1700000000.5"', '1e30', 'null', '"x"', '9007199254740993']
    df = spark.createDataFrame([(i, '{"v": %s}' % v) for i, v in enumerate(vals)], "i int, j string")
    v = F.try_parse_json("j")
    got = df.select("i", unix_seconds(v, "$.v").cast("long").alias("t"), python_int(v, "$.v").alias("n"),
                    count_or_zero(v, "$.v").alias("c")).orderBy("i").collect()
    assert [r.t for r in got] == [1700000000, 1700000000, None, None, None, None, None, None, None]
    assert got[5].n is None and got[5].c == 0 and got[8].n == got[8].c == 9007199254740993


def test_year_alone_is_no_instant(spark):
    df = spark.createDataFrame([("2024",), ("2024-01-01",), ("2024-01-01T00:00:00Z",)], "s string")
    assert [r.t is None for r in df.select(iso_instant(F.col("s")).alias("t")).collect()] == [True, False, False]


def _scorer(spark):
    w = spark.createDataFrame([("good", -1.0, 0.0, 2.0), ("bad", 2.0, 0.0, -1.0)], "term string, w0 double, w1 double, w2 double")
    return LinearScorer(w, [0.0, 0.1, 0.0])


def test_rows_without_an_id_keep_their_own_label(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, "good day").otherwise("bad day").alias("text")).repartition(7)
    out = label_table(df, _scorer(spark))
    got = {(r.text, r.sentiment): r["count"] for r in out.groupBy("text", "sentiment").count().collect()}
    assert len(got) == 2 and set(got.values()) == {1000}


def test_csv_headers(spark, tmp_folder):
    src, dst = os.path.join(tmp_folder, "a.csv"), os.path.join(tmp_folder, "out")
    with open(src, "w") as f:
        f.write("user.name,Text\nann,good day\nbob,bad day\n")
    assert read_csv(spark, f"file://{src}").columns == ["user.name", "text", "_row"]
    out = label_csv(spark, f"file://{src}", f"file://{dst}", _scorer(spark), text_col="Text")
    assert out.columns == ["user.name", "Text", "sentiment", "confidence"]


def test_two_classes(spark):
    rows = [(f"good fine day {i % 3}", 2) for i in range(12)] + [(f"bad awful day {i % 3}", 0) for i in range(12)]
    df = spark.createDataFrame(rows, "text string, label_id int")
    model = fit_baseline(df, max_iter=30)
    out = model(df.select(F.monotonically_increasing_id().alias("_rid"), F.col("text").alias("_text"))).collect()
    assert {r.label for r in out} <= set(model.labels) and all(r.confidence is not None for r in out)


def test_repeated_posts_keep_their_own_labels(spark):
    from textlens.operators.labeler import label_posts
    post = ("struct<platform_post_id: string, content: string, sentiment: string, sentiment_score: double, model_version: string, "
            "comments: array<struct<content: string, sentiment: string, sentiment_score: double, model_version: string>>>")

    def row(text):
        return ("x", ("p1", text, None, None, None, [("good", None, None, None)]))
    alone = label_posts(spark.createDataFrame([row("good day")], f"platform string, post {post}"), _scorer(spark)).first()
    df = spark.createDataFrame([row("good day"), row("bad bad bad day"), row("good day")], f"platform string, post {post}")
    got = {}
    for r in label_posts(df.repartition(3), _scorer(spark)).collect():
        got.setdefault(r.post.content, set()).add((r.post.sentiment, round(r.post.sentiment_score, 9)))
    assert got["good day"] == {(alone.post.sentiment, round(alone.post.sentiment_score, 9))}
    assert len(got["bad bad bad day"]) == 1 and got["bad bad bad day"] != got["good day"]
