"""Scorers that run in a projection, the hashed model, the baseline's steps, and stored models and splits."""

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_check import check
from textlens.functions.text import N_SLOTS
from textlens.operators import evaluate as ev
from textlens.operators import scoring as sco
from textlens.operators.baseline import fit_baseline, momenta
from textlens.operators.labeler import label_posts
from textlens.session import scratch_path

SF = "/root/testdata/sf0.001"
LABELS = ("Positive", "Neutral", "Negative")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_model_is_loaded_once_per_task_and_asked_by_length(spark):
    from pyspark.accumulators import AccumulatorParam

    class Lists(AccumulatorParam):
        def zero(self, value):
            return []

        def addInPlace(self, a, b):
            return a + b
    loads, asked = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator([], Lists())

    def load():
        loads.add(1)
        return 3

    def predict(classes, texts):                                # knows the length of a text
        size = np.array([len(t) for t in texts.to_pylist()])
        asked.add([(len(size), size.min(), size.max())])
        return np.stack([size % classes == k for k in range(classes)], 1) * 0.7 + 0.1
    scorer = sco.IteratorScorer(load, predict, LABELS, batch=10)
    rows = [(i, None if i == 7 else "ab " * (i * 37 % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    out = df.select("id", "text", scorer.column(F.col("text")).alias("s"))
    assert "Exchange" not in plan(out).split("ArrowEvalPython")[0]
    for r in out.collect():
        assert r.s.label == (None if r.text is None else LABELS[len(r.text) % 3])
        assert r.s.confidence == (None if r.text is None else pytest.approx(0.8))
    assert loads.value == df.rdd.getNumPartitions() == 3
    calls = asked.value
    assert sum(n for n, _, _ in calls) == 399 and max(n for n, _, _ in calls) == 10
    # a batch holds neighbours by length, so its spread is a small part of the whole
    assert np.mean([hi - lo for _, lo, hi in calls]) < 40


def test_lists_of_texts_are_scored_in_place(spark):
    scorer = sco.IteratorScorer(lambda: None, lambda m, t: np.eye(3)[[len(x) % 3 for x in t.to_pylist()]], LABELS)
    df = spark.createDataFrame([(1, ["a", "", "abcd"]), (2, []), (3, None), (4, ["xx", None])], "id long, t array<string>")
    got = {r.id: [x.label for x in r.s] for r in df.select("id", scorer.columns(F.col("t")).alias("s")).collect()}
    assert got == {1: ["Neutral", "Positive", "Neutral"], 2: [], 3: [], 4: ["Negative", None]}


def weights(spark):
    rows = [(f"w{i}", float(np.sin(i)), float(np.cos(i)), float(np.sin(3 * i))) for i in range(40)]
    return spark.createDataFrame(rows, "term string, w0 double, w1 double, w2 double")


def some_texts(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 60, rng.integers(0, 9)))) for i in range(200)] + [(200, None), (201, "")]
    return spark.createDataFrame(rows, "id long, text string")


def test_terms_in_a_projection_score_like_the_join(spark, monkeypatch):
    df = some_texts(spark)
    slow = sco.LinearScorer(weights(spark), [0.1, 0.0, -0.1])
    fast = sco.linear_scorer(weights(spark), [0.1, 0.0, -0.1])
    assert isinstance(fast, sco.IteratorScorer)
    a, b = ({r.id: (r.label, round(r.confidence, 9)) for r in sco.score(df, s, "text", "id").collect()} for s in (slow, fast))
    assert a == b and len(a) == 202
    assert "Exchange" not in plan(sco.score(df, fast, "text", "id"))
    monkeypatch.setattr(sco, "MAX_TERMS", 39)                   # too many terms for a task: the join
    assert isinstance(sco.linear_scorer(weights(spark), [0.1, 0.0, -0.1]), sco.LinearScorer)
    empty = sco.linear_scorer(weights(spark).limit(0), [0.0, 1.0, 0.0])
    assert {r.label for r in sco.score(df, empty, "text", "id").collect()} <= {"Neutral"}


def test_posts_are_labelled_alike_by_both_kinds(spark):
    post = ("struct<platform_post_id: string, content: string, sentiment: string, sentiment_score: double, model_version: string, "
            "comments: array<struct<content: string, sentiment: string, sentiment_score: double, model_version: string>>>")
    rng = np.random.default_rng(1)

    def text():
        return " ".join(f"w{x}" for x in rng.integers(0, 50, 4))
    rows = [("x", (f"p{i}", text(), None, None, None, [(text() if j else None, None, None, None) for j in range(i % 4)])) for i in range(40)]
    df = spark.createDataFrame(rows, f"platform string, post {post}").repartition(3)
    by = [{r.post.platform_post_id: (r.post.sentiment, round(r.post.sentiment_score, 9),
                                     [(c.sentiment, round(c.sentiment_score, 9), c.model_version) for c in r.post.comments])
           for r in label_posts(df, s, "v9").collect()}
          for s in (sco.LinearScorer(weights(spark), [0.0, 0.0, 0.0]), sco.linear_scorer(weights(spark), [0.0, 0.0, 0.0]))]
    assert by[0] == by[1] and len(by[0]) == 40


# --- the baseline -------------------------------------------------------------

def brute_fit(rows, steps):
    """Dense numpy steps on exact terms (no two of the few terms share a slot)."""
    grams = [t.split() + [" ".join(p) for p in zip(t.split(), t.split()[1:])] for t, _ in rows]
    terms = sorted({g for gs in grams for g in gs})
    tf = np.array([[gs.count(t) for t in terms] for gs in grams], float)
    df = (tf > 0).sum(0)
    keep = df >= 2
    x = (np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) * (np.log((1 + len(rows)) / (1 + df)) + 1))[:, keep]
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)
    y = np.eye(3)[[lab for _, lab in rows]]
    n, count = len(rows), y.sum(0)
    cw = (y * (n / ((count > 0).sum() * np.maximum(count, 1)))).sum(1, keepdims=True)
    w = v = np.zeros((x.shape[1], 3))
    b = c = np.zeros(3)
    for f in momenta(steps):
        p = np.exp(x @ v + c)
        e = cw * (p / p.sum(1, keepdims=True) - y)
        nw, nb = v - (x.T @ e + v) / n / (1 + 1 / n), c - e.sum(0) / n / (1 + 1 / n)
        v, c, w, b = nw + f * (nw - w), nb + f * (nb - b), nw, nb
    p = np.exp(x @ w + b)
    return p / p.sum(1, keepdims=True), w, b, x, cw, y


def test_steps_equal_dense_ones_and_reach_the_optimum(spark):
    rng = np.random.default_rng(4)
    rows = [(" ".join(f"t{x}" for x in rng.integers(3 * lab, 3 * lab + 6, rng.integers(0, 7))), lab)
            for lab in rng.integers(0, 3, 60).tolist()]
    df = spark.createDataFrame([(i, t, lab) for i, (t, lab) in enumerate(rows)] + [(999, "t1 t2", None), (998, None, 0), (997, "t1", 7)],
                               "id long, text string, label_id int").repartition(4)
    known = rows + [("", 0)]
    p, w, b, x, cw, y = brute_fit(known, 40)
    model = fit_baseline(df, max_iter=40)
    got = {r.id: (r.label, r.confidence) for r in sco.score(df, model, "text", "id").collect()}
    for i, (t, _) in enumerate(rows):
        assert got[i] == (LABELS[p[i].argmax()], pytest.approx(p[i].max(), abs=1e-9))
    assert model.intercepts == pytest.approx(b, abs=1e-9)
    # a long dense run has a vanishing gradient: the steps minimise the objective
    p, w, b, x, cw, y = brute_fit(known, 3000)
    assert np.abs(x.T @ (cw * (p - y)) + w).max() < 1e-6
    none = fit_baseline(df.limit(0), max_iter=2)
    assert none.weights.shape == (N_SLOTS, 3) and not none.weights.any()


def test_model_and_split_are_stored_and_checked(spark):
    rows = [(i, f"{('good', 'plain', 'awful')[i % 3]} thing number {i % 5}", i % 3, "val" if i % 5 == 0 else "train") for i in range(90)]
    split = spark.createDataFrame(rows, "row_id long, text string, label_id int, split string").repartition(3)
    model = fit_baseline(split.filter("split = 'train'"), max_iter=20)
    where, there = scratch_path(spark, "split"), scratch_path(spark, "model")
    model.trained_on = ev.save_split(split, where)
    model.save(spark, there)
    back = sco.HashedModel.load(spark, there)
    assert (back.weights == model.weights).all() and (back.idf == model.idf).all() and (back.intercepts == model.intercepts).all()
    assert (back.labels, back.version, back.trained_on) == (model.labels, model.version, model.trained_on)
    report = {r.label: r for r in ev.evaluate_stored(spark, there, where)["classification_report"].collect()}
    assert report["accuracy"].f1 == 1.0 and report["accuracy"].support == 18
    # another split, a changed split, a damaged model
    other = scratch_path(spark, "split")
    ev.save_split(split.withColumn("split", F.lit("val")), other)
    with pytest.raises(ValueError, match="another split"):
        ev.evaluate_stored(spark, there, other)
    split.limit(1).select("row_id", "text", "label_id", "split").write.mode("append").parquet(f"{where}/rows")
    with pytest.raises(ValueError, match="90 rows"):
        ev.evaluate_stored(spark, there, where)
    spark.createDataFrame([(3, 1.0, 1.0, 1.0, 1.0)], "slot int, w0 double, w1 double, w2 double, idf double").write.mode("append").parquet(f"{there}/weights")
    with pytest.raises(ValueError, match="weights"):
        sco.HashedModel.load(spark, there)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", ["score_projection", "score_hashed", "evaluate_stored", "baseline_scores"])
def test_oracles(spark, name):
    res = check(spark, SF, [name])[name]
    assert res["cols_ok"] and res["hash_ok"], res


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_no_token_leaves_its_row(spark):
    p = plan(E.queries()["score_projection"](spark, SF))
    assert "Generate" not in p and "Join" not in p and p.count("Exchange") == 1      # the texts, dealt by id


def test_ranks_count_rows_in_order(spark):
    from textlens.operators.rank import with_rank
    rng = np.random.default_rng(2)
    rows = [(int(i), float(x)) for i, x in enumerate(rng.integers(0, 20, 500) / 4)]
    df = spark.createDataFrame(rows, "id long, x double").repartition(6)
    got = sorted((r["rank"], r.x, r.id) for r in with_rank(df, [F.desc("x"), F.asc("id")]).collect())
    assert [(x, i) for _, x, i in got] == sorted(((x, i) for i, x in rows), key=lambda r: (-r[0], r[1]))
    assert [n for n, _, _ in got] == list(range(1, 501))
    assert with_rank(df.limit(0), [F.asc("x")]).count() == 0


def test_words_are_hashed_once_a_batch(spark, monkeypatch):
    """The task's slots are those of ``hashed_slots``; a repeated word is hashed once."""
    texts = ["good good bad", "", "bad é 漢字 good", "good"]
    lists = [t.split() for t in texts]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id long, t array<string>")
    want = [r.s for r in df.select("id", F.sort_array(sco.hashed_slots("t")).alias("s")).orderBy("id").collect()]
    asked, md5 = [], sco.hashlib.md5
    monkeypatch.setattr(sco.hashlib, "md5", lambda w: asked.append(w) or md5(w))
    got = sco.slots_of(pa.array([[], *lists], pa.list_(pa.string())).slice(1)).to_pylist()
    assert [sorted(x) for x in got] == want and len(asked) == 4
    assert sco.slots_of(pa.array([[]], pa.list_(pa.string()))).to_pylist() == [[]]
