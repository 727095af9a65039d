"""C1-C6 against hand-made rows (FIXTURES §4) and Python's own regex semantics."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textlens.functions.text import capitalize, clean_text, near_dup_form, word_count


def py_clean(s: str) -> str:
    s = re.sub(r"https?://\S+", "", s)
    s = re.sub(r"@\w+", "", s)
    s = re.sub(r"\s+", " ", s)
    return s.strip()


def run(spark, rows, expr):
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_clean_edge_rows(spark):
    rows = ["RT @müller_1 lihat https://t.co/abc bagus sekali  @a@b x",
            "HTTP://x.y tetap", "surel a@b.com", "http://t.co/a"]
    assert run(spark, rows, clean_text) == ["RT lihat bagus sekali x", "HTTP://x.y tetap",
                                            "surel a.com", ""]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab @_:/.hpst  \n\tüé1")), max_size=40),
                min_size=200, max_size=200))
def test_clean_matches_python(spark, texts):
    assert run(spark, texts, clean_text) == [py_clean(t) for t in texts]


def test_capitalize_and_words(spark):
    assert run(spark, ["nEGATIVE", "", "positive x"], capitalize) == ["Negative", "", "Positive x"]
    assert run(spark, ["", "a", "a b c d"], word_count) == [0, 1, 4]


def test_near_dup_form(spark):
    assert run(spark, ["Héllo, World!! #tag  x"], near_dup_form) == ["h llo world #tag x"]


def test_clean_is_not_always_idempotent(spark):
    once = run(spark, ["http@a://x rest"], clean_text)
    assert once == ["http://x rest"]
    assert run(spark, once, clean_text) == ["rest"]
