"""Vectors, URLs, registered oracles and the pipeline."""

import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from oracle_check import check
from textlens.llm import queries, subspace, url_lm

SF = "/root/testdata/sf0.001"


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(subspace, "CHUNK", 40)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 20))
    rows = [(i, base[i].tolist(), i % 2) for i in range(60)]
    for k in range(90):  # a hot group of near copies, some close to the bar
        x = base[0] + rng.standard_normal(20) * 0.03 * (k % 9)
        rows.append((100 + k, (x * (1 + k)).tolist(), 0))
    rows += [(300 + k, base[1].tolist(), 1) for k in range(5)] + [(400, None, 1), (401, [0.0] * 20, 1), (402, base[1].tolist(), None),
             (403, [float("nan")] + [1.0] * 19, 1), (404, [float("inf")] + [1.0] * 19, 1), (405, [], 1), (406, [1.0, 2.0], 1),
             (407, [None] + [1.0] * 19, 1), (None, base[1].tolist(), 1), (300, base[1].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    good = {}
    for i, v, lab in rows:
        ok = i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if i is not None:
            good[i] = (np.array(v) / np.linalg.norm(v), lab) if ok else None
    links = defaultdict(set)
    ids = [i for i in good if good[i] is not None]
    for a in ids:
        for b in ids:
            if a != b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] >= 0.93:
                links[a].add(b)

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(seen)

    got = subspace.near_duplicates(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert r.n_links == 0 and r.component_id is None
        else:
            assert (r.n_links, r.component_id, r.kept) == (len(links[r.vec_id]), reach(r.vec_id), reach(r.vec_id) == r.vec_id), r
    assert subspace.near_duplicates(df.limit(0)).count() == 0


URLS = [None, "", "no scheme", "http://", "http://NET/", "http://a.net", "http://a.net/x?y#z", "https://www.example.net/en/1",
        "http://example.net/en", "http://xexample.net/en/1", "http://b.example.com/de/9.html", "http://b.example.com/en/9",
        "http://c.org/fr/1", "http://c.org/de/1", "http://q.org?x=/fr/", "ftp://a://b/c", "http://é.org/fr/ü"]


def _oracle(url):
    at = (url or "").find("://")
    rest = (url or "")[at + 3:] if at >= 0 else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for verdict, rule in url_lm.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def _model_score(urls, order):
    """Interpolated Witten-Bell by the book."""
    import re
    import zlib
    forms = {}
    for u in urls:
        host, path, best = _oracle(u)
        lower = "".join(c.lower() if c.isascii() else c for c in path)
        form = "\x02" * order + re.sub("[0-9]", "0", host + lower) + "\x03"
        forms.setdefault(form, Counter())[best[1] if best else None] += 1
    counts = {v: [defaultdict(Counter) for _ in range(order + 1)] for v in ("allow", "block")}
    for form, by in forms.items():
        if zlib.crc32(form.encode()) % 5:
            for v in counts:
                for i in range(order, len(form)):
                    for k in range(order + 1):
                        if by[v]:
                            counts[v][k][form[i - k:i]][form[i]] += by[v]

    def prob(v, h, c, k):
        p = prob(v, h[1:], c, k - 1) if k else 1 / url_lm.ALPHABET
        seen = counts[v][k][h]
        n = sum(seen.values())
        return (seen[c] + len(seen) * p) / (n + len(seen)) if n else p

    return {f: sum(math.log(prob("allow", f[i - order:i], f[i], order) / prob("block", f[i - order:i], f[i], order))
                   for i in range(order, len(f))) / (len(f) - order) for f in forms}


def test_url_rules_and_model(spark):
    rng = random.Random(1)
    urls = URLS + [f"http://{rng.choice('abc')}.example.{rng.choice(['net', 'org', 'com'])}/{rng.choice(['en', 'fr', 'de'])}/{rng.randrange(99)}"
                   for _ in range(60)]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x"), (None, urls[7], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, score string")
    got = url_lm.judge(df, order=2).collect()
    scores = _model_score([r[1] for r in rows], 2)
    assert len(got) == len(rows)
    want = Counter()
    bar = got[0].threshold
    for i, u, _ in rows:
        host, path, best = _oracle(u)
        form = "\x02\x02" + __import__("re").sub("[0-9]", "0", host + "".join(c.lower() if c.isascii() else c for c in path)) + "\x03"
        verdict = best[1] if best else ("allow" if scores[form] >= bar - 1e-12 else "block")
        want[(i, host, path, best and best[0], verdict, round(scores[form], 9))] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.score, 9)) for r in got) == want
    assert url_lm.judge(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_oracles(spark, name):
    res = check(spark, SF, [name])[name]
    assert res["cols_ok"] and res["hash_ok"], res


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_pipeline(spark):
    """Each stage against its operator's own result, and the last one's shape."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    scored = {r.doc_id: r.predicted for r in queries.op8_quality(spark, SF).collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        left = [r.doc_id for r in out.select("doc_id").collect()]
        if name != "shard":
            assert out.columns == docs.columns and len(left) == len(set(left)) and set(left) <= ids, name
        if name == "quality":
            assert set(left) == {i for i in ids if scored[i]}
        if name == "decontaminate":
            held = {r.doc_id for r in queries.contain.contained(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(left) == ids - held
        if name == "shard":
            assert set(left) == ids
        ids, docs = set(left), out
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "shard"]


CLASHES = ("_quality", "_id", "_key", "_cell", "topic", "tokens", "p", "kept", "score", "text_key", "node", "rows", "a.b", "component_id", "row")


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Documents with repeated ids and rows, nulls and clashing columns, and the tables that stages read."""
    rng = random.Random(4)
    base = [f"b{rng.randrange(9999)}" for _ in range(90)]
    near, item = " ".join(["new", *base[1:]]), " ".join(f"item{i}" for i in range(20))
    base = " ".join(base)
    good, bad = [" ".join(rng.choice(w) for _ in range(30)) for w in (["alpha", "beta", "gamma"], ["BUY!!", "NOW!!", "WIN!!"])]
    rows = [(1, base), (1, "clean text that shares the id of a group"), (2, near), (2, "another clean text under a used id"), (3, base), (3, base),
            (4, near), (None, base), (None, "x " + item), (5, None), (5, None), (6, ""), (7, good), (7, good), (8, bad), (8, good + " more"),
            (9, item + " tail"), (9, "no item at all here"), (10, "a " * 5000)]
    folder = str(tmp_path_factory.mktemp("odd"))
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    docs = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), *[f"{c} {n}" for c in CLASHES])
            for n, (i, t) in enumerate(rows)]
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1), (7, 1), (8, 0), (None, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs


def test_stages_on_odd_tables(spark, odd_tables):
    folder, rows = odd_tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    empty = docs.limit(0)

    def stage(name, df=docs):
        out = dict(corpus_pipeline.STAGES)[name](spark, df, folder)
        assert name == "shard" or out.columns == df.columns
        return Counter(tuple(r) for r in out.collect())
    for name, _ in corpus_pipeline.STAGES:
        assert not stage(name, empty), name
    whole = Counter(rows)
    model = queries.quality_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r.text: r.s for r in queries.nbsvm.score(docs.select("text"), model, out_col="s").collect()}
    assert stage("quality") == Counter(r for r in rows if scores[r[1]] >= 0.3)
    assert stage("decontaminate") == Counter(r for r in rows if "item0 item1 " not in (r[1] or ""))

    # near copies: one group is of ids 1 to 4, one of 7 and 8; repeated texts of one id count once
    left = stage("near_duplicates")
    assert not left - whole
    base, near, good = rows[0][1], rows[2][1], rows[12][1]
    kept = Counter((r[0], r[1]) for r in left.elements())
    want = Counter((r[0], r[1]) for r in rows if not (r[0] is not None and r[1] in (base, near)))
    want[(7, good)] = 1
    del want[(8, good + " more")]
    want[(1, base)] = 1
    assert kept == want

    kept = stage("mix")
    assert not kept - whole and kept
    p = {}
    for r in queries.mixing.mix(docs.select("doc_id", "text", "lang", "source")).collect():
        p[(r.doc_id, r.text, r.lang, r.source)] = r.kept
    assert kept == Counter(r for r in rows if p[r[:4]])
    assert sum(stage("shard").values()) == len(rows)
