"""Top-k search, hard negatives and the filter audit against brute force, with odd rows."""

import math
import random
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oracle_check import check
from textlens.llm import filter_audit, hardneg, topk
from textlens.llm.vectors import widened

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_topk_search", "op12_hard_negatives", "op13_filter_audit"])
def test_oracles_of_the_search_queries(spark, name):
    res = check(spark, SF, [name])[name]
    assert res["cols_ok"] and res["hash_ok"] and res["rows"] > 0, res


def odd_vectors(seed):
    """Clusters, ties, copies, a hot label, other lengths, zeros, and rows that take no part."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((6, 12)) / 4
    rows = [(i, (base[i % 6] + rng.standard_normal(12) / (4 if i % 3 else 40)).tolist(), "hot" if i % 3 else f"l{i % 4}") for i in range(300)]
    rows += [(1000 + i, base[0].tolist(), "hot") for i in range(40)] + [(2000, [0.0] * 12, "hot"), (2050, [], "hot"), (2100, [0.5], "l1"),
             (2150, base[1].tolist() + [1.0, -1.0], "l1"), (2200, [1e300] * 12, "l2"), (2201, [-1e300] * 12, "hot"),
             (2250, None, "hot"), (2251, [None] + [0.1] * 11, "hot"), (2252, [float("nan")] * 12, "hot"), (2253, [float("inf")] * 12, "hot"),
             (2300, base[2].tolist(), None), (None, base[2].tolist(), "hot"), (50, base[3].tolist(), "zz"), (51, rows[51][1], rows[51][2]),
             (-50, (-base[0]).tolist(), "hot"), (2350, base[4].tolist(), "alone")]
    return rows


def brute_rows(rows, bits, labelled):
    out = {}
    for i, v, lab in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (labelled and lab is None):
            continue
        bound = math.floor(math.sqrt(2.0 ** bits / max(len(v), 1)))
        got = ((lab if labelled else ""), [math.floor(max(min(x * 256, bound), -bound)) for x in v])
        out[i] = min(out.get(i, got), got)
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(5)
    return df.withColumns({"v": F.lit("x"), "rank": F.lit(1), "cb": F.lit(2), "score": F.lit(3), "home": F.lit(4)})


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 70)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = odd_vectors(1)
    good = brute_rows(rows, 62, False)
    want = set()
    for q in good:
        if q % 50 == 0:
            best = sorted((-dot(good[q][1], good[c][1]), c) for c in good if c != q)[:5]
            want |= {(q, r, c, -s) for r, (s, c) in enumerate(best, 1)}
    got = topk.search(frame(spark, rows))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.search(frame(spark, rows).limit(0)).count() == 0
    alone = frame(spark, [(0, [1.0], "x")])
    assert topk.search(alone).count() == 0
    few = topk.search(frame(spark, [(0, [1.0], "x"), (1, [0.5], "x"), (2, [1.0, 3.0], "x")]), k=9).collect()
    assert sorted(map(tuple, few)) == [(0, 1, 2, 65536), (0, 2, 1, 32768)]


def test_best_takes_ties_by_place():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 4, 50):
        for k in (1, 3, 60):
            for own in (-1, 0, n - 1):
                s = rnd.integers(-2, 3, n)
                want = sorted((-x, i) for i, x in enumerate(s) if i != own or n == 0)[:k]
                assert [i for _, i in want] == topk.best(s, k, own if n else -1).tolist()


def brute_negatives(rows):
    good = brute_rows(rows, 52, True)
    want = set()
    for a in good:
        if a % 50:
            continue
        lab, v = good[a]
        pos = sorted((-dot(v, good[c][1]), c) for c in good if c != a and good[c][0] == lab)[:5]
        for s, p in pos:
            neg = sorted((-dot(v, good[c][1]), c) for c in good if good[c][0] != lab
                         and 50 * -s <= 100 * dot(v, good[c][1]) <= 95 * -s)[:3]
            want |= {(a, p, r, c, -s, -n) for r, (n, c) in enumerate(neg, 1)}
    return want


@pytest.mark.parametrize("block", [7, 512])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hardneg, "BLOCK", block)
    monkeypatch.setattr(hardneg, "ZONES", 9)
    monkeypatch.setattr(hardneg, "ANCHORS", 3)
    rows = odd_vectors(2)
    got = hardneg.mine(frame(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows)
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == sorted(want)
    assert hardneg.mine(frame(spark, rows).limit(0)).count() == 0


def test_blocks_of_long_vectors_stay_small(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "NUMBERS", 100)
    rows = odd_vectors(4)
    assert sorted(map(tuple, hardneg.mine(frame(spark, rows)).collect())) == sorted(brute_negatives(rows))


def test_hilbert_curve_moves_one_step_at_a_time():
    for axes, order in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << order)] * axes, indexing="ij"), -1).reshape(-1, axes)
        place = hardneg.hilbert(cells, order)
        assert sorted(place) == list(range(len(cells)))
        along = cells[np.argsort(place)]
        assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(5)
    a = rng.integers(-9, 9, (20, 6)).astype(float)
    x = rng.integers(-9, 9, (30, 10, 6)).astype(float)
    least, most = hardneg.bounds(a, x.min(1), x.max(1))
    scores = np.einsum("ad,bnd->abn", a, x)
    assert (least[..., None] <= scores).all() and (scores <= most[..., None]).all()


def test_zone_maps_spare_most_blocks(spark):
    """Clusters on orthogonal axes: the bounds leave an anchor about half of the blocks at most."""
    rng = np.random.default_rng(6)
    centres = np.eye(16)
    rows = [(i, (centres[i % 16] + rng.standard_normal(16) * 0.01).tolist(), str(i % 2)) for i in range(1600)]
    table = hardneg.one_per_id(frame(spark, rows), id_col="vec_id", vector_col="embedding", label_col="label", bits=52)
    blocks = [r.asDict() for r in hardneg.blocks(table, F.col("vec_id") % 50 == 0).collect()]
    low, high = (np.stack([np.frombuffer(b[c]) for b in blocks]) for c in ("low", "high"))
    a = np.floor(256 * np.array([v for i, v, _ in rows if i % 50 == 0]))
    least, most = hardneg.bounds(a, low, high)
    seen = (most >= 0.5 * 256 * 256).mean()
    assert len(blocks) >= 4 and seen < 0.6, (len(blocks), seen)


# --- filter audit ----------------------------------------------------------------

def test_galloping():
    rnd = random.Random(7)
    for _ in range(200):
        a = np.array(sorted(rnd.sample(range(-50, 400), rnd.randrange(0, 120))), np.int64)
        b = np.array(sorted(rnd.sample(range(-80, 500), rnd.randrange(0, 60))), np.int64)
        assert filter_audit.gallop(a, b).tolist() == np.searchsorted(a, b).tolist()
        assert filter_audit.union([a, b, a[::2]]).tolist() == sorted(set(a) | set(b))
        assert filter_audit.difference(a, [b, b[::3]]).tolist() == sorted(set(a) - set(b))


def brute_audit(docs, labels):
    docs = {(i, p or "", t or "") for i, t, p in docs}
    first = {}
    for i, p, t in docs:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for i, p, t in docs:
        w = [x for x in t.translate({c: " " for c in range(9, 14)}).split(" ") if x]
        caps = sum("A" <= c <= "Z" for c in t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * caps > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        parts[p].append((i, {f for f, x in fails.items() if x}))
    out = set()
    for p, rows in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        got = []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                got.append((p, "".join(order), step, len(left), len(gone), sum(f in x for _, x in rows) - len(gone),
                            sum(x == {f} for _, x in rows), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f))
        out |= {(*g[:-1], shapley[g[-1]]) for g in got}
    return out


@pytest.mark.parametrize("size", [5, 1 << 16])
def test_filter_audit(spark, monkeypatch, size):
    monkeypatch.setattr(filter_audit, "RANGE", size)
    monkeypatch.setattr(filter_audit, "PARTS", 2)
    rnd = random.Random(8)
    texts = ["", " \t\x0b", "One", "a b c $", " ".join(f"w{i}" for i in range(100)), " ".join(f"W{i}" for i in range(99)),
             "x " * 120, "UP " * 200, "é" * 9 + "A", "é" * 10 + "A", " ".join(f"w{i % 80}" for i in range(100)),
             " ".join(f"w{i % 79}" for i in range(100)) + " |", "long " * 30000, None]
    docs = [(i, rnd.choice(texts), rnd.choice(["en", "de", None, "", "fr"])) for i in range(-5, 250)]
    docs += [(None, "One", "en"), (None, "One", "en"), (None, "UP " * 200, "de"), (7, "again $", "en"), (7, "again $", "en"), (7, "other", "de")]
    docs += [(300 + i, "hot text", "en") for i in range(80)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 320, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9, None, None), (9, 1, None), (9999, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3).withColumns(
        {"part": F.lit("x"), "list": F.lit(1), "h1": F.lit(2), "fails": F.lit(3), "first": F.lit(4)})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("y"))
    got = filter_audit.audit(df, lab)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = [tuple(r) for r in got.collect()]
    want = brute_audit(docs, labels)
    assert len(rows) == len(set(rows)) == 600 * 4
    assert sorted(rows) == sorted(want)
    assert filter_audit.audit(df.limit(0), lab).count() == 0
    assert {r.good_lost for r in filter_audit.audit(df, lab.limit(0)).collect()} == {0}


def test_blocks_of_a_search_are_never_broadcast(spark, monkeypatch):
    """Copies of packed blocks look small to Spark; a broadcast of them would fill the driver."""
    rng = np.random.default_rng(9)
    rows = [(i, (rng.standard_normal(12) / 4).tolist(), "x") for i in range(400)]
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "QUERIES", 2)
    plans, cut = [], topk.cut_lineage
    monkeypatch.setattr(topk, "cut_lineage", lambda df, name: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or cut(df, name))
    got = topk.search(frame(spark, rows))
    assert plans and not any("Broadcast" in p for p in plans) and any("SortMergeJoin" in p for p in plans)
    assert got.count() == 8 * 5


@pytest.mark.parametrize("dense, next_", [(1, 2), (4, 3), (50, 64)])
@pytest.mark.parametrize("size", [9, 1 << 12, 1 << 21, 1 << 28])
def test_scores_of_a_tile_are_exact(monkeypatch, dense, next_, size):
    """Terms that many and few candidates hold, weights beyond doubles, terms that no candidate holds."""
    monkeypatch.setattr(topk, "DENSE", dense)
    monkeypatch.setattr(topk, "NEXT", next_)
    monkeypatch.setattr(topk, "SCORES", 150)
    rng = np.random.default_rng(10)
    some = lambda n, width: [[int(x) * (rng.random() < 0.2 + 0.7 * (i % 3 == 0)) for i, x in enumerate(rng.integers(-size, size, width))] for _ in range(n)]
    c, q = some(40, 9), some(12, 11)
    table = lambda ids, v, key: pa.table({"vec_id": pa.array(ids, pa.int64()), "v": pa.array(v, pa.list_(pa.int64())), key: pa.array([0] * len(v), pa.int32())})
    lists, rows = topk._inverted(table(range(5, 45), c, "cb")), topk._sparse_rows(table(range(12), q, "qb"))
    tile = [widened(t[k][0]) for t in (lists, rows) for k in ("ids", "starts", "others", "weights")]
    got = {(int(a), int(b), int(s)) for x in topk._tile(*tile, 3) for a, b, s in zip(*x)}
    want = set()
    for i in range(12):
        best = sorted((-dot(q[i], c[j]), 5 + j) for j in range(40) if 5 + j != i)[:3]
        want |= {(i, j, -s) for s, j in best}
    assert got == want


def test_tiles_of_hard_negatives_are_sent_once(spark, monkeypatch):
    """No vector is copied for a block that an anchor reads, nothing is broadcast, and Python gets a row at a time."""
    monkeypatch.setattr(hardneg, "BLOCK", 16)
    monkeypatch.setattr(hardneg, "ZONES", 4)
    rng = np.random.default_rng(11)
    rows = [(i, rng.standard_normal(12).tolist(), str(i % 3)) for i in range(2000)]
    made, plans, cut = {}, [], hardneg.cut_lineage

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        made.setdefault(name, []).append((cut(df, name), df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return made[name][-1][0]

    monkeypatch.setattr(hardneg, "cut_lineage", seen)
    assert hardneg.mine(frame(spark, rows)).count() > 100
    assert not any("Broadcast" in p for p in plans if "a_v" in p and "MapInArrow" in p)
    assert {c for name in ("tiles", "near", "chosen", "best") for _, c in made[name]} == {"1"}
    chosen, tiles = made["chosen"][0][0], made["tiles"][0][0]
    assert chosen.columns == ["a", "z"] and chosen.count() <= tiles.count() * made["anchors"][0][0].select("a").distinct().count()
    assert tiles.selectExpr("max(size(blocks))").first()[0] == 4 and tiles.selectExpr("sum(size(blocks))").first()[0] >= 125
