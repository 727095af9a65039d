"""Exact top-k search by term-at-a-time accumulation (operator 11).

A vector is a sparse row: its terms are the numbers of its components, its
weights the components as whole numbers, zeros left out.  Candidates are dealt
into blocks by a hash of their id; a block is an inverted file: the posting
list (candidate, weight) of every term.  Queries are dealt into blocks of
sparse rows.  Each pair of a candidate block and a query block is one tile.  In
a tile, scores are added up term by term in a dense array: a term that at least
one candidate in ``DENSE`` holds has its list laid out as a row, and a group of queries
takes all such rows by one matrix product (in floats or doubles, where these hold
every sum exactly); the others are scattered one after the other, weight times
posting weights.  The k best of the array are selected by partition.  Spark
merges the bests of all tiles by query, cut to k per query on both sides of the
shuffle.

Nothing is pruned: every query meets every candidate, once.  Work is queries
times candidates; what a task holds is one tile (``BLOCK`` candidates, ``QUERIES``
queries, ``POSTINGS`` weights of each, all at most and on average) and ``SCORES``
scores, whatever the input.  Query blocks are copied to the candidate blocks, which
are sent once (a few times where there are fewer of them than cores), in the
narrowest whole numbers that hold them.  No block is ever broadcast: Spark judges
by the files of the blocks, which are far smaller than what they hold.

Defined results: vectors that are null or hold null or non-finite components,
and rows with a null id, take no part; an id with several rows counts with its
smallest vector; vectors of other lengths are compared as if the missing
components were zero (an empty vector scores 0 with all); whole
numbers are held within 2 ** 31 / sqrt(length), so that a score always fits 64 bits; ties go to the smaller id; a query without any
candidate gives no row; an empty table gives an empty result; other columns do
not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage
from textlens.llm.vectors import narrow, one_per_id, widened
from textlens.session import one_row_batches

#: Rows of a candidate block, weights of a block, rows of a query block (on average).
BLOCK, POSTINGS, QUERIES = 32768, 1 << 21, 8192
#: Candidates that share a block at least, on average, where there are fewer blocks than cores.
SPREAD = 4096
#: One candidate in so many holds a dense term; scores that a task holds; neighbours whose best is looked at first.
DENSE, SCORES, NEXT = 4, 1 << 22, 64

_PACKED = "ids binary, starts binary, others binary, weights binary"


def _nonzero(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids in ascending order and (row, term, weight) of every component but zeros, in order of rows."""
    table = table.combine_chunks().sort_by("vec_id")
    ids = table["vec_id"].to_numpy()
    v = table["v"].combine_chunks()
    ends = v.offsets.to_numpy().astype(np.int64)
    weight = v.values.to_numpy(zero_copy_only=False).astype(np.int64)[ends[0]:ends[-1]]
    size = np.diff(ends)
    row = np.repeat(np.arange(len(ids)), size)
    term = np.arange(len(weight)) - np.repeat(ends[:-1] - ends[0], size)
    some = weight != 0
    return ids, row[some], term[some], weight[some]


def _packed(key: dict, ids: np.ndarray, by: np.ndarray, n: int, others: np.ndarray, weights: np.ndarray) -> pa.Table:
    starts = np.searchsorted(by, np.arange(n + 1))
    cols = {"ids": ids, "starts": starts, "others": others, "weights": weights}
    return pa.table({**{k: pa.array([x], pa.int32()) for k, x in key.items()},
                     **{k: pa.array([narrow(x)], pa.binary()) for k, x in cols.items()}})


def _inverted(table: pa.Table) -> pa.Table:
    """One row: the posting lists of a candidate block."""
    ids, row, term, weight = _nonzero(table)
    order = np.argsort(term, kind="stable")
    term = term[order]
    return _packed({"cb": table["cb"][0].as_py()}, ids, term, int(term[-1]) + 1 if len(term) else 0, row[order], weight[order])


def _sparse_rows(table: pa.Table) -> pa.Table:
    """One row: the sparse rows of a query block."""
    ids, row, term, weight = _nonzero(table)
    return _packed({"qb": table["qb"][0].as_py()}, ids, row, len(ids), term, weight)


def best(scores: np.ndarray, k: int, without: int = -1) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller place; ``without`` is left out."""
    n, take = len(scores), k + (without >= 0)
    if n <= take:
        pick = np.arange(n)
    else:
        pick = np.flatnonzero(scores >= np.partition(scores, n - take)[n - take])
    pick = pick[pick != without]
    return pick[np.argsort(-scores[pick], kind="stable")[:k]]


def _bests(scores: np.ndarray, k: int, without: np.ndarray) -> Iterator[np.ndarray]:
    """``best`` of every row; the k-th best of the greatest of ``NEXT`` neighbours each is a bar that k scores reach."""
    n, parts = scores.shape[1], scores.shape[1] // NEXT
    if parts <= k + 1:
        yield from (best(s, k, w) for s, w in zip(scores, without))
        return
    top = scores[:, :parts * NEXT].reshape(len(scores), parts, NEXT).max(2)
    bar = np.partition(top, parts - k - 1, axis=1)[:, parts - k - 1]
    for s, least, w in zip(scores, bar, without):
        some = np.flatnonzero(s >= least)
        place = np.searchsorted(some, w) if w >= 0 else -1
        yield some[best(s[some], k, place if w >= 0 and place < len(some) and some[place] == w else -1)]


def _tile(ids, lists, rows, weights, q_ids, q_rows, q_terms, q_weights, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(query, candidate, score) of the k best of each query of a tile."""
    n, own = len(ids), np.searchsorted(ids, q_ids)
    own = np.where((own < n) & (ids[np.minimum(own, n - 1)] == q_ids), own, -1)
    held = np.diff(lists)
    q_row = np.repeat(np.arange(len(q_ids)), np.diff(q_rows))
    # floats hold the sums of products of rows of these lengths exactly, doubles longer ones
    square = lambda row, x, size: np.bincount(row, x.astype(np.float64) ** 2, size).max(initial=0)
    most = square(q_row, q_weights, len(q_ids)) * square(rows, weights, n)
    kind = np.float32 if most < 2.0 ** 46 else np.float64 if most < 2.0 ** 104 else np.int64
    dense = np.flatnonzero(held * DENSE >= n) if kind != np.int64 else np.zeros(0, np.int64)
    place = np.full(len(held) + 1, -1)                          # the last: terms that no candidate holds
    place[dense] = np.arange(len(dense))
    laid = np.zeros((len(dense), n), kind)
    for r, t in enumerate(dense):
        span = slice(lists[t], lists[t + 1])
        laid[r, rows[span]] = weights[span]
    q_terms = np.minimum(q_terms, len(held))
    at = place[q_terms]
    sparse = (at < 0) & (q_terms < len(held))
    step = max(SCORES // max(n, 1), 1)
    for a in range(0, len(q_ids), step):
        b = min(a + step, len(q_ids))
        x = np.zeros((b - a, len(dense)), kind)
        span = slice(q_rows[a], q_rows[b])
        some = at[span] >= 0
        x[q_row[span][some] - a, at[span][some]] = q_weights[span][some]
        scores = x @ laid
        for j in np.flatnonzero(sparse[span]) + q_rows[a]:
            listed = slice(lists[q_terms[j]], lists[q_terms[j] + 1])
            scores[q_row[j] - a, rows[listed]] += q_weights[j] * weights[listed]
        for q, pick in zip(range(a, b), _bests(scores, k, own[a:b])):
            yield np.full(len(pick), q_ids[q]), ids[pick], scores[q - a, pick].astype(np.int64)


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tile = [widened(batch[q + c][i]) for q in ("", "q_") for c in ("ids", "starts", "others", "weights")]
                cols = [np.concatenate(c) for c in zip(*_tile(*tile, k))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])
    return run


def search(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
           queries: Column | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query with the other rows.

    ``queries`` is a condition on ``vec_id``; the default takes ids divisible by 50.
    """
    asked = F.col("vec_id") % 50 == 0 if queries is None else queries
    rows = cut_lineage(one_per_id(vectors, id_col=id_col, vector_col=vector_col, bits=62), "vectors")
    size = F.size("v")
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("weights"), F.count_if(asked).alias("queries"),
                 F.coalesce(F.sum(F.when(asked, size)), F.lit(0)).alias("asked")).first()
    par = rows.sparkSession.sparkContext.defaultParallelism
    n_c = max(-(-n["rows"] // BLOCK), -(-n["weights"] // POSTINGS), min(2 * par, n["rows"] // SPREAD), 1)
    n_q = max(-(-n["queries"] // QUERIES), -(-n["asked"] // POSTINGS), 1)
    copies = min(-(-2 * par // n_c), n_q)
    block = lambda parts: F.pmod(F.xxhash64(F.lit(parts), "vec_id"), F.lit(parts)).cast("int")
    lists = rows.withColumn("cb", block(n_c)).groupBy("cb").applyInArrow(_inverted, f"cb int, {_PACKED}")
    sparse = rows.filter(asked).withColumn("qb", block(n_q)).groupBy("qb").applyInArrow(_sparse_rows, f"qb int, {_PACKED}")
    sparse = sparse.withColumnsRenamed({c: f"q_{c}" for c in ("ids", "starts", "others", "weights")})
    # every block is packed once; then candidate blocks are dealt out, and query blocks copied to each of them
    lists, sparse = cut_lineage(lists, "lists"), cut_lineage(sparse, "queries")
    lists = lists.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    sparse = sparse.withColumn("copy", F.col("qb") % copies).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    dealt = lambda x: x.repartition(min(n_c * copies, 4096), "cb", "copy")
    tiles = dealt(sparse).join(dealt(lists).hint("merge"), ["cb", "copy"])
    found = tiles.drop("cb", "qb", "copy").mapInArrow(_tiles(k), "query_id long, vec_id long, score long")
    ranked = found.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank",
                              "vec_id", "score")
    with one_row_batches(rows.sparkSession):
        return cut_lineage(ranked.filter(F.col("rank") <= k), "best")
