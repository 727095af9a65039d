"""Embedding near-dedup by subspace pigeonhole join (operator 3).

Unit vectors with cosine c are at squared distance 2 - 2c.  Vectors are
rotated (a fixed random rotation spreads what differs evenly) and cut into
blocks of ``BLOCK`` dimensions.  If all of the squared distance is at most T, some
block has at most its proportional share of T (pigeonhole), so the union of the
blocks' range joins holds every link.

A block's range join: its first coordinate is cut into cells of twice the
block's radius; a vector is at home in its cell and a guest in the cell before
if it lies within the radius of it.  Large cells are cut into chunks, and each
pair of chunks is one task (a tile).  In a tile numpy finds the pairs within the
block's budget; a pair counts in the first block that has it, so once; then its
cosine is computed exactly.  A tile returns, per vector, a number of links and
one link of a spanning forest, never the pairs, so a group of near copies gives
rows in proportion to its size.  Equal vectors are joined as one beforehand.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those with a null label, link with nothing (own component,
kept); vectors of different length link with nothing; rows that repeat (id,
label and vector) count as one; null ids link with nothing and stay null; an
empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage
from textlens.operators.components import connected_components

BLOCK, CHUNK, STRIP = 8, 2048, 512
TOLERANCE = 1e-9


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(5).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def budgets(dims: int, cosine: float) -> np.ndarray:
    """Squared-distance budget of each block, in proportion to its dimensions."""
    size = np.minimum(BLOCK, dims - np.arange(0, dims, BLOCK))
    return (2 - 2 * cosine) * size / dims + TOLERANCE


def _placer(cosine: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for dims, part in frame.groupby(frame["embedding"].map(len)):
                x = np.stack(part["embedding"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                x = x @ rotation(dims)
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                for b, budget in enumerate(budgets(dims, cosine)):
                    radius = np.sqrt(budget) + TOLERANCE
                    first = x[:, b * BLOCK]
                    home = np.floor(first / (2 * radius)).astype(np.int64)
                    near = first - home * 2 * radius <= radius
                    for guest, pick in ((False, slice(None)), (True, near)):
                        out.append(pd.DataFrame({
                            "label": part["label"].to_numpy()[pick], "dims": dims, "block": b,
                            "cell": home[pick] - guest, "guest": guest, "rep": part["rep"].to_numpy()[pick],
                            "copies": part["copies"].to_numpy()[pick], "x": list(x[pick])}))
            if out:
                yield pd.concat(out)
    return run


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of n points reaches by the links (i, j)."""
    low = np.arange(n)
    while True:
        old = low.copy()
        least = np.minimum(low[i], low[j])
        np.minimum.at(low, low[i], least)
        np.minimum.at(low, low[j], least)
        low = low[low]
        if (low == old).all():
            return low


def _tile(cosine: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(frame["x"].to_numpy())
        rep, copies = frame["rep"].to_numpy(), frame["copies"].to_numpy()
        guest, chunk = frame["guest"].to_numpy(), frame["chunk"].to_numpy()
        b, lo, hi = int(frame["block"].iloc[0]), int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        budget = budgets(x.shape[1], cosine)
        at = slice(b * BLOCK, (b + 1) * BLOCK)
        sub = np.ascontiguousarray(x[:, at])
        norm = (sub * sub).sum(1)
        left = np.flatnonzero((chunk == lo) & ~guest) if lo == hi else np.flatnonzero(chunk == lo)
        right = np.arange(len(x)) if lo == hi else np.flatnonzero(chunk == hi)
        links = np.zeros(len(x), np.int64)
        ii, jj = [], []
        for k in range(0, len(left), STRIP):
            own = left[k:k + STRIP]
            near = norm[own][:, None] + norm[right][None] - 2 * (sub[own] @ sub[right].T) <= budget[b] + TOLERANCE
            p, q = np.nonzero(near)
            p, q = own[p], right[q]
            # each pair once: two at home by order, a guest only with one at home
            keep = ~(guest[p] & guest[q])
            if lo == hi:
                keep &= guest[q] | (p < q)
            p, q = p[keep], q[keep]
            for s in range(0, len(p), 1 << 17):
                u, v = p[s:s + (1 << 17)], q[s:s + (1 << 17)]
                hit = np.einsum("ij,ij->i", x[u], x[v]) >= cosine
                u, v = u[hit], v[hit]
                d = (x[u] - x[v]) ** 2
                got = np.stack([d[:, c * BLOCK:(c + 1) * BLOCK].sum(1) <= budget[c] for c in range(b + 1)], 1)
                first = got[:, b] & ~got[:, :b].any(1)
                u, v = u[first], v[first]
                np.add.at(links, u, copies[v])
                np.add.at(links, v, copies[u])
                ii.append(u)
                jj.append(v)
        i, j = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (ii, jj))
        some = np.flatnonzero(links)
        root = _forest(len(x), i, j)
        return pd.DataFrame({"rep": rep[some], "links": links[some], "other": rep[root[some]]})
    return run


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", cosine: float = 0.93) -> DataFrame:
    """One row per row of ``vectors``: (vec_id, n_links, component_id, kept)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    good = F.expr("vec_id is not null and label is not null and size(embedding) > 0 and "
                  "forall(embedding, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and "
                  "exists(embedding, v -> v <> 0)")
    ones = rows.filter(good).groupBy("label", "embedding", "vec_id").agg(F.lit(1).alias("one"))
    reps = ones.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = cut_lineage(reps, "vectors")
    placed = reps.mapInPandas(_placer(cosine), "label string, dims long, block int, cell long, guest boolean, rep long, "
                                               "copies long, x array<double>")
    cells = (reps.mapInPandas(_cells(cosine), "label string, dims long, block int, cell long, n long")
             .groupBy("label", "dims", "block", "cell").agg(F.sum("n").alias("n"))
             .withColumn("parts", F.ceil(F.col("n") / CHUNK).cast("int")).drop("n"))
    placed = placed.join(cells, ["label", "dims", "block", "cell"])
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    placed = placed.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}).drop("other", "parts")
    tiles = cut_lineage(placed.groupBy("label", "dims", "block", "cell", "i", "j").applyInPandas(
        _tile(cosine), "rep long, links long, other long"), "tiles")
    linked = tiles.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = connected_components(tiles.select("rep", "other").distinct(), "rep", "other").withColumnRenamed("node", "rep")
    found = (reps.join(linked, "rep", "left").join(comp, "rep", "left")
             .select("rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id"), "label", "embedding"))
    found = found.select("label", "embedding", "n_links", "component_id")
    out = rows.withColumn("good", good).join(found, ["label", "embedding"], "left")
    comp_id = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("good"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.coalesce(comp_id == F.col("vec_id"), F.lit(True)).alias("kept"))


def _cells(cosine: float):
    place = _placer(cosine)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Number of places in each cell, summed per batch."""
        for frame in place(frames):
            yield frame.groupby(["label", "dims", "block", "cell"], as_index=False).agg(n=("rep", "size"))
    return run
