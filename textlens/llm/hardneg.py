"""Hard-negative mining over Hilbert-ordered blocks with zone maps (operator 12).

Candidates are sorted along a Hilbert curve through their first components
and cut into blocks of ``BLOCK`` rows, written as Parquet: a row per block with
its packed vectors, and its zone map beside them (least and greatest value of
every component, labels held).  Interval arithmetic gives the least and greatest
inner product that an anchor can have with any row of a block:

    most  = sum of max(a * low, a * high)     least = sum of min(a * low, a * high)

An anchor asks with windows of scores.  A block is read for an anchor only where
[least, most] meets one of its windows and the block holds a label that
counts.  Search goes in two steps: each anchor reads its own block first (its
neighbours on the curve), and what it finds there lifts the lower end of its
windows to the k-th best so far; the zone maps then choose all further blocks.
Positives are one window without ends over rows of the same label; negatives
are one window per positive over the other labels.

Anchors are packed into tiles (``ANCHORS``) and blocks into tiles (``ZONES``), either
of ``NUMBERS`` numbers at most.  Zone maps meet anchors first, tile by tile, and say
which tiles of anchors must be copied to which tiles of blocks; there they say it
once more for every block and anchor.  What is found in a tile lifts the windows
for its further blocks, and only the best of a tile leave it.  So a task holds
one tile of either, tiles of blocks are sent once (a few times where there are
fewer of them than cores), and no vector is copied for a block.  Bounds cut
what has structure; on vectors without any, every block is chosen for every
anchor, and work is anchors times rows.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; an id with several rows counts with the
smallest of them (by label as text, then vector); vectors of other lengths are compared
as if the missing components were zero; whole numbers are held within
2 ** 26 / sqrt(length), so that scores are exact in doubles; ties go to the
smaller id; an anchor without positives, and a positive without negatives, give
no row (a negative positive score has an empty window); an empty table gives an
empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage
from textlens.llm.vectors import narrow, one_per_id, widened
from textlens.session import one_row_batches

#: Rows of a block, numbers of a block or tile, blocks and anchors of a tile, at most.
BLOCK, NUMBERS, ZONES, ANCHORS = 512, 1 << 21, 64, 4096
#: Rows that a task finds before it keeps the best of them.
FOUND = 1 << 17
#: The curve runs through the first ``AXES`` components, each cut into 2 ** ``ORDER`` cells: 60 bits, a long.
AXES, ORDER = 15, 4

_PACK = "tile long, ids binary, labels array<string>, homes binary, v binary, low binary, high binary"
_FOUND = "anchor long, w int, vec_id long, score long"


def hilbert(cells: np.ndarray, order: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (Skilling's transform, all rows at once)."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for bit in range(order - 1, 0, -1):
        q, rest = 1 << bit, (1 << bit) - 1
        for i in range(n):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & rest)
            x[:, 0] ^= np.where(on, rest, swap)
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for bit in range(order - 1, 0, -1):
        flip ^= np.where(x[:, n - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(order - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[:, i] >> bit & 1)
    return key


def _matrix(v: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list array, filled up with zeros."""
    ends = v.offsets.to_numpy().astype(np.int64)
    size = np.diff(ends)
    out = np.zeros((len(size), max(int(size.max(initial=0)), width or 0)))
    values = v.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], size)] = values
    return out


def _column(table, name: str) -> pa.Array:
    col = table[name]
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def _curve(centre: np.ndarray, spread: np.ndarray):
    """Adds the place on the curve; cells are cut between two deviations below and above the mean."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["v"], AXES)[:, :AXES]
            half = 1 << (ORDER - 1)
            cell = np.floor((x - centre) / spread * (half / 2)) + half
            key = hilbert(np.clip(cell, 0, 2 * half - 1), ORDER)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key, pa.int64())], [*batch.schema.names, "place"])
    return run


def _zone(x: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(z, np.float64).tobytes() for z in (x.min(0, initial=np.inf), x.max(0, initial=-np.inf))]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the rows of a task, in order of the curve, into blocks: one row each."""
    made, held, rows, numbers = 0, [], 0, 0
    first = TaskContext.get().partitionId() << 40

    def out():
        table = pa.Table.from_batches(held)
        labels = _column(table, "label").dictionary_encode()
        x = _matrix(_column(table, "v"))
        low, high = _zone(x)
        row = {"block": first + made, "ids": _column(table, "vec_id").to_numpy().tobytes(),
               "labels": labels.dictionary.to_pylist(), "codes": labels.indices.to_numpy().astype(np.int32).tobytes(),
               "v": narrow(x.astype(np.int64).ravel()), "low": low, "high": high, "asks": _column(table, "asks").to_numpy(zero_copy_only=False).tobytes()}
        return pa.RecordBatch.from_pylist([row], _BLOCK_SCHEMA)

    for batch in batches:
        size = np.diff(batch["v"].offsets.to_numpy())
        at = 0
        while at < batch.num_rows:
            # numbers are counted as they are stored: rows times the longest vector
            longest = np.maximum.accumulate(np.maximum(size[at:], numbers))
            fits = int(min(((np.arange(len(longest)) + rows + 1) * longest <= NUMBERS).sum(), BLOCK - rows))
            if not fits and not rows:
                fits = 1
            if fits:
                held.append(batch.slice(at, fits))
                rows, numbers, at = rows + fits, int(longest[fits - 1]), at + fits
            if at < batch.num_rows or rows >= BLOCK:
                yield out()
                made, held, rows, numbers = made + 1, [], 0, 0
    if rows:
        yield out()


_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.list_(pa.string())),
                           ("codes", pa.binary()), ("v", pa.binary()), ("low", pa.binary()), ("high", pa.binary()),
                           ("asks", pa.binary())])
_BLOCK = "block long, ids binary, labels array<string>, codes binary, v binary, low binary, high binary, asks binary"


def blocks(rows: DataFrame, asks: Column) -> DataFrame:
    """The written blocks of (vec_id, label, v), in order of the curve."""
    n = rows.agg(F.count(F.lit(1)), *(f(F.try_element_at("v", F.lit(i + 1))) for i in range(AXES)
                                      for f in (F.avg, F.stddev_pop))).first()
    centre = np.array([x or 0.0 for x in n[1::2]])
    spread = np.array([x or 1.0 for x in n[2::2]])
    placed = rows.withColumn("asks", asks).mapInArrow(_curve(centre, spread), "vec_id long, label string, v array<long>, asks boolean, place long")
    # equal places are told apart by the id, so that equal vectors do not meet in one task
    placed = placed.repartitionByRange(max(n[0] // (16 * BLOCK), 1), "place", "vec_id").sortWithinPartitions("place", "vec_id")
    return cut_lineage(placed.select("vec_id", "label", "v", "asks").mapInArrow(_blocks, _BLOCK), "blocks")


_TILE_SCHEMA = pa.schema([("z", pa.int64()), ("blocks", pa.list_(pa.int64())), ("ids", pa.list_(pa.binary())),
                          ("labels", pa.list_(pa.list_(pa.string()))), ("codes", pa.list_(pa.binary())), ("v", pa.list_(pa.binary())),
                          ("low", pa.list_(pa.binary())), ("high", pa.list_(pa.binary()))])
_TILE = ("z long, blocks array<long>, ids array<binary>, labels array<array<string>>, codes array<binary>, v array<binary>, "
         "low array<binary>, high array<binary>")


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts blocks that follow each other into tiles: one row each."""
    held, numbers = [], 0

    def out():
        return pa.RecordBatch.from_pylist([{"z": held[0]["block"], "blocks": [r["block"] for r in held],
                                            **{c: [r[c] for r in held] for c in _TILE_SCHEMA.names[2:]}}], _TILE_SCHEMA)

    for batch in batches:
        for row in batch.to_pylist():
            more = (len(row["v"]) - 1) // row["v"][0]
            if held and (len(held) == ZONES or numbers + more > NUMBERS):
                yield out()
                held, numbers = [], 0
            held.append(row)
            numbers += more
    if held:
        yield out()


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, label, v, home, a) of the rows of each block that ask; those of one tile ``a`` follow each other on the curve."""
    first, tile, n, longest = TaskContext.get().partitionId() << 40, 0, 0, 0
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            x = widened(row["v"]).reshape(len(ids), -1)
            codes = np.frombuffer(row["codes"], np.int32)
            pick = np.flatnonzero(np.frombuffer(row["asks"], bool))
            while len(pick):
                # numbers are counted as they are stored: rows times the longest vector
                longest = max(longest, x.shape[1])
                fits = min(ANCHORS, max(NUMBERS // max(longest, 1), 1)) - n
                if fits <= 0:
                    tile, n, longest = tile + 1, 0, 0
                    continue
                some, pick = pick[:fits], pick[fits:]
                n += len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array([row["labels"][c] for c in codes[some]], pa.string()),
                     pa.array(list(x[some]), pa.list_(pa.int64())), pa.array(np.full(len(some), row["block"])),
                     pa.array(np.full(len(some), first + tile))], ["anchor", "label", "v", "home", "a"])


def _windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the windows, as doubles; missing windows are empty (low above high)."""
    low, high = _column(table, "low"), _column(table, "high")
    width = int(np.diff(low.offsets.to_numpy()).max(initial=0))
    none = np.arange(width)[None] >= np.diff(low.offsets.to_numpy())[:, None]
    return np.where(none, np.inf, _matrix(low, width)), np.where(none, -np.inf, _matrix(high, width))


_PACK_SCHEMA = pa.schema([("tile", pa.int64()), ("ids", pa.binary()), ("labels", pa.list_(pa.string())), ("homes", pa.binary()),
                          ("v", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])


def _packed(key: str):
    def run(table: pa.Table) -> pa.Table:
        """The anchors of one tile, or of one block, as one packed row."""
        low, high = _windows(table)
        x = _matrix(_column(table, "v"))
        return pa.Table.from_pylist([{
            "tile": table[key][0].as_py(), "ids": table["anchor"].to_numpy().tobytes(), "labels": table["label"].to_pylist(),
            "homes": table["home"].to_numpy().tobytes(), "v": narrow(x.astype(np.int64).ravel()), "low": low.tobytes(),
            "high": high.tobytes()}], _PACK_SCHEMA)
    return run


class _Asking:
    """The anchors of a packed row, and their windows."""

    def __init__(self, row: dict[str, pa.Scalar]):
        self.ids, self.homes = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("ids", "homes"))
        self.labels, self.of = np.unique(np.array(row["labels"].as_py(), object), return_inverse=True)
        self.v = widened(row["v"]).astype(np.float64).reshape(len(self.ids), -1)
        # copied, as what is found lifts the lower ends
        self.low, self.high = (np.frombuffer(row[c].as_buffer(), np.float64).reshape(len(self.ids), -1).copy() for c in ("low", "high"))

    def needs(self, blocks: list[int], labels: list[list[str]], low: list[bytes], high: list[bytes], same: bool) -> np.ndarray:
        """Which anchors (rows) must read which blocks of a tile."""
        # the box of a block ends with its longest vector; beyond, its rows are zero
        boxes = [[np.frombuffer(b, np.float64) for b in side] for side in (low, high)]
        width = max(self.v.shape[1], *(len(b) for b in boxes[0]))
        x = np.pad(self.v, ((0, 0), (0, width - self.v.shape[1])))
        z_low, z_high = (np.stack([np.pad(b, (0, width - len(b))) for b in side]) for side in boxes)
        least, most = bounds(x, z_low, z_high)
        need = np.zeros(least.shape, bool)
        for w in range(self.low.shape[1]):
            a, b = self.low[:, w][:, None], self.high[:, w][:, None]
            need |= (a <= b) & (least <= b) & (most >= a)
        need &= self.homes[:, None] != np.array(blocks)[None]
        holds = np.array([[name in held for name in self.labels] for held in map(set, labels)])[:, self.of].T
        return need & (holds if same else np.array([len(x) for x in labels])[None] > holds)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with any vector between ``low`` and ``high`` (rows: blocks)."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


def _choose(same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(a, z) of the tiles that must meet."""
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                asking = _Asking({c: batch[f"a_{c}"][i] for c in _PACK_SCHEMA.names[1:]})
                keep.append(asking.needs(*(batch[c][i].as_py() for c in ("blocks", "labels", "low", "high")), same).any())
            yield batch.select(["a", "z"]).filter(pa.array(keep, pa.bool_()))
    return run


def _found(asking: _Asking, some: np.ndarray, ids: np.ndarray, codes: np.ndarray, names: list[str], x: np.ndarray,
           same: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor's place, window, id, score) of the rows of a block that lie in a window of one of ``some`` anchors."""
    a, low, high = asking.v[some], asking.low[some], asking.high[some]
    width = min(a.shape[1], x.shape[1])
    scores = a[:, :width] @ x[:, :width].T
    code = {name: i for i, name in enumerate(names)}
    own = np.array([code.get(name, -1) for name in asking.labels])[asking.of[some]]
    empty = low > high
    inside = scores >= np.where(empty, np.inf, low).min(1)[:, None]
    inside &= scores <= np.where(empty, -np.inf, high).max(1)[:, None]
    inside &= (own[:, None] == codes[None]) if same else (own[:, None] != codes[None])
    r, c = np.nonzero(inside)
    keep = asking.ids[some][r] != ids[c]
    r, c = r[keep], c[keep]
    score = scores[r, c]
    for w in range(low.shape[1]):
        of = (score >= low[r, w]) & (score <= high[r, w])
        yield some[r[of]], np.full(np.count_nonzero(of), w, np.int32), ids[c[of]], score[of]


def _read(same: bool, k: int, choose: bool):
    """The k best rows of a tile of blocks in each window of each anchor that reads one of them; in one block alone, all read it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asking = _Asking({c: batch[f"a_{c}"][i] for c in _PACK_SCHEMA.names[1:]})
                blocks, ids, labels, codes, vectors, *boxes = (batch[c][i].as_py() for c in _TILE_SCHEMA.names[1:])
                need = asking.needs(blocks, labels, *boxes, same) if choose else asking.homes[:, None] == np.array(blocks)[None]
                held, more, n = [], [], 0
                for b in np.flatnonzero(need.any(0)):
                    of = np.frombuffer(ids[b], np.int64)
                    x = widened(vectors[b]).reshape(len(of), -1).astype(np.float64)
                    rows = list(_found(asking, np.flatnonzero(need[:, b]), of, np.frombuffer(codes[b], np.int32), labels[b], x, same))
                    more += rows
                    n += sum(len(r[0]) for r in rows)
                    if n > FOUND:
                        held, more, n = _kept(asking, held + more, k), [], 0
                r, w, vec, score = _kept(asking, held + more, k)[0]
                yield pa.RecordBatch.from_arrays([pa.array(asking.ids[r]), pa.array(w, pa.int32()), pa.array(vec, pa.int64()),
                                                  pa.array(score.astype(np.int64))], ["anchor", "w", "vec_id", "score"])
    return run


def _kept(asking: _Asking, rows: list[tuple[np.ndarray, ...]], k: int) -> list[tuple[np.ndarray, ...]]:
    """The k best of each anchor's window; further ones must reach the last of them."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0))
    r, w, vec, score = (np.concatenate(x) for x in zip(*rows, none))
    order = np.lexsort((vec, -score, w, r))
    r, w, vec, score = r[order], w[order], vec[order], score[order]
    window = r * asking.low.shape[1] + w
    nth = np.arange(len(r)) - np.searchsorted(window, window)
    r, w, vec, score, nth = (x[nth < k] for x in (r, w, vec, score, nth))
    last = nth == k - 1
    asking.low[r[last], w[last]] = np.maximum(asking.low[r[last], w[last]], score[last])
    return [(r, w, vec, score)]


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = found.selectExpr("*", "cast(row_number() over (partition by anchor, w order by score desc, vec_id) as int) as rank")
    return ranked.filter(F.col("rank") <= k)


def search(anchors: DataFrame, blocks: DataFrame, tiles: DataFrame, *, same: bool, k: int) -> DataFrame:
    """(anchor, w, vec_id, score, rank): the k best rows of the same label, or of others, in each window.

    ``anchors`` has (anchor, label, v, home, a, low, high), the windows as arrays of lower and upper ends.
    """
    spark = anchors.sparkSession

    def packs(rows: DataFrame, key: str) -> DataFrame:
        rows = rows.groupBy(key).applyInArrow(_packed(key), _PACK)
        return cut_lineage(rows.withColumnsRenamed({c: f"a_{c}" for c in _PACK_SCHEMA.names[1:]}), "packs")

    # packed rows hold far more than their files show: none is broadcast
    home = packs(anchors, "home").withColumnRenamed("tile", "block")
    one = blocks.select("block", F.array("block").alias("blocks"), *[F.array(c).alias(c) for c in ("ids", "labels", "codes", "v", "low", "high")])
    with one_row_batches(spark):
        near = cut_lineage(home.hint("merge").join(one, "block").mapInArrow(_read(same, k, False), _FOUND), "near")
    # k rows in a window: further ones must reach the last of them
    bars = near.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bar")).filter(F.col("n") >= k)
    bars = bars.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "bar"))).alias("bars"))
    lifted = anchors.join(bars, "anchor", "left").withColumn("low", F.transform(
        "low", lambda x, i: F.greatest(x, F.try_element_at("bars", i)))).drop("bars")
    asking = packs(lifted, "a").withColumnRenamed("tile", "a")
    names = [r["a"] for r in asking.select("a").collect()]          # one number for ANCHORS anchors
    if not names:
        return _best(near, k)
    zones = tiles.select("z", "blocks", "labels", "low", "high").withColumn("a", F.explode(F.array(*map(F.lit, names)).cast("array<long>")))
    par, n_z = spark.sparkContext.defaultParallelism, tiles.count()
    copies = min(-(-2 * par // max(n_z, 1)), len(names))
    dealt = lambda x: x.repartition(min(n_z * copies, 4096), "z", "copy")
    with one_row_batches(spark):
        chosen = cut_lineage(zones.hint("merge").join(asking, "a").mapInArrow(_choose(same), "a long, z long"), "chosen")
        sent = chosen.join(asking.hint("merge"), "a").withColumn("copy", F.pmod(F.xxhash64("a"), F.lit(copies)).cast("int"))
        met = dealt(sent).join(dealt(tiles.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))).hint("merge"), ["z", "copy"])
        found = met.mapInArrow(_read(same, k, True), _FOUND)
        return cut_lineage(_best(near.unionByName(found), k), "best")


def mine(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         anchors: Column | None = None, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the hard negatives.

    ``anchors`` is a condition on ``vec_id``; the default takes ids divisible by 50.  A negative scores
    between ``low`` and ``high`` hundredths of its positive.
    """
    asks = F.col("vec_id") % 50 == 0 if anchors is None else anchors
    table = cut_lineage(one_per_id(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col, bits=52), "vectors")
    rows = blocks(table, asks)
    with one_row_batches(vectors.sparkSession):
        asking = cut_lineage(rows.mapInArrow(_anchors, "anchor long, label string, v array<long>, home long, a long"), "anchors")
        tiles = cut_lineage(rows.drop("asks").mapInArrow(_tiled, _TILE), "tiles")
    ends = 1 << 53                                  # beyond any score
    first = asking.withColumns({"low": F.array(F.lit(-ends)), "high": F.array(F.lit(ends))})
    near = search(first, rows, tiles, same=True, k=positives).select(
        "anchor", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score")
    # low * p <= 100 * n <= high * p in whole numbers
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "w", (-F.floor(-score * low / F.lit(100).cast("decimal(3,0)"))).cast("long").alias("low"),
        F.floor(score * high / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high")))).alias("s"))
    second = asking.join(windows, "anchor").select("anchor", "label", "v", "home", "a", F.col("s.low").alias("low"), F.col("s.high").alias("high"))
    found = search(second, rows, tiles, same=False, k=negatives)
    return found.join(near, ["anchor", "w"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
