"""N-gram Jaccard join by universe-partition pigeonhole (operator 7).

A document is the set of its word shingles, as 64-bit hashes; equal sets are
one node.  Size bands are powers of two.  In a band a hash sends every shingle
to one of ``m`` segments.  Two sets of sizes a and b with Jaccard similarity of
at least 3/4 differ in at most H = (a + b) / 7 shingles, so at least
m - H - (empty segments) of their non-empty segments are equal: each
segment's subset becomes an index key.  A set that may have partners in the
next band is indexed there, too.

Cost-based allocation: a set with slack s = m - H - empty - 1 leaves out its
s / 2 dearest segments, those of one or two shingles, which are shared by
chance most often; s / 2 on either side never uses up the common ones.  A set
without slack (small or uneven ones) also emits the one-deletion neighbourhoods
of its segments, and single shingles where even these give no guarantee.

Keys travel as sorted blocks to their partition.  There, documents that share
a key are a run.  A run's members are first verified against its two leaders (the member
that is in most runs: of near copies the one closest to the original; and the
one of the smallest hash, the same one in many runs) and the links found are contracted to components;
then, in runs that are still of several components, the members outside the
largest one are compared with those of other components.  So a group of near copies costs pairs in
proportion to its size and no link between components is lost.  Nothing gathers
a run: it is dealt into chunks of about ``CHUNK`` members, and a task sees a tile of two.
Pairs pass an exact bound (parity sketches: each differing shingle flips one
bit) before the sets themselves are compared.

Defined results: a null or blank text has the empty set and links with
nothing; fewer than ``SHINGLE`` words make one shingle; equal sets share a
component; rows with a null id get a null component and link with nothing;
rows that repeat an id are each judged by their own text;
an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm import tokens as T
from textlens.llm.common import bitmap, cut_lineage, pieces
from textlens.operators.components import connected_components

SHINGLE = 5
BUCKET_BYTES = 10 << 20
FLUSH_KEYS = 3_000_000
CHUNK, BULK, PLACE_ROWS = 2048, 64, 4096
BITMAP_BITS = 1 << 23
_U = np.uint64
_C = [_U(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Each document's shingle hashes, sorted and distinct."""
    w = T.split(data, at, T.BLANKS, T.LOWER)
    word = w.hashes()
    n = np.maximum(w.hi - w.lo - k + 1, np.minimum(w.hi - w.lo, 1))
    first = np.repeat(w.lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h = T.span_hash(word, first, np.minimum(first + k, np.repeat(w.hi, n)))
    cut = np.concatenate([[0], np.cumsum(n)])
    return [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), n, np.repeat(np.arange(len(sets)), n)


def node_ids(flat: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A set's node: a hash that does not depend on the order of its shingles."""
    sums = np.concatenate([[_U(0)], np.cumsum(T.mix(flat ^ _C[2]))])
    end = np.cumsum(n)
    return T.mix((sums[end] - sums[end - n]) ^ (n.astype(np.uint64) * _C[0]))


def band_of(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(np.float64))[1] - 1


def segments(band: int) -> int:
    """Number of segments of a band: one more than its largest H, and what is empty in a full set, with a margin."""
    largest = (1 << (band + 1)) - 1
    m = base = 2 * largest // 7 + 1
    for _ in range(20):
        empty = m * (1 - 1 / m) ** largest
        m = min(2 * base + 2, base + int(np.ceil(empty + 3 * np.sqrt(empty))))
    return m


_SEGMENTS = np.array([segments(b) for b in range(40)], np.int64)


def sketch_bits(n: np.ndarray) -> np.ndarray:
    return np.int64(1) << np.clip(band_of(n) + 2, 8, 15)


def sketch(s: np.ndarray) -> bytes:
    bits = int(sketch_bits(np.array([max(len(s), 1)]))[0])
    odd = np.bincount((T.mix(s ^ _C[3]) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def band_keys(flat: np.ndarray, n: np.ndarray, doc: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, document) for sets indexed in the given bands (one per document)."""
    m = _SEGMENTS[band]
    base = np.cumsum(m) - m
    slot = base[doc] + (T.mix(flat ^ _C[1]) % m[doc].astype(np.uint64)).astype(np.int64)
    total = int(m.sum())
    acc, size = np.zeros(total, np.uint64), np.bincount(slot, minlength=total)
    np.add.at(acc, slot, T.mix(flat ^ _C[0]))
    owner = np.repeat(np.arange(len(n)), m)
    place = (np.arange(total) - base[owner]).astype(np.uint64)
    salt = T.mix(place * _C[1] + band[owner].astype(np.uint64) * _C[2])
    empty = np.bincount(owner[size == 0], minlength=len(n))
    largest = np.minimum(4 * n // 3, (np.int64(2) << band) - 1)
    most = (n + np.maximum(largest, n)) // 7
    slack = m - most - empty - 1
    emit = size > 0
    spare = np.maximum(slack, 0) // 2
    for cost in (1, 2):
        at = np.flatnonzero(size == cost)
        o = owner[at]
        rank = np.arange(len(at)) - np.searchsorted(o, o)
        gone = rank < spare[o]
        emit[at[gone]] = False
        spare = spare - np.bincount(o[gone], minlength=len(n))
    at = np.flatnonzero(emit)
    keys, docs = [T.mix(acc[at] ^ salt[at]) ^ _C[0]], [owner[at]]
    short = slack < 0
    if short.any():
        # neighbourhoods: a segment as it is, and without each one of its shingles
        at = np.flatnonzero((size > 0) & short[owner])
        keys.append(T.mix(acc[at] ^ salt[at]) ^ _C[1])
        docs.append(owner[at])
        e = np.flatnonzero(short[doc] & (size[slot] > 1))
        keys.append(T.mix((acc[slot[e]] - T.mix(flat[e] ^ _C[0])) ^ salt[slot[e]]) ^ _C[1])
        docs.append(doc[e])
        # of the segments filled here, a partner may leave `ones` empty at a cost of 1 each, and must differ by 2 in the rest
        ones = np.minimum(np.bincount(owner[size == 1], minlength=len(n)), most)
        weak = short & (2 * (m - empty - ones) <= most - ones)
        e = np.flatnonzero(weak[doc])
        keys.append(T.mix(flat[e] + band[doc[e]].astype(np.uint64) * _C[3]) ^ _C[2])
        docs.append(doc[e])
    return np.concatenate(keys), np.concatenate(docs)


def index_keys(flat: np.ndarray, n: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, document) under every set's own band and, where partners may be there, the next."""
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    band = np.where(n > 0, band_of(np.maximum(n, 1)), 0)
    up = 4 * n // 3 >= (np.int64(2) << band)
    out = []
    for some, b in ((n > 0, band), (up, band + 1)):
        ids = np.flatnonzero(some)
        if len(ids):
            pick = some[doc]
            new = np.cumsum(some) - 1
            k, d = band_keys(flat[pick], n[ids], new[doc[pick]], b[ids])
            out.append((k, ids[d]))
    return np.concatenate([k for k, _ in out]), np.concatenate([d for _, d in out])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, at in T.chunks(batch):
            sets = shingle_sets(data, at)
            flat, n, _ = _flat(sets)
            node = node_ids(flat, n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(n), pa.array(T.signed(node)), pa.array([sketch(s) for s in sets], pa.binary())],
                ["doc_id", "text_key", "n_shingles", "node", "sketch"])


def _indexer(partitions: int):
    def emit(keys: np.ndarray, nodes: np.ndarray) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        names, local = np.unique(nodes, return_inverse=True)
        order = np.argsort(keys)
        keys, local = keys[order], local[order].astype(np.uint32)
        # the partition is the high part of a key, so each partition's keys lie together
        part = ((keys >> _U(40)) * _U(partitions) >> _U(24)).astype(np.int64)
        cut = np.searchsorted(part, np.arange(partitions + 1))
        for p in np.flatnonzero(np.diff(cut)):
            a, b = cut[p], cut[p + 1]
            own, idx = np.unique(local[a:b], return_inverse=True)
            idx = idx.astype(np.uint16 if len(own) < 1 << 16 else np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p)], pa.int32()), pa.array([keys[a:b].tobytes()], pa.binary()),
                 pa.array([press.compress(names[own].tobytes())], pa.binary()), pa.array([press.compress(idx.tobytes())], pa.binary()),
                 pa.array([idx.itemsize], pa.int32())], ["part", "keys", "names", "idx", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ks, ns, size = [], [], 0
        for batch in batches:
            for _, data, at in T.chunks(batch):
                flat, n, doc = _flat(shingle_sets(data, at))
                if not len(flat):
                    continue
                node = node_ids(flat, n)
                # copies within the chunk are indexed once
                once = np.zeros(len(n), bool)
                once[np.unique(node, return_index=True)[1]] = True
                pick, new = once[doc], np.cumsum(once) - 1
                k, d = index_keys(flat[pick], n[once], new[doc[pick]])
                ks.append(k)
                ns.append(node[once][d])
                size += len(k)
                if size > FLUSH_KEYS:
                    yield from emit(np.concatenate(ks), np.concatenate(ns))
                    ks, ns, size = [], [], 0
        if size:
            yield from emit(np.concatenate(ks), np.concatenate(ns))
    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct member lists of the keys of one or more index partitions."""
    open_ = zstandard.ZstdDecompressor()
    blocks: dict[int, list] = defaultdict(list)
    for batch in batches:
        for p, k, names, idx, width in zip(*(c.to_pylist() for c in batch.columns)):
            blocks[p].append((k, names, idx, width))
    for p in list(blocks):
        keys, nodes = [], []
        for k, names, idx, width in blocks.pop(p):
            keys.append(np.frombuffer(k, np.uint64))
            local = np.frombuffer(open_.decompress(idx), np.uint16 if width == 2 else np.uint32)
            nodes.append(np.frombuffer(open_.decompress(names), np.uint64)[local])
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        keep = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
        key, node = key[keep], node[keep]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(head, len(key)))
        raw = T.signed(node)
        seen = {raw[a:a + s].tobytes() for a, s in zip(head[size > 1].tolist(), size[size > 1].tolist())}
        if seen:
            lists = [np.frombuffer(x, np.int64) for x in seen]
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(lists)))], ["members"])


def _setter(bits: bytes):
    have = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(have[T.longs(batch, "bit")] > 0))
            for part, data, at in T.chunks(batch):
                sets = shingle_sets(data, at)
                flat, n, _ = _flat(sets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(T.signed(node_ids(flat, n))),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "node", "shingles"])
    return run


def _percent(bar: float) -> int:
    return round(bar * 100)


def _exact(bar: float):
    top = _percent(bar)

    @F.pandas_udf("boolean")
    def linked(sa: pd.Series, sb: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(sa, sb):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= top * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)
    return linked


def _rows_of(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of one length as rows of 64-bit words, folded to ``size`` bytes."""
    v = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    while v.shape[1] * 8 > size:
        v = v[:, :v.shape[1] // 2] ^ v[:, v.shape[1] // 2:]
    return v


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to the size of the smallest."""
    length = np.array([len(x) for x in sketches])
    least = int(length.min())
    out = np.empty((len(sketches), least // 8), np.uint64)
    for size in np.unique(length):
        at = np.flatnonzero(length == size)
        out[at] = _rows_of([sketches[i] for i in at], least)
    return out


def _within(n: np.ndarray, m: np.ndarray, bits: np.ndarray, top: int) -> np.ndarray:
    """Whether sets of sizes n and m can reach the bar, if their sketches differ in ``bits`` places."""
    s, d = n + m, np.maximum(bits, np.abs(n - m))
    return 100 * (s - d) >= top * (s + d)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits the sketches of two rows differ, folded to the smaller size."""
    d = np.zeros(len(x), np.int64)
    shape = np.array([(len(a), len(b)) for a, b in zip(x, y)], np.int64).reshape(-1, 2)
    for lx, ly in np.unique(shape, axis=0):
        at = np.flatnonzero((shape == (lx, ly)).all(axis=1))
        size = int(min(lx, ly))
        d[at] = np.bitwise_count(_rows_of(list(x[at]), size) ^ _rows_of(list(y[at]), size)).sum(axis=1, dtype=np.int64)
    return d


def _may_link(bar: float):
    """The exact bound on rows of two sets."""
    top = _percent(bar)

    @F.pandas_udf("boolean")
    def possible(n: pd.Series, m: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(_within(n.to_numpy(np.int64), m.to_numpy(np.int64), _distance(x.to_numpy(object), y.to_numpy(object)), top))
    return possible


def _pairs_of_tiles(bar: float):
    """Pairs (home, guest) of a tile, of different components, that the bounds allow; tiles of up to ``BULK`` rows many at a time."""
    top, strip = _percent(bar), 128

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()

        def new(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
            pairs = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())) - sent
            if pairs:
                if len(sent) > 2_000_000:
                    sent.clear()
                sent.update(pairs)
                both = np.array(sorted(pairs), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for batch in batches:
            lists = batch.column(0)
            rows = lists.flatten()
            node, group, n, home, guest = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "by", "n", "home", "guest"))
            bits = rows.field("sketch").to_numpy(zero_copy_only=False)
            size = np.asarray(lists.value_lengths())
            start = np.cumsum(size) - size
            few = np.flatnonzero(size <= BULK)
            for k in range(0, len(few), BULK):
                s, at = size[few[k:k + BULK]], start[few[k:k + BULK]]
                grid = s * s
                place = np.arange(grid.sum()) - np.repeat(np.cumsum(grid) - grid, grid)
                wide, base = np.repeat(s, grid), np.repeat(at, grid)
                i, j = base + place // wide, base + place % wide
                # two homes that are guests too would come twice
                ok = home[i] & guest[j] & (group[i] != group[j]) & ~(home[j] & guest[i] & (i > j))
                ok &= _within(n[i], n[j], np.zeros(len(i), np.int64), top)
                i, j = i[ok], j[ok]
                once = np.unique(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])]), axis=1, return_index=True)[1]
                i, j = i[once], j[once]
                ok = _within(n[i], n[j], _distance(bits[i], bits[j]), top)
                yield from new(node[i[ok]], node[j[ok]])
            for t in np.flatnonzero(size > BULK):
                mine = np.arange(start[t], start[t] + size[t])
                sketches = _folded(list(bits[mine]))
                hosts, others = np.flatnonzero(home[mine]), np.flatnonzero(guest[mine])
                if not len(others):
                    continue
                for k in range(0, len(hosts), strip):
                    own = hosts[k:k + strip]
                    d = np.zeros((len(own), len(others)), np.int64)
                    for w in range(sketches.shape[1]):
                        d += np.bitwise_count(sketches[own, w][:, None] ^ sketches[others, w][None])
                    ok = _within(n[mine[own]][:, None], n[mine[others]][None], d, top)
                    i, j = np.nonzero(ok & (group[mine[own]][:, None] != group[mine[others]][None]))
                    yield from new(node[mine[own[i]]], node[mine[others[j]]])
    return run


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bar: float = 0.75) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text_key, group_key, n_shingles, component_id). The bounds are for 0.75 and more.

    ``text_key`` is xxhash64 of the text; with the id it names the row.  ``group_key`` names the component
    where ids repeat (two may have the same smallest id); null for the empty set.
    """
    if bar < 0.75:
        raise ValueError("bar is 0.75 at least")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = cut_lineage(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _nodes, "doc_id long, text_key long, n_shingles long, node long, sketch binary"), "sets")
    nodes = cut_lineage(rows.filter("n_shingles > 0 and doc_id is not null").groupBy("node")
                        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                             F.first("sketch").alias("sketch")), "nodes")
    partitions = pieces(docs, "text", BUCKET_BYTES)
    keys = docs.filter("doc_id is not null").select("text").mapInArrow(
        _indexer(partitions), "part int, keys binary, names binary, idx binary, width int")
    runs = cut_lineage(keys.repartition(partitions, "part").mapInArrow(_runs, "members array<long>")
                       .groupBy("members").agg(F.lit(1).alias("one")).select("members"), "runs")
    # a run is named by its members: the same on every attempt (two runs of one name would only be compared together)
    wide = cut_lineage(runs.select(F.xxhash64("members").alias("run"), F.size("members").alias("k"),
                                   F.explode("members").alias("node")), "wide")
    central = wide.groupBy("node").agg(F.count(F.lit(1)).alias("runs"))
    wide = cut_lineage(wide.join(central, "node"), "central")
    stars = _star_pairs(wide, nodes, bar)
    first = cut_lineage(_verified(docs, nodes, stars, bar), "links")
    comp = cut_lineage(connected_components(first, "a", "b").withColumnRenamed("component", "c"), "comp")
    links = first.unionByName(_verified(docs, nodes, _cross_pairs(wide, comp, nodes, bar), bar))
    comp = connected_components(links, "a", "b").select("node", F.col("component").alias("c"))
    # components are of nodes; name each by its smallest document
    named = nodes.select("node", "rep").join(comp, "node", "left").withColumn("c", F.coalesce("c", "node"))
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "c").select("node", "component_id", F.col("c").alias("group_key"))
    return rows.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left").select(
        "doc_id", "text_key", "group_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(
            F.when(F.col("n_shingles") > 0, F.col("component_id")), "doc_id")).alias("component_id"))


def _dealt(members: DataFrame, per_run: DataFrame) -> DataFrame:
    """Members (run, k, node, ...) joined with their run's rows of ``per_run`` (run, k, ...), ``CHUNK`` members or so at a time."""
    parts = F.col("k").cast("long")
    each = per_run.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(parts / CHUNK)))).drop("k")
    return members.withColumn("deal", F.pmod(F.xxhash64("node"), F.floor(parts / CHUNK) + 1)).join(each, ["run", "deal"]).drop("deal")


def _star_pairs(wide: DataFrame, nodes: DataFrame, bar: float) -> DataFrame:
    """Each run's members with its leaders: the member in most runs, and the one of the smallest hash."""
    lead = wide.groupBy("run").agg(
        F.max("k").alias("k"), F.max(F.struct("runs", "node"))["node"].alias("x"),
        F.min(F.struct(F.xxhash64("node").alias("h"), "node"))["node"].alias("y"))
    lead = lead.select("run", "k", F.explode(F.array_distinct(F.array("x", "y"))).alias("lead"))
    pairs = _dealt(wide, lead).filter("node <> lead").select(
        F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()

    def side(x: str) -> DataFrame:
        return nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(_may_link(bar)("n_a", "n_b", "sketch_a", "sketch_b")).select("a", "b")


def _cross_pairs(wide: DataFrame, comp: DataFrame, nodes: DataFrame, bar: float) -> DataFrame:
    """Pairs of a run's members that the links found so far leave in different components.

    Homes, those outside the run's largest component, meet all its members, the
    guests.  Both are dealt into chunks; a tile is one chunk of homes and one of guests.
    """
    named = wide.join(comp, "node", "left").select("run", "k", "node", "runs", F.coalesce("c", "node").alias("by"))
    size = named.groupBy("run", "by").agg(F.count(F.lit(1)).alias("size"), F.max("k").alias("k"), F.max("runs").alias("runs"))
    size = size.groupBy("run").agg(F.max("k").alias("k"), F.sum("size").alias("all"), F.max(F.struct("size", "runs", "by")).alias("top"))
    mixed = size.filter("top.size < all").select("run", "k", F.col("top.by").alias("main"),
                                                 F.floor((F.col("all") - F.col("top.size")) / CHUNK).alias("homes"))
    mixed = cut_lineage(mixed, "mixed")
    # runs of one largest component meet in as many places as their rows need: a task sends a pair once
    load = mixed.groupBy("main").agg(F.floor(F.sum(F.col("k") * (F.col("homes") + 1)) / PLACE_ROWS).alias("salts"))
    mixed = mixed.join(load, "main").withColumn("salt", F.pmod(F.xxhash64("run"), F.col("salts") + 1)).drop("salts")
    members = _dealt(named.drop("runs"), mixed).withColumn("away", F.col("by") != F.col("main")).join(nodes.drop("rep"), "node")
    members = members.withColumn("x", F.pmod(F.xxhash64("node"), F.floor(F.col("k") / CHUNK) + 1)).withColumn(
        "y", F.pmod(F.xxhash64("node", F.lit(1)), F.col("homes") + 1))
    cols = ["run", "main", "salt", "node", "by", "n", "sketch"]
    zero = F.lit(0).cast("long")
    guests = members.select(*cols, "x", F.explode(F.sequence(zero, "homes")).alias("ty"), "y", "away").select(
        *cols, "x", F.col("ty").alias("y"), (F.col("away") & (F.col("ty") == F.col("y"))).alias("home"), F.lit(True).alias("guest"))
    homes = members.filter(F.col("away") & (F.col("k") >= CHUNK)).select(
        *cols, F.explode(F.sequence(zero, F.floor(F.col("k") / CHUNK))).alias("tx"), "x", "y").filter("tx <> x").select(
        *cols, F.col("tx").alias("x"), "y", F.lit(True).alias("home"), F.lit(False).alias("guest"))
    place = F.xxhash64("main", "salt", "x", "y").alias("place")
    tiles = guests.unionByName(homes).select("*", place).drop("main", "salt").repartition("place").groupBy("place", "run", "x", "y").agg(
        F.collect_list(F.struct("node", "by", "n", "sketch", "home", "guest")).alias("members")).select("members")
    return tiles.mapInArrow(_pairs_of_tiles(bar), "a long, b long").distinct()


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, bar: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the bar."""
    def side(x: str) -> DataFrame:
        return nodes.select(F.col("node").alias(x), F.col("rep").alias(f"rep_{x}"))

    near = cut_lineage(pairs.join(side("a"), "a").join(side("b"), "b"), "near")
    ends = F.explode(F.array(*(F.struct(F.col(f"rep_{x}").alias("doc_id"), F.col(x).alias("node")) for x in "ab")))
    need = near.select(ends.alias("end")).select("end.*").distinct()
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    bits = bitmap(need.withColumn("bit", bit), "bit", BITMAP_BITS)
    # a bitmap of fixed size lets most texts go before the exact join; a set is its node's, whatever else its id names
    sets = docs.withColumn("bit", bit).filter("doc_id is not null").mapInArrow(
        _setter(bits), "doc_id long, node long, shingles binary").join(need, ["doc_id", "node"], "left_semi")
    sets = cut_lineage(sets.groupBy("node").agg(F.min("shingles").alias("shingles")), "shingles")
    both = (near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    return both.filter(_exact(bar)("x", "y")).select("a", "b")
