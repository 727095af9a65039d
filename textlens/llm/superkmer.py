"""Substring dedup by super-k-mer partitioning (operator 6).

A window is ``length`` consecutive words of one document.  Each window has a
minimiser: the smallest hash among its runs of ``MMER`` words.  Consecutive
windows of a document with one minimiser (a super-k-mer) travel as one packed
string to the bucket of that minimiser, so equal windows always meet.  There
the windows are sorted by hash, equal ones are confirmed on their words, and
the smallest document of each is found.  What comes back are spans of words,
which the documents drop.

Skew: equal super-k-mers are packed once per task with the list of their
places, and of equal texts only the smallest document counts (in all others
every window repeats).  A minimiser that holds more than 1 / ``HOT_SHARE`` of all
super-k-mers is hot (there are fewer than ``HOT_SHARE`` of them, so the list has
a fixed bound); its windows are dealt out by a second minimiser as well.  That
changes only where windows meet, never the result.

Defined results: a null or empty text has no words; a text of fewer than
``length`` words has no window and keeps all; rows with a null id neither
remove nor lose words; rows that repeat an id count as one document (a
document never removes its own words); an empty table gives an empty result;
other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm import tokens as T
from textlens.llm.common import pieces

LENGTH, MMER = 50, 6
HOT_SHARE = 2000
FLUSH_BYTES, BUCKET_BYTES = 12 << 20, 24 << 20
_U = np.uint64
_SECOND = _U(0x5851F42D4C957F2D)


def _run_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive words."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    i = np.arange(n)
    return T.span_hash(word, i, i + k)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, by doubling."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def super_kmers(w: T.Words, length: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, number of windows, minimiser) of each run of windows with one minimiser.

    A minimiser in ``hot`` is joined with a second, independent one of the same window.
    """
    word = w.hashes()
    none = np.zeros(0, np.int64)
    if w.n < length:
        return none, none, none, np.zeros(0, np.uint64)
    doc = w.doc()
    grams = _run_hashes(word, MMER)
    width = length - MMER + 1
    small = _window_min(grams, width)
    at = np.flatnonzero(doc[:len(small)] == doc[length - 1:])
    key = small[at]
    if len(hot):
        is_hot = np.isin(key, hot)
        if is_hot.any():
            second = _window_min(T.mix(grams ^ _SECOND), width)[at]
            key = np.where(is_hot, T.mix(key ^ T.mix(second)), key)
    if not len(at):
        return none, none, none, np.zeros(0, np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1]) | (doc[at[1:]] != doc[at[:-1]])
    head = np.flatnonzero(new)
    return doc[at[head]], at[head], np.diff(np.append(head, len(at))), key[head]


def _shares(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, at in T.chunks(batch):
                m = super_kmers(T.split(data, at), length, np.zeros(0, np.uint64))[3]
                # what is hot overall is at least this frequent in some chunk
                h, n = np.unique(m, return_counts=True)
                top = n * HOT_SHARE * 2 >= len(m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(T.signed(np.append(h[top], _U(0)))), pa.array(np.append(n[top], 0)),
                     pa.array(np.append(np.zeros(top.sum(), np.int64), len(m)))], ["minimiser", "n", "total"])
    return run


def _packer(length: int, buckets: int, hot: np.ndarray):
    def emit(held: dict[int, dict[bytes, dict]]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        ids, packed, places = [], [], []
        for b, strings in held.items():
            ids.append(b)
            packed.append(press.compress(b"\n".join(strings)))
            flat = [x for i, ps in enumerate(strings.values()) for (k, s), d in ps.items() for x in (i, d, k, s)]
            places.append(press.compress(np.array(flat, np.int64).tobytes()))
            if len(ids) >= 64:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(packed, pa.binary()),
                                                  pa.array(places, pa.binary())], ["bucket", "packed", "places"])
                ids, packed, places = [], [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(packed, pa.binary()),
                                              pa.array(places, pa.binary())], ["bucket", "packed", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[bytes, dict]] = defaultdict(dict)
        size = 0
        for batch in batches:
            for part, data, at in T.chunks(batch):
                w = T.split(data, at)
                doc, first, count, m = super_kmers(w, length, hot)
                blob, a, b = w.joined()
                ids, keys = T.longs(part, "doc_id"), T.longs(part, "text_key")
                bucket = (T.mix(m) % _U(buckets)).astype(np.int64)
                rows = zip(bucket.tolist(), a[first].tolist(), b[first + count + length - 2].tolist(),
                           ids[doc].tolist(), keys[doc].tolist(), (first - w.lo[doc]).tolist())
                for x, i, j, d, k, s in rows:
                    text = blob[i:j]
                    places = held[x].get(text)
                    if places is None:
                        places = held[x][text] = {}
                        size += j - i
                    # of copies of one text the smallest document stands for all
                    places[k, s] = min(d, places.get((k, s), d))
                    size += 24
                if size > FLUSH_BYTES:
                    yield from emit(held)
                    held, size = defaultdict(dict), 0
        yield from emit(held)
    return run


def _smallest(strings: list[bytes], least: np.ndarray, length: int) -> list[np.ndarray]:
    """For each packed string the smallest document that has each of its windows."""
    hashes, owner, offset, spans = [], [], [], []
    i = 0
    while i < len(strings):
        j, size = i, 0
        while j < len(strings) and (j == i or size + len(strings[j]) <= T.CHUNK_BYTES):
            size += len(strings[j])
            j += 1
        sizes = np.array([len(s) for s in strings[i:j]])
        w = T.split(np.frombuffer(b"".join(strings[i:j]), np.uint8), np.concatenate([[0], np.cumsum(sizes)]))
        h = _run_hashes(w.hashes(), length)
        doc = w.doc()
        at = np.flatnonzero(doc[:len(h)] == doc[length - 1:])
        hashes.append(h[at])
        owner.append(doc[at] + i)
        offset.append(at - w.lo[doc[at]])
        base = np.concatenate([[0], np.cumsum(sizes)])[doc[at]]
        spans.append(np.stack([w.first[at] - base, w.last[at + length - 1] - base], 1))
        i = j
    h, own, off = np.concatenate(hashes), np.concatenate(owner), np.concatenate(offset)
    span = np.concatenate(spans)
    order = np.argsort(h, kind="stable")
    hs = h[order]
    head = np.flatnonzero(np.append(True, hs[1:] != hs[:-1])) if len(hs) else np.zeros(0, np.int64)
    low = least[own].copy()
    sizes = np.diff(np.append(head, len(hs)))
    for a, n in zip(head[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        same = order[a:a + n]
        # sorted together by hash; the words themselves decide
        by: dict[bytes, list[int]] = {}
        for k in same.tolist():
            by.setdefault(strings[own[k]][span[k, 0]:span[k, 1]], []).append(k)
        for ks in by.values():
            if len(ks) > 1:
                low[ks] = low[ks].min()
    ends = np.searchsorted(own, np.arange(len(strings) + 1))
    return [low[ends[k]:ends[k + 1]] for k in range(len(strings))]


def _counter(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[tuple[bytes, bytes]]] = defaultdict(list)
        for batch in batches:
            for b, p, q in zip(*(c.to_pylist() for c in batch.columns)):
                blocks[b].append((p, q))
        open_ = zstandard.ZstdDecompressor()
        for b in list(blocks):
            strings: dict[bytes, int] = {}
            places = []
            for p, q in blocks.pop(b):
                local = np.array([strings.setdefault(s, len(strings)) for s in open_.decompress(p).split(b"\n")])
                x = np.frombuffer(open_.decompress(q), np.int64).reshape(-1, 4).copy()
                x[:, 0] = local[x[:, 0]]
                places.append(x)
            at = np.concatenate(places)
            # the smallest document of each place in a text
            at = at[np.lexsort((at[:, 1], at[:, 3], at[:, 2], at[:, 0]))]
            at = at[np.append(True, (at[1:, [0, 2, 3]] != at[:-1, [0, 2, 3]]).any(1))]
            least = np.full(len(strings), np.iinfo(np.int64).max)
            np.minimum.at(least, at[:, 0], at[:, 1])
            low = _smallest(list(strings), least, length)
            floor = np.array([x.min() for x in low])
            at = at[floor[at[:, 0]] < at[:, 1]]
            out: list[tuple[int, int, int, int]] = []
            for s, d, k, w0 in at.tolist():
                hit = np.flatnonzero(low[s] < d)
                cut = np.flatnonzero(np.diff(hit) > length)
                begin, stop = np.append(hit[0], hit[cut + 1]), np.append(hit[cut], hit[-1])
                out += [(d, k, w0 + i, w0 + j + length) for i, j in zip(begin.tolist(), stop.tolist())]
            if out:
                cols = np.array(out, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "text_key", "begin", "stop"])
    return run


def repeated_spans(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_key, begin, stop): spans of words whose windows also start in a smaller document.

    ``docs`` has ``doc_id`` (long), ``text`` and ``text_key`` (a hash of the text); of equal texts
    only the smallest document is told.
    """
    docs = docs.filter("doc_id is not null and text is not null")
    found = (docs.select("text").mapInArrow(_shares(length), "minimiser long, n long, total long")
             .groupBy("minimiser").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    total = found.agg(F.sum("total")).first()[0] or 0
    hot = [r["minimiser"] for r in
           found.filter((F.col("n") > 0) & (F.col("n") * HOT_SHARE > F.lit(total))).select("minimiser").collect()]
    # super-k-mers repeat the words between them, about three times the text
    buckets = pieces(docs, "text", BUCKET_BYTES, 3)
    packed = docs.select("doc_id", "text_key", "text").mapInArrow(
        _packer(length, buckets, np.array(hot, np.int64).view(np.uint64)),
        "bucket int, packed binary, places binary")
    return packed.repartition(buckets, "bucket").mapInArrow(
        _counter(length), "doc_id long, text_key long, begin long, stop long")


def _cutter(length: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in T.chunks(batch):
                yield _cut(part, data, at, length, keep_text)
    return run


def _cut(part: pa.RecordBatch, data: np.ndarray, at: np.ndarray, length: int, keep_text: bool) -> pa.RecordBatch:
    w = T.split(data, at)
    blob, a, b = w.joined()
    removed, kept = [], []
    for lo, hi, copy, spans in zip(w.lo.tolist(), w.hi.tolist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
        if copy and hi - lo >= length:
            removed.append(hi - lo)
            kept.append(b"")
            continue
        if not spans:
            removed.append(0)
            kept.append(blob[a[lo]:b[hi - 1]] if hi > lo else b"")
            continue
        gone = np.zeros(hi - lo + 1, np.int64)
        for s in spans:
            gone[s["begin"]] += 1
            gone[s["stop"]] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]])))
        removed.append(int((~keep).sum()))
        kept.append(b" ".join(blob[a[lo + i]:b[lo + j - 1]] for i, j in zip(edge[::2], edge[1::2])))
    cols = {"doc_id": part.column(0), "n_words": pa.array(w.hi - w.lo, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
    if keep_text:
        cols["kept"] = pa.array([k.decode() for k in kept], pa.string())
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_removed, kept_sha256, kept); ``kept`` if ``keep_text``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    spans = (repeated_spans(docs, length=length).groupBy("doc_id", "text_key")
             .agg(F.collect_set(F.struct("begin", "stop")).alias("spans")))
    first = docs.filter("doc_id is not null").groupBy("text_key").agg(F.min("doc_id").alias("first"))
    first = first.join(spans.select("text_key", F.col("doc_id").alias("first"), "spans"), ["text_key", "first"], "left")
    told = (docs.select("doc_id", "text_key").distinct().join(first, "text_key")
            .select("doc_id", "text_key", (F.col("doc_id") > F.col("first")).alias("copy"), "spans")
            .filter("copy or spans is not null"))
    told = told.withColumn("spans", F.when(~F.col("copy"), F.col("spans")))
    return (docs.join(told, ["doc_id", "text_key"], "left").select("doc_id", "text", "copy", "spans")
            .mapInArrow(_cutter(length, keep_text), "doc_id long, n_words long, n_removed long, kept_sha256 string"
                                                    + ", kept string" * keep_text))
