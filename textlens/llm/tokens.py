"""Vectorised word splitting and hashing for Arrow batches of texts.

A chunk of texts is one byte buffer; words, shingles and windows are found
with numpy over the whole buffer, so no Python runs per word.  A null text
is an empty text.  Every hash depends on the words alone, never on the
batch, so any task gives the same value.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_B1, _B2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_U = np.uint64


def _ascii_lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


AS_IS, LOWER = np.arange(256, dtype=np.uint8), _ascii_lower()
#: Separators of the classes [^\x20\x09-\x0D]+ and, after lower-casing, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[48:58] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, b, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_POW = {b: _Powers(b) for b in (_B1, _B2)}


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _B1) -> np.ndarray:
    """Hash of each span of ``values`` (uint64), whatever its place in the array."""
    up, down = _POW[base].get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _U(_B2))


@dataclass
class Words:
    """The words of a chunk: byte spans, the document of each, and each document's span of words."""

    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    inside: np.ndarray
    starts_mask: np.ndarray

    @property
    def n(self) -> int:
        return len(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lo)), self.hi - self.lo)

    def hashes(self, base: int = _B1) -> np.ndarray:
        return span_hash(self.data.astype(np.uint64) + _U(1), self.first, self.last, base)

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each, and each word's span in that."""
        size = self.last - self.first
        stop = np.cumsum(size + 1) - 1
        out = np.full(int(size.sum()) + self.n, 32, np.uint8)
        where = np.cumsum(self.starts_mask)[self.inside] - 1
        out[np.arange(len(where)) + where] = self.data[self.inside]
        return out.tobytes(), stop - size, stop


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each text's offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def split(data: np.ndarray, at: np.ndarray, sep: np.ndarray = BLANKS, table: np.ndarray = AS_IS) -> Words:
    """Words of the texts whose bytes lie between the offsets ``at``."""
    mapped = table[data]
    inside = ~sep[mapped]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(mapped, first, last, np.searchsorted(first, at[:-1]), np.searchsorted(first, at[1:]), inside, begin)


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most about CHUNK_BYTES of text each (one text at least)."""
    data, at = texts(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK_BYTES, "right")) - 1)
        yield batch.slice(i, j - i), data[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def longs(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
