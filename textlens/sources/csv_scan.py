"""Records of any number of CSV files, found in parallel within and across files.

A line break inside quotes does not end a record, so whether a line starts one
depends on every quote before it.  A scan of lines sees a file in blocks that
know nothing of each other.  Hence two passes of one job each, however many
files there are:

1. Every block is read under both separators and both states it may begin in
   (between records, or inside a quoted field).  It is summed up in one row: the
   state it ends in and the start of its last record under each of these four
   assumptions, whether it is valid UTF-8, and the header if it is a file's first.
   The rows of a file are put together in order: the true state at the start of
   each block follows from the blocks before (a prefix scan over one row per
   block), and separator, encoding and columns follow from the whole file.
2. Every line is read again, with its place and state under the four assumptions;
   a join with the block's row says which one holds, and the lines are written.  A
   record of one line is parsed as it is.  Only lines of longer records are shuffled,
   by record.

A quote opens a field only where the field starts, and a doubled one stands for
itself, so a quote inside a plain field changes nothing.  The place of a line is
its block's start plus the bytes read in it: unique, and in the order of the
file.  Separator and encoding are resolved like the reproduced loader's: comma
before tab, UTF-8 before Latin-1, the first with a header of more than one field
and all quotes closed.

Defined results: blank lines are skipped, also before the header; a line may
end in LF, CRLF or CR; missing fields are null, surplus ones are ignored; a byte
order mark is dropped; an empty file, or one without a usable separator, has an
error instead of columns.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.constants import LABEL_COLS, NA_TOKENS, TEXT_COL_PRIORITY
from textlens.session import cut_lineage

SEPARATORS = (b",", b"\t")
#: The assumptions: (separator, state at the block's start).
CASES = [(sep, state) for sep in SEPARATORS for state in (0, 1)]
#: A header with more bytes than this is none.
HEAD_BYTES = 1 << 20

_SUMMARY = ("file string, block long, valid boolean, ends array<int>, last array<long>, broken array<boolean>, "
            "heads array<binary>, head_at array<long>")
_BLOCK = ("file string, block long, case int, carry long, multiline boolean, sep string, encoding string, names array<string>, "
          "text_at int, label_at int, source_at int, head_at long, error string")
_LINE = "file string, block long, value binary, place long, before int, after int, starts array<long>"


class Quotes:
    """Whether a line leaves a quoted field open, for one separator."""

    def __init__(self, sep: bytes):
        s = re.escape(sep)
        # a carriage return parts fields, too: it may end a record
        self.fields = re.compile(rb'(?:(?:"(?:[^"]++|"")*+"[^%b\r]*+|[^"%b\r][^%b\r]*+|)[%b\r])*+' % (s, s, s, s))
        self.closed = re.compile(rb'"(?:[^"]++|"")*+"')
        self.rest = re.compile(rb'(?:[^"]++|"")*+"[^%b\r]*+[%b\r]?' % (s, s))

    def after(self, line: bytes, state: int) -> int:
        at = 0
        if state:
            m = self.rest.match(line)
            if not m:
                return 1
            at = m.end()
            if at == len(line):
                return 0
        at = self.fields.match(line, at).end()
        return int(line[at:at + 1] == b'"' and not self.closed.match(line, at))


_QUOTES = {sep: Quotes(sep) for sep in SEPARATORS}
_MISSING = frozenset(NA_TOKENS)


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, value, valid): the lines of all files in one scan, in the order of each block."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file"),
                       F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"),
                       F.is_valid_utf8("value").alias("valid"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The parts of a batch that belong to one block each."""
    block = batch["block"].to_numpy()
    file = batch["file"].dictionary_encode()
    new = np.flatnonzero((np.diff(block) != 0) | (np.diff(file.indices.to_numpy()) != 0)) + 1
    for a, b in zip([0, *new], [*new, len(block)]):
        if b > a:
            yield batch["file"][a].as_py(), int(block[a]), batch.slice(a, b - a)


class Walk:
    """Places, states and record starts of a block's lines, batch by batch, under the four assumptions."""

    def __init__(self, block: int):
        # a block but a file's first begins with the rest of a line that the block before has read
        self.at = block + (block > 0)
        self.state = [state for _, state in CASES]
        self.start = [-1] * len(CASES)

    def step(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, before, after, start): the last three with a row per assumption."""
        value, n = part["value"], part.num_rows
        size = pc.binary_length(value).to_numpy().astype(np.int64) + 1
        place = self.at + np.cumsum(size) - size
        self.at += int(size.sum())
        quoted = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
        texts = [value[int(i)].as_py() for i in quoted]
        # only a line with a quote can change the state
        lengths = np.diff([0, *(quoted + 1), n])
        before, after, start = (np.empty((len(CASES), n), np.int64) for _ in range(3))
        for c, (sep, _) in enumerate(CASES):
            states = [self.state[c]]
            for text in texts:
                states.append(_QUOTES[sep].after(text, states[-1]))
            before[c] = np.repeat(states, lengths)
            after[c, :-1], after[c, -1] = before[c, 1:], states[-1]
            start[c] = np.maximum(np.maximum.accumulate(np.where(before[c] == 0, place, -1)), self.start[c])
            self.state[c], self.start[c] = states[-1], int(start[c, -1])
        return place, before, after, start


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block."""
    row, walk, key = None, None, None

    def out():
        row.update(ends=walk.state, last=walk.start)
        return pa.RecordBatch.from_pylist([row], pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("valid", pa.bool_()), ("ends", pa.list_(pa.int32())),
            ("last", pa.list_(pa.int64())), ("broken", pa.list_(pa.bool_())), ("heads", pa.list_(pa.binary())),
            ("head_at", pa.list_(pa.int64()))]))

    for batch in batches:
        for file, block, part in _runs(batch):
            if (file, block) != key:
                if row is not None:
                    yield out()
                key, walk = (file, block), Walk(block)
                row = {"file": file, "block": block, "valid": True, "broken": [False] * len(CASES),
                       "heads": [b"", b""], "head_at": [-1, -1]}
                done = [block > 0, block > 0]
            place, before, after, _ = walk.step(part)
            row["valid"] &= bool(pc.all(part["valid"]).as_py())
            row["broken"] = [old or bool(now.any()) for old, now in zip(row["broken"], after)]
            for i in range(part.num_rows):
                if all(done):
                    break
                line = part["value"][i].as_py()
                for s in range(len(SEPARATORS)):
                    if done[s] or (not row["heads"][s] and not line.strip()):
                        continue
                    row["head_at"][s] = int(place[i]) if row["head_at"][s] < 0 else row["head_at"][s]
                    row["heads"][s] += (b"\n" if row["heads"][s] else b"") + line
                    done[s] = not after[2 * s, i] or len(row["heads"][s]) > HEAD_BYTES
    if row is not None:
        yield out()


def records(text: str, sep: str) -> list[list[str]]:
    """The fields of a text that holds whole records (more than one where a CR ends them)."""
    if '"' not in text and "\r" not in text[:-1]:
        return [text.removesuffix("\r").split(sep)]
    csv.field_size_limit(sys.maxsize)
    return list(csv.reader(io.StringIO(text, newline=""), delimiter=sep))


def resolve_columns(columns: list[str]) -> tuple[str | None, str | None]:
    """P2 text column by priority list; P3 first label column in file order."""
    ranked = {name: rank for rank, name in enumerate(TEXT_COL_PRIORITY)}
    texts = sorted((ranked[c], c) for c in columns if c in ranked)
    labels = [c for c in columns if c in set(LABEL_COLS)]
    return (texts[0][1] if texts else None), (labels[0] if labels else None)


def _resolve(source_col: str):
    def run(table: pa.Table) -> pa.Table:
        """The blocks of one file with their true states; separator, encoding and columns of the file."""
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        valid = all(r["valid"] for r in rows)
        file = {"sep": None, "encoding": "UTF-8" if valid else "ISO-8859-1", "names": [], "text_at": -1, "label_at": -1,
                "source_at": -1, "head_at": -1, "multiline": False,
                "error": "the header has one field, or a quote is never closed, with every separator and encoding tried"}
        cases = [(0, -1)] * len(rows)
        for s, sep in enumerate(SEPARATORS):
            state, carry, walk, broken = 0, -1, [], False
            for r in rows:
                case = 2 * s + state
                walk.append((case, carry))
                broken |= r["broken"][case]
                state, carry = r["ends"][case], r["last"][case] if r["last"][case] >= 0 else carry
            head = rows[0]["heads"][s].decode("utf-8" if valid else "latin-1").removeprefix("﻿")
            found = records(head, sep.decode())
            if state or not found or len(found[0]) < 2:
                continue
            names = found[0]
            lower = [c.lower().strip() for c in names]
            text, label = resolve_columns(lower)
            at = lambda c: lower.index(c) if c in lower else -1
            cases = walk
            file.update(sep=sep.decode(), names=names, text_at=at(text), label_at=at(label), source_at=at(source_col),
                        head_at=rows[0]["head_at"][s], multiline=broken, error=None)
            break
        out = [{"file": r["file"], "block": r["block"], "case": c, "carry": carry, **file} for r, (c, carry) in zip(rows, cases)]
        return pa.Table.from_pylist(out, pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("case", pa.int32()), ("carry", pa.int64()), ("multiline", pa.bool_()),
            ("sep", pa.string()), ("encoding", pa.string()), ("names", pa.list_(pa.string())), ("text_at", pa.int32()),
            ("label_at", pa.int32()), ("source_at", pa.int32()), ("head_at", pa.int64()), ("error", pa.string())]))
    return run


def blocks(spark: SparkSession, paths: list[str], source_col: str) -> DataFrame:
    """First pass: the written table of blocks, one row per block of a file."""
    found = lines(spark, paths).mapInArrow(_summaries, _SUMMARY)
    return cut_lineage(found.groupBy("file").applyInArrow(_resolve(source_col), _BLOCK), "csv-blocks")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with its place, and its state and record start under each assumption."""
    key, walk = None, None
    for batch in batches:
        for file, block, part in _runs(batch):
            if (file, block) != key:
                key, walk = (file, block), Walk(block)
            place, before, after, start = walk.step(part)
            bits = (1 << np.arange(len(CASES)))[:, None]
            ends = pa.array(np.arange(part.num_rows + 1) * len(CASES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part["file"], part["block"], part["value"], pa.array(place), pa.array((before * bits).sum(0), pa.int32()),
                 pa.array((after * bits).sum(0), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(start.T.ravel()))],
                ["file", "block", "value", "place", "before", "after", "starts"])


def record_rows(spark: SparkSession, paths: list[str], known: DataFrame) -> DataFrame:
    """Second pass: (file, place, record, about) of every record from the header on.

    ``known`` has (file, block, case, carry) and, in ``about``, what ``parsed`` needs to know of the file.
    """
    each = lines(spark, paths).drop("valid").mapInArrow(_lines, _LINE).join(known, ["file", "block"])
    bit = lambda c: F.expr(f"(shiftright({c}, case) & 1) = 1")
    start = F.element_at("starts", F.col("case") + 1)
    each = each.select("file", "place", "value", (bit("before") | bit("after")).alias("part"),
                       F.when(start >= 0, start).otherwise(F.col("carry")).alias("start"), "about")
    each = cut_lineage(each, "csv-lines")           # read by both branches below
    whole = each.filter(~F.col("part")).select("file", "place", F.col("value").alias("record"), "about")
    # lines of a longer record meet by its start
    parts = F.array_sort(F.collect_list(F.struct("place", "value")))
    longer = each.filter("part").groupBy("file", "start").agg(parts.alias("p"), F.any_value("about").alias("about"))
    record = F.aggregate(F.slice("p", 2, F.size("p")), F.col("p")[0]["value"], lambda a, x: F.concat(a, F.lit(b"\n"), x["value"]))
    return (whole.unionByName(longer.select("file", F.col("start").alias("place"), record.alias("record"), "about"))
            .filter(F.col("place") >= F.col("about.head_at")))


def _parse(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, places, own, cols = [], [], [], [[] for _ in range(width)]
            for file, place, record, about in zip(*(batch[c].to_pylist() for c in ("file", "place", "record", "about"))):
                sep = about["sep"]
                if not record.strip(b" \r" if sep == "\t" else b" \t\r"):
                    continue
                rows = [row for row in records(record.decode(about["encoding"]), sep) if row]
                # the header goes; where a CR ends it, rows stand beside it
                for i, row in enumerate(rows[place == about["head_at"]:]):
                    files.append(file)
                    places.append(place + i)
                    own.append(about["at"][-1] >= 0)
                    for col, at in zip(cols, about["at"]):
                        col.append(row[at] if 0 <= at < len(row) and row[at] not in _MISSING else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(places, pa.int64()), pa.array(own, pa.bool_()),
                 *(pa.array(c, pa.string()) for c in cols)], ["file", "place", "own", *(f"c{i}" for i in range(width))])
    return run


def parsed(spark: SparkSession, paths: list[str], known: DataFrame, width: int) -> DataFrame:
    """(file, place, own, c0, c1 ...): the fields ``about.at`` of every record, pandas' missing-value tokens as nulls;
    ``own`` says whether the file has the last of these fields."""
    schema = ", ".join(["file string", "place long", "own boolean", *(f"c{i} string" for i in range(width))])
    return record_rows(spark, paths, known).mapInArrow(_parse(width), schema)
