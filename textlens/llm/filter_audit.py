"""Filter interaction audit by sorted posting lists (operator 13).

Every filter has, per part, a sorted list of the ids that fail it; further
lists hold all ids and those that the labels call good or toxic.  The lists are
dealt by ranges of ids: a task gets a range of every list, in order, and streams
through it in shorter ranges of ``RANGE`` documents.  In a range, what an order
of filters removes at a step is the difference of one filter's list and the
union of the lists before it; differences and unions are computed by galloping
the shorter lists through the longer ones, for each filter and each set of
filters before it (80 of them stand for all 120 orders).  Ranges are disjoint, so
sizes add up, and only 80 rows of sums per part and task are shuffled.

The lists of the text filters come from one pass over the texts; that of the
repeats from an aggregation on the 128-bit identity of the text, joined back;
the good and toxic ones from a semi join with the labels.

Defined results: a null text is empty, a null part is the empty string; rows
that repeat id, part and text are one document; rows that share an id but not
the text or part are documents of their own, each with the labels of the id; a
null id fails no repeat filter, makes no other document a repeat and has no
labels; of several label rows of an id one 1 is enough; an empty table has no
parts, so no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage

FILTERS = "ABCDE"
FULL = (1 << len(FILTERS)) - 1
ALL, GOOD, TOXIC = 5, 6, 7
#: Documents of a range that is counted at once, and parts whose sums a task holds before it hands them on.
RANGE, PARTS = 1 << 16, 1000
#: (filter, set of filters before it) in the order of a task's sums.
PAIRS = [(f, s) for f in range(len(FILTERS)) for s in range(FULL + 1) if not s >> f & 1]


def gallop(within: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted list (of the first value not below it).

    Every key starts from a guess and leaps away from it in doubling steps
    until it has passed its place, then halves the last leap; all keys leap in
    step, so a round is a few operations on arrays.
    """
    n = len(within)
    if not n or not len(keys):
        return np.zeros(len(keys), np.int64)
    spread = max(int(within[-1] - within[0]), 1)
    guess = np.clip((keys - within[0]) * (n - 1) // spread, 0, n - 1)
    up = within[guess] < keys
    low, high = np.where(up, guess, -1), np.where(up, n, guess)     # within[low] < key <= within[high]
    leap = 1
    rising, falling = np.flatnonzero(up), np.flatnonzero(~up)
    while len(rising) or len(falling):
        to = low[rising] + leap
        passed = to >= n
        passed[~passed] = within[to[~passed]] >= keys[rising[~passed]]
        high[rising[passed]] = np.minimum(to[passed], n)
        low[rising[~passed]] = to[~passed]
        rising = rising[~passed]
        to = high[falling] - leap
        passed = to < 0
        passed[~passed] = within[to[~passed]] < keys[falling[~passed]]
        low[falling[passed]] = np.maximum(to[passed], -1)
        high[falling[~passed]] = to[~passed]
        falling = falling[~passed]
        leap *= 2
    while (open_ := high - low > 1).any():
        middle = (low + high) // 2
        below = np.zeros(len(keys), bool)
        below[open_] = within[middle[open_]] < keys[open_]
        low = np.where(open_ & below, middle, low)
        high = np.where(open_ & ~below, middle, high)
    return high


def holds(within: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted list."""
    at = gallop(within, keys)
    out = at < len(within)
    out[out] = within[at[out]] == keys[out]
    return out


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Merge of k sorted lists: the shorter ones gallop through the longest, which is copied in runs between."""
    first, *rest = sorted(lists, key=len, reverse=True)
    for x in rest:
        at = gallop(first, x)
        new = ~((at < len(first)) & (first[np.minimum(at, len(first) - 1)] == x)) if len(first) else np.ones(len(x), bool)
        first = np.insert(first, at[new], x[new])
    return first


def difference(keys: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """The keys that are in none of the lists."""
    for x in lists:
        keys = keys[~(holds(x, keys))] if len(keys) else keys
    return keys


def sums(lists: dict[int, np.ndarray]) -> np.ndarray:
    """(removed, good lost, toxic lost, kept) of each of ``PAIRS`` in one range of one part."""
    none = np.zeros(0, np.int64)
    fails = [lists.get(f, none) for f in range(len(FILTERS))]
    good, toxic, n = lists.get(GOOD, none), lists.get(TOXIC, none), len(lists.get(ALL, none))
    merged = {0: none}
    for s in range(1, FULL + 1):
        low = s & -s
        merged[s] = union([merged[s ^ low], fails[low.bit_length() - 1]])
    left: dict[tuple[int, int], np.ndarray] = {}
    out = np.zeros((len(PAIRS), 4), np.int64)
    for i, (f, s) in enumerate(PAIRS):
        low = s & -s
        # the sets come in ascending order: the smaller one is there already
        left[f, s] = difference(left[f, s ^ low], [fails[low.bit_length() - 1]]) if s else fails[f]
        gone = left[f, s]
        out[i] = (len(gone), holds(good, gone).sum(), holds(toxic, gone).sum(), n - len(merged[s | 1 << f]))
    return out


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task, cut between documents into ranges."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < RANGE:
            continue
        table = pa.Table.from_batches(held)
        last = rows - 1
        edge = [table[c][last].as_py() for c in ("doc_id", "h1", "h2", "part")]
        while last >= 0 and [table[c][last].as_py() for c in ("doc_id", "h1", "h2", "part")] == edge:
            last -= 1       # a document has a row per list at most
        if last >= 0:
            yield table.slice(0, last + 1)
        held = table.slice(last + 1).to_batches()
        rows -= last + 1
    if rows:
        yield pa.Table.from_batches(held)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}

    def out():
        parts = [p for p in total for _ in PAIRS]
        cols = np.concatenate([np.zeros((0, 4), np.int64), *total.values()])
        names = ["part", "filter", "before", "removed", "good_lost", "toxic_lost", "kept"]
        data = [pa.array(parts, pa.string()), pa.array([f for f, _ in PAIRS] * len(total), pa.int32()),
                pa.array([s for _, s in PAIRS] * len(total), pa.int32()), *(pa.array(cols[:, i], pa.int64()) for i in range(4))]
        total.clear()
        return pa.RecordBatch.from_arrays(data, names)

    for table in _ranges(batches):
        part = table["part"].combine_chunks().dictionary_encode()
        names, part = part.dictionary.to_pylist(), part.indices.to_numpy()
        known = table["doc_id"].is_valid().to_numpy()
        doc = table["doc_id"].fill_null(0).to_numpy()
        new = np.ones(len(part), bool)
        new[1:] = part[1:] != part[:-1]
        for x in (known, doc, table["h1"].to_numpy(), table["h2"].to_numpy()):
            new[1:] |= x[1:] != x[:-1]
        # the place of a document in the range stands for it: ids in ascending order
        place, code = np.cumsum(new), table["list"].to_numpy()
        for p, name in enumerate(names):
            own = part == p
            place_p, code_p = place[own], code[own]
            got = sums({c: place_p[code_p == c] for c in range(TOXIC + 1)})
            total[name] = total[name] + got if name in total else got
        if len(total) > PARTS:
            yield out()
    if total:
        yield out()


def failures(text: Column) -> Column:
    """Bits of the text filters A to D that a document fails."""
    words = F.col("_words")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    bad = (n < 100, 100 * distinct < 80 * n, 100 * capitals.cast("long") > 10 * F.length(text).cast("long"), text.rlike("[#$%&*|]"))
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(bad)), F.lit(0))


def lists(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, h1, h2, part, list): a row for each document and list that holds it."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    text = F.col("_text")
    rows = rows.select("doc_id", "part", "_text", F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("_words"))
    facts = rows.select("doc_id", "part", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"),
                        failures(text).alias("fails"))
    key = ["doc_id", "h1", "h2", "part"]
    # texts are read once; repeated rows meet map-side
    facts = cut_lineage(facts.groupBy(*key).agg(F.min("fails").alias("fails")), "facts")
    same = facts.filter("doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # written, so that both sides of the join are dealt anew and a text with very many copies is split
    same = cut_lineage(same.filter("last > first").select("h1", "h2", "first"), "same")
    repeats = facts.join(same, ["h1", "h2"]).filter("doc_id > first")
    own = F.filter(F.array(F.lit(ALL), *(F.when(F.col("fails").bitwiseAND(1 << i) > 0, F.lit(i)) for i in range(4))),
                   lambda x: x.isNotNull())
    out = facts.select(*key, F.explode(own).alias("list")).unionByName(repeats.select(*key, F.lit(4).alias("list")))
    for code, col in ((GOOD, "quality"), (TOXIC, "toxic")):
        marked = labels.filter(F.col(col) == 1).select(F.col(id_col).cast("long").alias("doc_id"))
        out = out.unionByName(facts.join(marked, "doc_id", "left_semi").select(*key, F.lit(code).alias("list")))
    return out


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """A row per part, order of the five filters and step; see the module for the columns' meaning."""
    spark = docs.sparkSession
    # ranges of ids: a part with a third of the documents, or an id with many texts, is spread over tasks
    dealt = lists(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)
    dealt = dealt.repartitionByRange("doc_id", "h1", "h2", "part").sortWithinPartitions("doc_id", "h1", "h2", "part")
    counted = dealt.mapInArrow(_count, "part string, filter int, before int, removed long, good_lost long, toxic_lost long, kept long")
    names = ("removed", "good_lost", "toxic_lost", "kept")
    total = cut_lineage(counted.groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in names)), "sums")
    # orders in which a set of this size stands before the filter
    weight = F.element_at(F.array(*(F.lit(factorial(s) * factorial(len(FILTERS) - 1 - s)) for s in range(len(FILTERS)))),
                          F.bit_count("before") + 1)
    others = F.expr(f"before = {FULL} - shiftleft(1, filter)")
    by_filter = total.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(others, F.col("removed"))).alias("unique_fails"), F.sum(weight * F.col("removed")).alias("shapley"))
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for i, name in enumerate(order):
            f = FILTERS.index(name)
            steps.append(f"('{''.join(order)}', {i + 1}, {f}, {before})")
            before |= 1 << f
    plan = spark.sql(f"select * from values {', '.join(steps)} as t(filter_order, step, filter, before)")
    out = total.join(plan, ["filter", "before"]).join(by_filter, ["part", "filter"])
    return out.select("part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
                      "unique_fails", "good_lost", "toxic_lost", "shapley")
