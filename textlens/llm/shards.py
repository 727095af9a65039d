"""Sharding by minimax contiguous partition (operator 4).

Texts are the groups that must stay together.  They are put in the order of
their md5, and neighbours that share its first 16 bits form one atom, so there
are ``ATOMS`` ordered atoms at most however many texts there are (about 2,700
for each of 24 shards, which bounds what the cuts can be off by).  The smallest
capacity for which a greedy pass over the atoms needs no more shards than asked
for is found by binary search, and the same pass gives the cuts.

Only DataFrame functions are used: the search is one expression over the
array of atom sizes (at most ``ATOMS`` of them, in one row).  Slots count up within
an atom and a salt of the id, and are shifted by counts, so no task gets a
whole shard or a whole group of copies.

Defined results: a null text has size 8, crc 0 and is one group with the other
null texts; rows that repeat an id are placed each; null ids are allowed; with
fewer atoms than shards some shards are empty; an empty table gives an empty
result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import cut_lineage

ATOMS, SALTS = 1 << 16, 64
ROW_BYTES = 8


def cuts(atoms: DataFrame, shards: int) -> DataFrame:
    """(capacity, cuts): one row; ``cuts`` has the first atom of every shard but the first.

    ``atoms`` has (atom, bytes), one row per atom.
    """
    one = atoms.agg(F.array_sort(F.collect_list(F.struct("atom", "bytes"))).alias("a")).filter("size(a) > 0")
    one = one.selectExpr("a", "a.bytes as s")
    need = ("aggregate(s, named_struct('n', 1, 'f', 0L), (acc, x) -> if(acc.f + x <= {c}, "
            "named_struct('n', acc.n, 'f', acc.f + x), named_struct('n', acc.n + 1, 'f', x)), acc -> acc.n)")
    total = "aggregate(s, 0L, (t, x) -> t + x)"
    # 63 halvings bring any range of longs to one value
    search = (f"aggregate(sequence(1, 63), named_struct('lo', greatest(array_max(s), {total} div {shards}), 'hi', {total}), "
              f"(r, i) -> if(r.lo >= r.hi, r, if({need.format(c='(r.lo + (r.hi - r.lo) div 2)')} <= {shards}, "
              "named_struct('lo', r.lo, 'hi', r.lo + (r.hi - r.lo) div 2), "
              "named_struct('lo', r.lo + (r.hi - r.lo) div 2 + 1, 'hi', r.hi))), r -> r.lo)")
    one = one.selectExpr("a", f"{search} as capacity")
    cut = ("aggregate(a, named_struct('f', 0L, 'c', cast(array() as array<bigint>)), (acc, x) -> "
           "if(acc.f + x.bytes <= capacity, named_struct('f', acc.f + x.bytes, 'c', acc.c), "
           "named_struct('f', x.bytes, 'c', concat(acc.c, array(x.atom)))), acc -> acc.c)")
    return one.selectExpr("capacity", f"{cut} as cuts")


def place(docs: DataFrame, *, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, size, text_crc32, shard, slot)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10))
        .cast("long").alias("atom"),
        F.pmod(F.xxhash64(id_col), F.lit(SALTS)).alias("salt"))
    # narrow rows, used by the cuts, the counts and the placement: written once
    rows = cut_lineage(rows, "sizes")
    found = cuts(rows.groupBy("atom").agg(F.sum("size").alias("bytes")), shards).first()
    shard = F.lit(0)
    for c in found["cuts"] if found else []:
        shard = shard + (F.col("atom") >= F.lit(c)).cast("int")
    counts = rows.groupBy("atom", "salt").agg(F.count(F.lit(1)).alias("n")).withColumn("shard", shard)
    shift = counts.selectExpr("atom", "salt", "shard", "sum(n) over (partition by shard order by atom, salt) - n as shift")
    ranked = rows.selectExpr("*", "row_number() over (partition by atom, salt order by doc_id, text_crc32) - 1 as place")
    return ranked.join(shift, ["atom", "salt"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("shift") + F.col("place")).cast("long").alias("slot"))
