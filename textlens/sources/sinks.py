"""Sinks: CSV/parquet writers (S8, S9) and append-only tables used for the
idempotent upsert (S11) and the batch ledger (S12).

A table is a folder of parquet parts ``<root>/part=<n>``, one per delivery.
A delivery writes its own rows only; nothing delivered before is rewritten.
What the rows mean together (the latest version of a post, the state of a
batch) is an aggregation on read.  A part counts once its ``_SUCCESS`` marker
exists, so a failed write leaves the table as it was.  A delivery that may be
replayed has a ``token``, which its part carries in its name: the replay finds
that part, and writes it only if it is not whole.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.session import cut_lineage


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


class AppendTable:
    """Parts under ``root``; ``current()`` is ``resolve`` of all their rows."""

    def __init__(self, spark: SparkSession, root: str,
                 resolve: Callable[[DataFrame], DataFrame] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.resolve = resolve

    def _folders(self) -> list[tuple[int, str, bool, str]]:
        """(number, token, whole, path) of every part, by number."""
        fs, p, jvm = _fs(self.spark, self.root)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = re.fullmatch(r"part=(\d+)(?:-(.+))?", st.getPath().getName())
            if name:
                done = fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
                out.append((int(name[1]), name[2] or "", done, f"{self.root}/{name[0]}"))
        return sorted(out)

    def parts(self) -> list[int]:
        return [n for n, _, done, _ in self._folders() if done]

    def rows(self) -> DataFrame | None:
        """Every delivered row; None before the first delivery."""
        paths = [path for _, _, done, path in self._folders() if done]
        return self.spark.read.parquet(*paths) if paths else None

    def current(self) -> DataFrame | None:
        rows = self.rows()
        return rows if rows is None or self.resolve is None else self.resolve(rows)

    def last(self) -> int:
        """Highest part number in use, complete or not."""
        return max((n for n, *_ in self._folders()), default=0)

    def part_of(self, token: str) -> int | None:
        """The number under which the delivery ``token`` was begun."""
        return next((n for n, t, *_ in self._folders() if t == token), None)

    def append(self, df: DataFrame, part: int | None = None, token: str | None = None) -> int:
        part = part if part is not None else self.last() + 1
        if token is None:
            df.write.mode("errorifexists").parquet(f"{self.root}/part={part}")
        elif not any(n == part and t == token and done for n, t, done, _ in self._folders()):
            # what a failed attempt of the same delivery left is written anew
            df.write.mode("overwrite").parquet(f"{self.root}/part={part}-{token}")
        return part


def latest_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (ties: any).  ``df`` is read from parquet files.

    The winners are found on narrow rows (key, order, place of the row in its
    file), folded map-side by partial aggregation, so a key replayed many times
    never gathers all its copies in one task.  The whole rows are read a second
    time and only those that win go on (a semi join by place).
    """
    kcols = [F.col(k) if isinstance(k, str) else k for k in keys]
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    narrow = df.select(*[k.alias(f"_k{i}") for i, k in enumerate(kcols)],
                       F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], place.alias("place")).alias("_row"))
    best = narrow.groupBy(*[f"_k{i}" for i in range(len(kcols))]).agg(F.max("_row").alias("_b"))
    rows = df.select(F.struct("*").alias("_row"), place.alias("_place"))
    return rows.join(best.select(F.col("_b.place").alias("_place")), "_place", "left_semi").select("_row.*")


def upsert(current: DataFrame | None, updates: DataFrame, keys: Sequence[Column | str],
           order: Sequence[Column]) -> DataFrame:
    """Merge ``updates`` into ``current``; on a key the latest ``order`` wins."""
    merged = updates if current is None else current.unionByName(updates)
    return latest_per_key(cut_lineage(merged, "upsert"), keys, order)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV (all input columns + results)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_audit_round(df: DataFrame, root: str, stamp: str | None = None) -> str:
    """An audit round in its own ``round=<timestamp>`` folder."""
    stamp = stamp or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/round={stamp}"
    write_csv(df, path)
    return path
