"""Reading the driver tables, written intermediates, and bounded bitmaps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.session import cut_lineage

__all__ = ["bitmap", "cut_lineage", "marked", "pieces", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pieces(docs: DataFrame, text_col: str, each: int, factor: int = 1) -> int:
    """How many partitions give about ``each`` bytes of text apiece."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total * factor // each + 1)


def bitmap(df: DataFrame, position: str, bits: int) -> bytes:
    """A bitmap of ``bits`` bits (a fixed size, so safe to hold and send); bit ``position`` (0 to bits - 1) is set.

    Built by partial bitmap aggregation in the executors; the driver gets
    bits / 32768 rows of 4 KB at most, whatever the input.
    """
    # Spark numbers positions from 1: bucket 1 holds 1 to 32768
    x = f"({position}) + 1"
    rows = (df.groupBy(F.expr(f"bitmap_bucket_number({x})").alias("k"))
              .agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({x}))").alias("b")).collect())
    out = bytearray(bits // 8)
    for r in rows:
        at = (r["k"] - 1) * 4096
        out[at:at + 4096] = bytes(r["b"])[:len(out) - at]
    return bytes(out)


def marked(bits: bytes):
    """Whether a ``bitmap`` has the bit of a position."""
    @F.pandas_udf("boolean")
    def have(position: pd.Series) -> pd.Series:
        at = position.to_numpy(np.int64)
        return pd.Series(np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7) & 1 > 0)
    return have
