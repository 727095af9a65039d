"""Whole-number vectors for exact inner products (operators 11 and 12)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A component x counts as floor(SCALE * x).
SCALE = 256


def usable(vector: Column) -> Column:
    """A vector that is there and holds finite components only."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole(vector: Column, bits: int) -> Column:
    """floor(256 * x) of every component, held within the bound that keeps any inner product below 2 ** bits."""
    bound = F.floor(F.sqrt(F.lit(2.0 ** bits) / F.greatest(F.size(vector), F.lit(1)))).cast("double")
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x * float(SCALE), bound), -bound)).cast("long"))


def one_per_id(df: DataFrame, *, id_col: str, vector_col: str, label_col: str | None = None, bits: int) -> DataFrame:
    """(vec_id, v) or (vec_id, label, v) of the rows that take part; an id with several rows counts with the
    smallest of them (by label, then vector)."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"),
                     (F.lit("") if label_col is None else F.col(label_col).cast("string")).alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    rows = rows.withColumn("v", whole(F.col("v"), bits))
    least = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s"))
    return least.select("vec_id", *([] if label_col is None else [F.col("s.label").alias("label")]), F.col("s.v").alias("v"))


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold all of them, and how many these are."""
    least, most = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= least and most < 1 << 8 * w - 1)
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def widened(data: pa.BinaryScalar | bytes) -> np.ndarray:
    """The numbers of ``narrow``, 8 bytes each."""
    data = data if isinstance(data, bytes) else data.as_buffer()
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)
