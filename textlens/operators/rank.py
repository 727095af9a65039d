"""O1: a global order as a column, without a window over all rows.

Rows are dealt by ranges of the order and sorted within each range; a row's
rank is its place in the range plus the rows of all ranges before, which is a
running sum over one number per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.session import cut_lineage


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with the place (from 1) of each row in a total order; rows that tie get different places."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)       # counts the rows of a partition
    # written: range and place are made once, for both readers
    rows = cut_lineage(dealt.withColumns({"_range": F.spark_partition_id(), "_place": place}), "ranges")
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))       # a row per partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.join(sizes.select("_range", before.alias("_before")), "_range")
            .withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before"))
