"""The rank of every row in a total order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.staging import stage

#: Rows that a slice of the order holds, about.
SLICE_ROWS = 250_000


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with its rows' places in ``order``, from 0 without gaps.

    Rows are range-partitioned on the whole order, so a value that many rows share is cut by
    the later columns. Each sorted slice is staged with its rows' places in it; then a row
    adds the number of rows in the slices before its own. What is broadcast is a number a
    slice. The order must tell apart all rows that differ, then ranks don't depend on how
    it is cut.
    """
    slices = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SLICE_ROWS))
    # A row's id holds its slice above bit 33 and its place in the slice below.
    at = F.monotonically_increasing_id()
    sliced = stage(
        df.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slice", F.shiftright(at, 33))
        .withColumn("_place", at.bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked-slices",
    )
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_rows"))
    before = sizes.select(
        "_slice",
        F.coalesce(F.sum("_rows").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    return (
        sliced.join(F.broadcast(before), "_slice")
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_slice", "_place", "_before")
    )
