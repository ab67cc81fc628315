"""The file-backed topic's numbering: offsets for messages that no broker has numbered.

Numbering a topic partition means ranking all its rows, and with three partitions a
plain window would pull a third of the data into one task. Instead the rows are
range-sorted across the whole cluster, written once, and each sorted slice adds the
number of rows in the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.staging import stage_lean

# monotonically_increasing_id keeps the task number above this many bits.
_ROW_BITS = 33


def route(order_id: Column, partitions: int) -> Column:
    """Topic partition of an order; equal ids always share one."""
    return F.pmod(order_id, F.lit(partitions)).cast("int")


def next_offsets(topic: DataFrame) -> DataFrame:
    """Per topic partition, the offset the next message gets."""
    return topic.groupBy("partition").agg((F.max("offset") + 1).alias("next_offset"))


def number_rows(
    rows: DataFrame,
    group: str,
    order_by: list[Column | str],
    out: str,
    *,
    start: DataFrame | None = None,
) -> DataFrame:
    """Dense positions from 0 inside each ``group``, in ``order_by`` order.

    ``start`` (group, next_offset) continues an existing numbering. Let the order
    end in something unique per row: equal rows cannot be told apart and so stay in
    one slice.
    """
    slot = F.monotonically_increasing_id()
    # Range bounds come from a sample and differ from run to run, so the slices are
    # written before anything is counted over them.
    sliced = stage_lean(
        rows.repartitionByRange(group, *order_by)
        .sortWithinPartitions(group, *order_by)
        .withColumn("_slot", slot),
        "positions",
    )
    slice_id = F.shiftright(F.col("_slot"), _ROW_BITS)
    runs = sliced.groupBy(group, slice_id.alias("_slice")).agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_rows")
    )
    before = (
        Window.partitionBy(group)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = runs.withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    if start is not None:
        bases = (
            bases.join(start, group, "left")
            .withColumn("_base", F.col("_base") + F.coalesce("next_offset", F.lit(0)))
            .drop("next_offset")
        )
    bases = bases.select(group, "_slice", (F.col("_base") - F.col("_first")).alias("_shift"))
    # One row per slice and group: bounded by shuffle partitions + groups, not by data.
    return (
        sliced.withColumn("_slice", slice_id)
        .join(F.broadcast(bases), [group, "_slice"])
        .withColumn(out, F.col("_slot") + F.col("_shift"))
        .drop("_slot", "_slice", "_shift")
    )


def assign_positions(
    sales: DataFrame,
    order_by: list[Column | str],
    *,
    topic: str,
    partitions: int,
    start: DataFrame | None = None,
) -> DataFrame:
    """Route each row by its order id and number it inside its topic partition."""
    routed = sales.withColumn("partition", route(F.col("order_id"), partitions))
    return number_rows(routed, "partition", order_by, "offset", start=start).withColumn(
        "topic", F.lit(topic)
    )
