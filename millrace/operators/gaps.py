"""Completeness of message positions by their gaps, without joining layers by key.

Offsets of a topic partition fall into buckets of 32,768. One aggregation makes a bitmap of
each bucket, 4 KB whatever number of rows it stands for, so no task holds a partition and
map tasks send bitmaps, not rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.schemas import KEY

POSITION = ["topic", "partition"]


def message_positions(messages: DataFrame) -> DataFrame:
    return messages.select("topic", "partition", "offset")


def bronze_positions(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset")
    )


def silver_positions(silver: DataFrame) -> DataFrame:
    """Positions from the keys, of which the first part is the topic, however many hyphens it has."""
    part = F.substring_index(KEY, "-", -2)
    return silver.select(
        F.expr(f"left({KEY}, length({KEY}) - length(substring_index({KEY}, '-', -2)) - 1)").alias("topic"),
        F.substring_index(part, "-", 1).cast("int").alias("partition"),
        F.substring_index(part, "-", -1).cast("bigint").alias("offset"),
    )


def _buckets(positions: DataFrame) -> DataFrame:
    """(topic, partition, bucket, rows, low, high, bits): what each bucket holds. Offsets are
    never negative."""
    offset = F.col("offset")
    return positions.groupBy(*POSITION, F.expr("offset div 32768").alias("bucket")).agg(
        F.count("*").alias("rows"),
        F.min("offset").alias("low"),
        F.max("offset").alias("high"),
        F.bitmap_construct_agg((offset % 32768).cast("bigint")).alias("bits"),
    )


def _inner_gaps(buckets: DataFrame) -> DataFrame:
    """The gaps between offsets of one bucket. Only buckets with any are looked into."""
    holes = F.col("high") - F.col("low") + 1 > F.bitmap_count("bits")
    kept = buckets.where(holes).select(*POSITION, "bucket", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, first, last = [], [], []
            for k, (bucket, bits) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("bits").to_pylist(), strict=True)):
                held = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
                ends = np.flatnonzero(np.diff(held) > 1)
                rows += [k] * len(ends)
                first += (bucket * 32768 + held[ends] + 1).tolist()
                last += (bucket * 32768 + held[ends + 1] - 1).tolist()
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("topic").take(at), batch.column("partition").take(at), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                names=[*POSITION, "first_missing", "last_missing"],
            )

    return kept.mapInArrow(run, "topic string, partition int, first_missing long, last_missing long")


def _outer_gaps(buckets: DataFrame) -> DataFrame:
    """The gaps from one bucket's last offset to the first of the next that has any. The window
    sees a row per 32,768 offsets."""
    before = F.lag("high").over(Window.partitionBy(*POSITION).orderBy("bucket"))
    return (
        buckets.select(*POSITION, "low", before.alias("before"))
        .where("low > before + 1")
        .select(*POSITION, (F.col("before") + 1).alias("first_missing"), (F.col("low") - 1).alias("last_missing"))
    )


def _end_gaps(buckets: DataFrame, bounds: DataFrame) -> DataFrame:
    """What lacks before the first and after the last offset, or altogether, by ``bounds``
    (topic, partition, first, last): a row per topic partition on both sides."""
    held = buckets.groupBy(*POSITION).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    both = bounds.join(held, POSITION, "left")
    nothing = F.col("low").isNull()

    def gap(first: Column, last: Column, test: Column) -> Column:
        return F.when(test, F.struct(first.cast("bigint").alias("first_missing"), last.cast("bigint").alias("last_missing")))

    first, last, low, high = (F.col(c) for c in ("first", "last", "low", "high"))
    ends = F.array(
        gap(first, last, nothing & (first <= last)), gap(first, F.least(low - 1, last), low > first), gap(F.greatest(high + 1, first), last, high < last)
    )
    return both.select(*POSITION, F.explode(F.array_compact(ends)).alias("gap")).select(*POSITION, "gap.*")


def bounds_of(positions: DataFrame) -> DataFrame:
    """(topic, partition, first, last) of the offsets there are."""
    return positions.groupBy(*POSITION).agg(F.min("offset").alias("first"), F.max("offset").alias("last"))


def missing_ranges(positions: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """(topic, partition, first_missing, last_missing): the stretches of offsets that are not
    there, between the first and last offset of each topic partition or, where they are given,
    between the ``bounds`` (topic, partition, first, last). Positions outside the bounds do no
    harm. Rows without a whole position count for nothing."""
    whole = positions.where(F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull())
    if bounds is not None:
        own = bounds.select(*POSITION, F.col("first").alias("_first"), F.col("last").alias("_last"))
        whole = whole.join(F.broadcast(own), POSITION).where(F.col("offset").between(F.col("_first"), F.col("_last"))).drop("_first", "_last")
    buckets = _buckets(whole)
    gaps = _inner_gaps(buckets).unionByName(_outer_gaps(buckets))
    return gaps if bounds is None else gaps.unionByName(_end_gaps(buckets, bounds))


def range_report(**layers: DataFrame) -> DataFrame:
    """A row per layer and topic partition: rows, distinct offsets, further copies, the ends,
    and whether nothing between them is missing. Each layer is read once and nothing but its
    positions."""
    out = None
    for name, positions in layers.items():
        own = _buckets(positions).groupBy(*POSITION).agg(
            F.sum("rows").alias("row_count"),
            F.sum(F.bitmap_count("bits")).alias("offsets"),
            F.min("low").alias("first"),
            F.max("high").alias("last"),
        )
        own = own.select(
            F.lit(name).alias("layer"), *POSITION, "row_count", "offsets", (F.col("row_count") - F.col("offsets")).alias("copies"),
            "first", "last", (F.col("last") - F.col("first") + 1 == F.col("offsets")).alias("complete"),
        )
        out = own if out is None else out.unionByName(own)
    return out
