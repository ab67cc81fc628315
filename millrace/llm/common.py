"""What the operators of this package share: text batches inside tasks, session settings."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that Spark hands to a Python worker at a time.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20
#: Bytes of text that the numpy passes take at a time; what they hold besides is a
#: small multiple of it.
SLICE_BYTES = 1 << 20

#: The white space between words, as bytes.
WHITE = b"\t\n\x0b\x0c\r "


def tune(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Keep the batches that Python workers get small, so that long texts fit."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def drop_shuffles(spark: SparkSession) -> None:
    """Have executors delete the shuffle files of frames that nothing refers to any more.
    Spark does so when the driver collects its garbage, which between the rounds of one
    operator it may not do for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def id_remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``. A null id counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def hash_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most ``n`` rows: the first by the hash of ``columns``, among those below twice
    the hash that would leave ``n`` of them. So no task sends or gets many more."""
    share = min(1.0, 2 * n / max(1, df.count()))
    hashed = df.withColumn("hash", F.xxhash64(*columns))
    below = F.col("hash") <= F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)
    return hashed.where(below).orderBy("hash", *columns).limit(n)


def letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, one after another, and the n + 1 offsets
    of its rows in them; no copies are made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that together hold at most ``most`` bytes; a longer row stands
    alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: whatever else the frame
    has, or what it is called, can't clash."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))
