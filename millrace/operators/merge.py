"""Insert-only merge on the message position: stored rows never change, the first
copy of a key wins, and replaying any batch adds nothing."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from millrace.errors import DuplicateKeyError
from millrace.schemas import KEY, SILVER, SILVER_PARTITIONS
from millrace.sources.tables import append_silver, exists, read_silver
from millrace.staging import stage_lean, staging

FIRST_BY = ["bronze_ingested_at", "source_file"]

# Batches up to so many rows look their keys up one by one; the stored files' Bloom filters
# then give about a fifth of the row groups a false hit. Larger ones go by ranges.
LOOKUPS = 2_000
# Rows whose key may repeat are ranked apart from the others where these are so many times as many.
APART = 16
# Parts that all offsets of one length are looked at in.
PARTS = 32


@dataclass(frozen=True)
class MergeCounts:
    """``rejected`` rows cannot be held by silver; ``skipped`` ones are held already."""

    received: int
    written: int
    rejected: int = 0

    @property
    def skipped(self) -> int:
        return self.received - self.written - self.rejected


def first_wins(batch: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per key, the earliest.

    Filtering a row_number to 1 lets Spark keep a single row per key in every map
    task already, so even a key copied into a third of the batch shuffles as a
    handful of rows.
    """
    order = order_by or [c for c in FIRST_BY if c in batch.columns]
    window = Window.partitionBy(KEY).orderBy(*order)
    return batch.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_of_staged(batch: DataFrame, rows: int) -> DataFrame:
    """``first_wins`` for a staged batch of ``rows`` rows, most of whose keys come once.

    Hashes of the keys alone are shuffled to find those that repeat, and whole rows only where
    some do. Two keys of one hash are ranked with the rest, each for itself.
    """
    hashed = batch.withColumn("_key_hash", F.xxhash64(KEY))
    counted = hashed.groupBy("_key_hash").agg(F.count("*").alias("copies")).where("copies > 1")
    repeated = stage_lean(counted, "repeated-keys")
    number = repeated.agg(F.sum("copies")).first()[0]
    if not number:
        return batch
    if number * APART > rows:
        return first_wins(batch)
    alone = hashed.join(repeated, "_key_hash", "left_anti")
    return alone.unionAll(first_wins(hashed.join(repeated, "_key_hash", "left_semi"))).drop("_key_hash")


def inserts(batch: DataFrame, stored_keys: DataFrame, received: int | None = None) -> DataFrame:
    """The rows a merge adds, of a batch of ``received`` rows where that is known.

    Only key columns are compared with what is stored. The keys found new then pick their
    rows: where they are few, by a broadcast that the engine chooses by their size as
    measured, so that nothing but new rows is shuffled; else in one shuffle, which
    ``first_wins`` shares. Where there are as many as rows, these are all new, and stay as they are.
    """
    few = received is not None and received <= LOOKUPS
    near = stored_keys.where(keys_of(batch) if few else near_keys_of(batch))
    fresh = stage_lean(batch.select(KEY).distinct().join(near, KEY, "left_anti"), "fresh-keys")
    if received and fresh.agg(F.count(KEY)).first()[0] == received:
        return batch
    return first_wins(batch.join(fresh, KEY, "left_semi"))


def keys_of(batch: DataFrame) -> Column:
    """A filter for the very keys of a batch of at most ``LOOKUPS`` rows, which come to the
    driver. The scan asks each row group's statistics and Bloom filter for them, so offsets
    scattered over a whole topic read few groups."""
    keys = [r[KEY] for r in batch.select(KEY).distinct().collect()]
    return F.col(KEY).isin(keys) if keys else F.lit(False)


def near_keys_of(batch: DataFrame, parts: int = PARTS) -> Column:
    """A filter that every stored key equal to one of the batch passes.

    Offsets of one length order as text like numbers, so ranges of offsets are ranges of
    keys. Silver files are sorted by key, and the scan skips the pages out of range. Offsets of
    one length are divided evenly, and parts with keys that follow each other are one range: a
    batch of stretches far from each other reads no more than these, a dense one is a
    single test. The parts' ends come to the driver, ``parts`` at most for each topic partition
    and length of its offsets.
    """
    text = F.substring_index(KEY, "-", -1)
    offset = text.cast("bigint")
    stem = F.expr(f"left({KEY}, length({KEY}) - length(substring_index({KEY}, '-', -1)))")
    own = batch.select(stem.alias("stem"), F.length(text).alias("digits"), offset.alias("offset"))
    part = F.floor(F.col("offset") / F.pow(F.lit(10.0), "digits") * parts).alias("part")
    held = (
        own.groupBy("stem", "digits", part)
        .agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
        .collect()
    )
    bounds, before = [], None
    for r in sorted(held, key=lambda r: (r.stem, r.digits, r.part)):
        if before == (r.stem, r.digits, r.part - 1):
            bounds[-1][1] = f"{r.stem}{r.high}"
        else:
            bounds.append([f"{r.stem}{r.low}", f"{r.stem}{r.high}"])
        before = (r.stem, r.digits, r.part)
    return _any([F.col(KEY).between(low, high) for low, high in bounds])


def _any(tests: list[Column]) -> Column:
    """Whether one of them holds, as a tree that is not deep."""
    if len(tests) < 2:
        return tests[0] if tests else F.lit(False)
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:])


def clashes(batch: DataFrame, stored_keys: DataFrame) -> DataFrame:
    """Keys a strict merge refuses: already stored, or more than once in the batch."""
    copies = batch.groupBy(KEY).agg(F.count("*").alias("copies"))
    # Stored twice is stored: a key must not come out once per stored copy.
    stored = stored_keys.select(KEY).distinct().withColumn("stored", F.lit(True))
    return (
        copies.join(stored, KEY, "left")
        .withColumn("stored", F.coalesce("stored", F.lit(False)))
        .where((F.col("copies") > 1) | F.col("stored"))
    )


def in_partitions_of(silver: DataFrame, batch: DataFrame) -> DataFrame:
    """Only the stored months the batch touches.

    The months come back to the driver; their number is bounded by the calendar, and
    as literals they prune the scan.
    """
    months = defaultdict(list)
    for year, month in batch.select(*SILVER_PARTITIONS).distinct().collect():
        months[year].append(month)
    touched = [
        (F.col("order_year") == y) & F.col("order_month").isin(*ms) for y, ms in months.items()
    ]
    return silver.where(reduce(lambda a, b: a | b, touched, F.lit(False)))


def merge_into(
    batch: DataFrame, path: str, *, strict: bool = False, same_partitions: bool = False
) -> MergeCounts:
    """Append the unseen rows of ``batch`` to the silver table at ``path``.

    Rows with a ``reject_class`` are counted and left out. The batch is evaluated once, into
    a staged copy that all later steps read.

    ``same_partitions`` compares with the batch's own months only. That is exact while
    a position keeps one order date; a re-created topic reuses positions, so it is off
    by default.

    A crash before the commit leaves the table as it was; one during it may leave some
    of the files, whose rows the next attempt finds stored.
    """
    with staging(batch.sparkSession):
        rows, counts = stage_counted(batch, "merge-batch")
        return merge_staged(rows, counts, path, strict=strict, same_partitions=same_partitions)


def stage_counted(batch: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
    """The staged batch, and its rows and rejects as counted while it was written."""
    seen = Observation(name)
    bad = F.col("reject_class").isNotNull() if "reject_class" in batch.columns else F.lit(False)
    rows = stage_lean(
        batch.observe(seen, F.count(F.lit(1)).alias("received"), F.count_if(bad).alias("rejected")), name
    )
    return rows, seen.get


def merge_staged(
    rows: DataFrame, counts: dict[str, int], path: str, *, strict: bool = False, same_partitions: bool = False
) -> MergeCounts:
    """``merge_into`` for what ``stage_counted`` returned."""
    spark = rows.sparkSession
    if "reject_class" in rows.columns:
        rows = rows.where("reject_class is null")
    silver = read_silver(spark, path)
    if same_partitions:
        silver = in_partitions_of(silver, rows)
    stored_keys = silver.select(KEY)
    if strict:
        number, first = clashes(rows, stored_keys).agg(F.count("*"), F.min(KEY)).first()
        if number:
            raise DuplicateKeyError(number, first)
    seen = Observation("merge")
    number = counts["received"] - counts["rejected"]
    # Counted in the writing stage itself, where a retried task counts once.
    append_silver(
        (inserts(rows, stored_keys, number) if exists(spark, path) else first_of_staged(rows, number)).select(*SILVER.fieldNames()),
        path,
        observe=(seen, F.count(F.lit(1)).alias("written")),
    )
    return MergeCounts(counts["received"], seen.get["written"], counts["rejected"])
