"""Small data files of a silver month brought together into few.

Each load adds files to the months that it has rows of. The listing tells their sizes; best fit
gathers the small ones into groups of about a target size, and each group is written again as
one file, sorted by key, out of readers' sight. Readers keep the old files until the swap.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, insort
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.schemas import KEY, SILVER, SILVER_PARTITIONS
from millrace.sources.tables import COMPRESSION, KEY_FILTER, exists

#: Bytes of a file that is large enough to be left as it is, and of a group at most.
TARGET_BYTES = 128 << 20

# Spark's listings leave out what begins with an underscore.
_WORK = "_compact"
_PLAN = "folder string, file string, bin int"


def best_fit(sizes: Iterable[tuple[str, int]], target: int) -> list[list[str]]:
    """Groups of names of at most ``target`` bytes, the largest first, each into the group with
    the least room that suffices. All groups but one are more than half full."""
    groups: list[list[str]] = []
    rooms: list[tuple[int, int]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, group = rooms.pop(at)
        else:
            room, group = max(target, size), len(groups)
            groups.append([])
        groups[group].append(name)
        insort(rooms, (room - size, group))
    return groups


def _files(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def _listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the data files in one folder."""
    files, location = _files(spark, path)
    if not files.exists(location):
        return []
    found = [(x.getPath().getName(), x.getLen()) for x in files.listStatus(location) if x.isFile()]
    return [x for x in found if x[0].endswith(".parquet") and x[0][0] not in "._"]


def months_of(spark: SparkSession, silver_path: str) -> list[tuple[int, int]]:
    """The months that have a folder."""
    found = []
    for year in _folders(spark, silver_path, "order_year="):
        found += [(year, x) for x in _folders(spark, f"{silver_path}/order_year={year}", "order_month=")]
    return sorted(found)


def _folders(spark: SparkSession, path: str, start: str) -> list[int]:
    files, root = _files(spark, path)
    names = [x.getPath().getName() for x in files.listStatus(root)] if files.exists(root) else []
    return [int(x[len(start) :]) for x in names if x.startswith(start)]


def compact(
    spark: SparkSession, silver_path: str, months: list[tuple[int, int]] | None = None, target: int = TARGET_BYTES
) -> int:
    """Bring the small files of some months, or of all, together; returns how many files it took
    away.

    Files of at least ``target`` bytes, and small ones that fit with no other, stay. Afterwards a month
    has at most 2 * bytes / target + 1 files smaller than that. Rows are the same, and only what
    is rewritten is read. What comes to the driver is the months' listing.

    A crash loses nothing. Before the plan is written the table is as it was, and what had been
    prepared is dropped; from then on ``settle``, with which each run also begins, completes
    the swap. In between, rows may be met in an old and a new file at once, never in none:
    run merges and reports after it, not beside it.
    """
    settle(spark, silver_path)
    moved = []
    bins = 0
    for year, month in months_of(spark, silver_path) if months is None else months:
        folder = f"order_year={year}/order_month={month}"
        small = [x for x in _listed(spark, f"{silver_path}/{folder}") if x[1] < target]
        for group in best_fit(small, target):
            if len(group) > 1:
                moved += [(folder, name, bins) for name in group]
                bins += 1
    if not bins:
        return 0
    run = f"{silver_path}/{_WORK}/{uuid.uuid4().hex}"
    plan = spark.createDataFrame(moved, _PLAN)
    rows = spark.read.schema(SILVER).option("basePath", silver_path).parquet(*[f"{silver_path}/{x}/{y}" for x, y, _ in moved])
    # Files of one load may have the same name in several months.
    place = F.regexp_extract(F.col("_metadata.file_path"), r"order_year=-?\d+/order_month=\d+/[^/]+$", 0)
    # A group is one task's work and one file: at most the target's bytes.
    (
        rows.withColumn("place", place)
        .join(plan.select(F.concat_ws("/", "folder", "file").alias("place"), "bin"), "place")
        .drop("place", *SILVER_PARTITIONS)
        .repartition(bins, "bin")
        .sortWithinPartitions("bin", KEY)
        .write.options(compression=COMPRESSION, **KEY_FILTER)
        .partitionBy("bin")
        .parquet(f"{run}/rows")
    )
    before, after = rows.count(), spark.read.parquet(f"{run}/rows").count()
    if before != after:
        raise RuntimeError(f"{after} rows written of {before}; {run} is left for a look")
    plan.coalesce(1).write.parquet(f"{run}/plan")
    settle(spark, silver_path)
    return len(moved) - bins


def settle(spark: SparkSession, silver_path: str) -> None:
    """Complete the swaps whose plan is whole, and drop what else was being prepared. May be
    repeated, and go on after a crash of its own."""
    files, work = _files(spark, f"{silver_path}/{_WORK}")
    if not files.exists(work):
        return
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for found in files.listStatus(work):
        run = found.getPath().toString()
        if exists(spark, f"{run}/plan/_SUCCESS"):
            plan = spark.read.schema(_PLAN).parquet(f"{run}/plan").collect()
            folder_of = {r.bin: r.folder for r in plan}
            # All new files stand before the first old one goes.
            for k, folder in sorted(folder_of.items()):
                for name, _ in _listed(spark, f"{run}/rows/bin={k}"):
                    target = f"{silver_path}/{folder}/bin{k}-{name}"
                    if not files.rename(make(f"{run}/rows/bin={k}/{name}"), make(target)):
                        raise RuntimeError(f"{target} could not be put in place")
            for r in plan:
                files.delete(make(f"{silver_path}/{r.folder}/{r.file}"), False)
        files.delete(found.getPath(), True)
