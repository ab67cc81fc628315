"""Revenue by country and month as partial sums, one part for each data file of silver.

Silver only grows by files that never change, so a file's sums are true for good: a replay adds
no file and hence no sums, a late month adds its own, and a file that is gone counts no more.
Sums may lag behind: files without them are read as they are, so every report equals one
over silver itself.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.plans.reports import PREVIOUS, report_month
from millrace.schemas import SILVER, SILVER_PARTITIONS
from millrace.settings import Settings
from millrace.sources.tables import COMPRESSION, exists
from millrace.staging import stage, staging

SUMS = (
    "file string, countries array<struct<country: string, revenue: decimal(38,4), profit: decimal(38,4), "
    "margin: decimal(38,2), row_count: bigint, units: bigint>>, order_year int, order_month int"
)

# A data file's place below the table: its month and name.
_PLACE = r"order_year=(-?\d+)/order_month=(\d+)/[^/]+$"


def data_files(spark: SparkSession, silver_path: str, folder: str = "") -> DataFrame:
    """(path, file) of silver's data files, or of those in one folder below it, by the listing
    alone."""
    root = f"{silver_path}/{folder}" if folder else silver_path
    if not exists(spark, root):
        return spark.createDataFrame([], "path string, file string")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(root)
    return listed.select("path", F.regexp_extract("path", _PLACE, 0).alias("file")).where("file <> ''")


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """A row per data file. Two refreshes at once may have summed a file twice, alike."""
    if not exists(spark, path):
        return spark.createDataFrame([], SUMS)
    return spark.read.schema(SUMS).parquet(path)


def sums_of(spark: SparkSession, silver_path: str, paths: list[str]) -> DataFrame:
    """The sums of some data files. Tasks sum their own rows first: what is shuffled is a row
    per file and country. A file's sums are a single row, which is written whole or not at
    all."""
    if not paths:
        return spark.createDataFrame([], SUMS)
    rows = spark.read.schema(SILVER).option("basePath", silver_path).parquet(*paths)
    file = F.regexp_extract(F.col("_metadata.file_path"), _PLACE, 0).alias("file")
    by_country = rows.groupBy(file, *SILVER_PARTITIONS, "country").agg(
        F.sum("total_revenue").cast("decimal(38,4)").alias("revenue"),
        F.sum("total_profit").cast("decimal(38,4)").alias("profit"),
        F.sum(F.col("margin_pct").cast("decimal(18,2)")).cast("decimal(38,2)").alias("margin"),
        F.count("margin_pct").alias("row_count"),
        F.sum("units_sold").alias("units"),
    )
    one = F.struct("country", "revenue", "profit", "margin", "row_count", "units")
    return by_country.groupBy("file", *SILVER_PARTITIONS).agg(F.collect_list(one).alias("countries")).select("file", "countries", *SILVER_PARTITIONS)


def refresh(spark: SparkSession, settings: Settings) -> int:
    """Sum the data files that have no sums yet, and no others; returns how many. It may run after
    each merge, now and then, or again after a crash at any step.

    The paths of files that came since the last refresh are handed to the reader, which lists
    them on the driver as it lists any table's.
    """
    silver, path = settings.layer("silver"), settings.layer("sums")
    with staging(spark):
        known = read_sums(spark, path).select("file")
        late = stage(data_files(spark, silver).join(known, "file", "left_anti"), "late-files")
        paths = [r.path for r in late.select("path").collect()]
        if not paths:
            return 0
        seen = Observation("sums")
        new = sums_of(spark, silver, paths).hint("rebalance", *[F.col(c) for c in SILVER_PARTITIONS])
        (
            new.observe(seen, F.count(F.lit(1)).alias("n"))
            .write.mode("append")
            .option("compression", COMPRESSION)
            .partitionBy(*SILVER_PARTITIONS)
            .parquet(path)
        )
        return seen.get["n"]


def _parts(spark: SparkSession, settings: Settings, folder: str, stored: DataFrame) -> DataFrame:
    """Sums of the files that are there now: those stored, and those of late files."""
    silver = settings.layer("silver")
    files = data_files(spark, silver, folder)
    late = files.join(stored.select("file"), "file", "left_anti").select("path").collect()
    held = stored.dropDuplicates(["file"]).join(files.select("file"), "file", "left_semi")
    return held.unionByName(sums_of(spark, silver, [r.path for r in late]))


def _totals(parts: DataFrame, *keys: str) -> DataFrame:
    """Sums of sums; the mean margin is rounded once, from its exact sum and count."""
    mean = F.sum("margin").cast("decimal(38,18)") / F.sum("row_count")
    return (
        parts.select(*SILVER_PARTITIONS, F.inline("countries"))
        .groupBy(*keys)
        .agg(
            F.sum("revenue").cast("decimal(28,4)").alias("total_revenue"),
            F.sum("profit").cast("decimal(28,4)").alias("total_profit"),
            F.round(mean, 2).cast("decimal(18,2)").alias("avg_margin_pct"),
            F.sum("units").alias("total_units"),
        )
    )


def revenue_by_country(spark: SparkSession, settings: Settings, as_of: date, mode: str = PREVIOUS) -> DataFrame:
    """``reports.revenue_by_country`` from the sums: of silver only the month's listing is read,
    and those of its files that have no sums."""
    year, month = report_month(as_of, mode)
    stored = read_sums(spark, settings.layer("sums")).where((F.col("order_year") == year) & (F.col("order_month") == month))
    parts = _parts(spark, settings, f"order_year={year}/order_month={month}", stored)
    return _totals(parts, "country").orderBy(F.desc("total_revenue"), "country")


def revenue_by_month(spark: SparkSession, settings: Settings) -> DataFrame:
    """The same figures for every month and country there is."""
    return _totals(_parts(spark, settings, "", read_sums(spark, settings.layer("sums"))), *SILVER_PARTITIONS, "country")
