"""The standard questions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.money import exact_mean

PREVIOUS = "previous"
REFERENCE = "reference"


def report_month(as_of: date, mode: str = PREVIOUS) -> tuple[int, int]:
    """The month before ``as_of``. ``reference`` keeps the year and takes one from the
    month, so it names a month 0 every January."""
    if mode == REFERENCE:
        return as_of.year, as_of.month - 1
    if mode != PREVIOUS:
        raise ValueError(f"unknown mode {mode!r}")
    return (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)


def silver_month(silver: DataFrame, year: int, month: int) -> DataFrame:
    """One month, pruned to its partition."""
    return silver.where((F.col("order_year") == year) & (F.col("order_month") == month))


def revenue_by_country(silver: DataFrame, as_of: date, mode: str = PREVIOUS) -> DataFrame:
    """Revenue, profit, mean margin and units per country, highest revenue first.

    The margin is the plain mean of the rows' margins, not profit over revenue.
    """
    return (
        silver_month(silver, *report_month(as_of, mode))
        .groupBy("country")
        .agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_profit").alias("total_profit"),
            exact_mean(F.col("margin_pct"), 2).cast("decimal(18,2)").alias("avg_margin_pct"),
            F.sum("units_sold").alias("total_units"),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )


def bronze_preview(bronze: DataFrame, rows: int = 100) -> DataFrame:
    """The latest raw rows; the position breaks ties.

    The stamp of the last row wanted is found from one column and then filters the scan
    of all the others, which skips every row group that ends before it.
    """
    latest = bronze.select("ingested_at").orderBy(F.desc("ingested_at")).limit(rows)
    oldest = latest.agg(F.min("ingested_at")).scalar()
    return (
        bronze.where(F.col("ingested_at") >= oldest)
        .orderBy(F.desc("ingested_at"), "kafka_topic", "kafka_partition", "kafka_offset")
        .limit(rows)
    )
