"""Sales rows from a star schema of orders and line items.

Stands in for a landing file where only the relational tables are at hand. Money is
worked out in whole cents, so that any engine gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What numbers the messages: unique per line item.
MESSAGE_ORDER = [
    "order_id",
    "_partkey",
    "_suppkey",
    "_linenumber",
    "_shipdate",
    "_extendedprice",
    "_row_index",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents_text(cents: Column) -> Column:
    size = F.abs(cents)
    parts = [
        F.when(cents < 0, "-").otherwise(""),
        ((size - size % 100) / 100).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((size % 100).cast("string"), 2, "0"),
    ]
    return F.concat(*parts)


def sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV-shaped row of text per line item, plus the columns that order them.

    Even orders write dates as M/D/YYYY, odd ones as YYYY-MM-DD.
    """
    lineitem = _table(spark, sf_dir, "lineitem")
    lineitem = lineitem.withColumn("_row_index", F.col("_metadata.row_index"))
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    part = _table(spark, sf_dir, "part")
    # Orders find their country before they meet their line items, which are many more and so
    # are dealt out for two joins only, and last by the key that keeps an order's lines together.
    placed = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey).repartition("l_orderkey")
    joined = lines.join(placed, lineitem.l_orderkey == orders.o_orderkey)
    revenue = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent = (
        F.lit(105) - F.round(F.col("l_discount") * 100) - F.round(F.col("l_tax") * 100) * 5
    ).cast("bigint")
    rows = joined.select(
        "*",
        F.col("l_quantity").cast("int").alias("_units"),
        revenue.alias("_revenue"),
        percent.alias("_percent"),
    )
    rows = rows.withColumn("_cost", F.expr("(_revenue * _percent) div 100"))
    slashed = F.col("l_orderkey") % 2 == 0

    def date_text(c: str) -> Column:
        day = F.col(c).cast("date")
        return F.when(
            slashed, F.concat_ws("/", F.month(day), F.dayofmonth(day), F.year(day))
        ).otherwise(day.cast("string"))

    priority = F.substring("o_orderpriority", 1, 1)
    return rows.select(
        F.col("l_orderkey").cast("string").alias("Order ID"),
        F.col("r_name").alias("Region"),
        F.col("n_name").alias("Country"),
        F.col("p_type").alias("Item Type"),
        F.when(F.col("l_linestatus") == "O", "Online").otherwise("Offline").alias("Sales Channel"),
        F.when(priority == "1", "C")
        .when(priority == "2", "H")
        .when(priority == "3", "M")
        .otherwise("L")
        .alias("Order Priority"),
        date_text("o_orderdate").alias("Order Date"),
        date_text("l_shipdate").alias("Ship Date"),
        F.col("_units").cast("string").alias("Units Sold"),
        _cents_text(F.expr("(2 * _revenue + _units) div (2 * _units)")).alias("Unit Price"),
        _cents_text(F.expr("(2 * _cost + _units) div (2 * _units)")).alias("Unit Cost"),
        _cents_text(F.col("_revenue")).alias("Total Revenue"),
        _cents_text(F.col("_cost")).alias("Total Cost"),
        _cents_text(F.col("_revenue") - F.col("_cost")).alias("Total Profit"),
        F.col("l_orderkey").alias("_orderkey"),
        F.col("l_partkey").alias("_partkey"),
        F.col("l_suppkey").alias("_suppkey"),
        F.col("l_linenumber").alias("_linenumber"),
        F.col("l_shipdate").alias("_shipdate"),
        F.col("l_extendedprice").alias("_extendedprice"),
        "_row_index",
    )
