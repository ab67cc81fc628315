import datetime as dt
import itertools
import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.schemas import BRONZE, HEADERS  # noqa: E402
from samples import STABLE_ROW, STAMP  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("millrace-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def csv_rows(spark):
    """Raw landing rows: the pinned row with some fields changed."""

    def make(*changes):
        rows = [{**STABLE_ROW, **change} for change in changes]
        schema = ", ".join(f"`{h}` string" for h in HEADERS)
        return spark.createDataFrame([[r[h] for h in HEADERS] for r in rows], schema)

    return make


@pytest.fixture
def landing_rows(spark):
    """``n`` raw landing rows with distinct order ids, all good."""

    def make(n, seed=0):
        k = F.col("id") + seed * 7919
        day = F.date_add(F.lit(dt.date(2016, 2, 1)), (k * 37 % 2000).cast("int"))
        units, price, cost = 1 + k * 31 % 900, 200 + k * 17 % 5000, 100 + k * 13 % 90
        values = [
            F.col("id") + seed * 1_000_000, F.concat(F.lit("region "), k % 5), F.concat(F.lit("country "), k % 25),
            F.concat(F.lit("item "), k % 9), F.element_at(F.array(F.lit("Online"), F.lit("Offline")), (k % 2 + 1).cast("int")),
            F.lit("M"), day, F.date_add(day, (k % 50).cast("int")), units, price / 4, cost / 4, units * price / 4,
            units * cost / 4, units * (price - cost) / 4,
        ]
        return spark.range(0, n, 1, 4).select(*[v.cast("string").alias(h) for v, h in zip(values, HEADERS)])

    return make


@pytest.fixture
def bronze_rows(spark):
    """Bronze rows with distinct positions unless they are given."""
    numbers = itertools.count()

    def make(*changes):
        rows = []
        for change in changes:
            base = dict(
                order_id=1, region="Europe", country="France", item_type="Beverages",
                sales_channel="Online", priority="H", order_date=dt.date(2020, 1, 3),
                ship_date=dt.date(2020, 1, 10), units_sold=100, unit_price=9.99, unit_cost=5.5,
                total_revenue=999.0, total_cost=550.0, total_profit=449.0,
                kafka_topic="sales-events", kafka_partition=0, kafka_offset=next(numbers),
                kafka_timestamp_ms=1609459200000, ingested_at=STAMP, source_file="file.csv",
            )
            rows.append({**base, **change})
        names = BRONZE.fieldNames()
        return spark.createDataFrame([[r[n] for n in names] for r in rows], BRONZE)

    return make


@pytest.fixture
def constant_bronze(bronze_rows):
    """Give a frame the bronze columns it lacks, each with one value throughout."""

    def make(rows):
        base = bronze_rows({})
        values = base.first()
        return rows.select(
            *[
                F.col(f.name) if f.name in rows.columns else F.lit(values[f.name]).cast(f.dataType).alias(f.name)
                for f in base.schema
            ]
        )

    return make
