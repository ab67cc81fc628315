import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from millrace.functions.money import exact_mean
from millrace.operators.curate import curate, overflowed, to_silver
from millrace.schemas import KEY, SILVER

from samples import STAMP


def test_schema(bronze_rows):
    got = to_silver(bronze_rows({})).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in SILVER]


def test_derived_fields(bronze_rows):
    rows = bronze_rows(
        {"kafka_partition": 1, "kafka_offset": 99},
        {"order_date": dt.date(2019, 11, 5), "ship_date": dt.date(2019, 11, 5), "kafka_offset": 2},
    )
    a, b = to_silver(rows, dt.datetime(2021, 5, 5, tzinfo=dt.timezone.utc)).collect()
    assert (a.lead_time_days, a.order_year, a.order_month) == (7, 2020, 1)
    assert (b.lead_time_days, b.order_year, b.order_month) == (0, 2019, 11)
    assert a[KEY] == "sales-events-1-99"
    assert a.bronze_ingested_at == STAMP.replace(tzinfo=None)
    assert a.silver_transformed_at == dt.datetime(2021, 5, 5)
    assert a.unit_price == Decimal("9.9900") and isinstance(a.unit_price, Decimal)


def test_transform_stamp_is_now(bronze_rows):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    got = to_silver(bronze_rows({})).first().silver_transformed_at
    assert before <= got <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


# Pinned margins; the middle three come out one cent lower on doubles.
MARGINS = [
    (1000.0, 250.0, "25.00"),
    (0.0, 0.0, "0.00"),
    (0.0, 10.0, "0.00"),
    (100.0, 33.33, "33.33"),
    (333.33, 111.11, "33.33"),
    (1_000_000.0, 123_456.78, "12.35"),
    (46740.48, 21909.6, "46.88"),
    (52280.0, 26858.85, "51.38"),
    (216000.0, 118530.0, "54.88"),
    (100.0, -33.335, "-33.34"),
    (-100.0, 50.0, "-50.00"),
    (1.0, 99.9999, "9999.99"),
]


def test_margins(bronze_rows):
    rows = bronze_rows(
        *[{"total_revenue": r, "total_profit": p, "kafka_offset": i} for i, (r, p, _) in enumerate(MARGINS)]
    )
    got = [str(r.margin_pct) for r in to_silver(rows).orderBy(KEY).collect()]
    by_key = sorted(range(len(MARGINS)), key=lambda i: f"sales-events-0-{i}")
    assert got == [MARGINS[i][2] for i in by_key]


def test_margin_matches_decimal_on_many_rows(spark, constant_bronze):
    rows = spark.range(20000).select(
        F.col("id").alias("kafka_offset"),
        (F.pmod(F.xxhash64("id"), F.lit(10_000_000)) / 100).alias("total_revenue"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000_000)) / 100 - 30000).alias("total_profit"),
    )
    bronze = constant_bronze(rows.where("total_revenue > 400"))
    got = to_silver(bronze).select("total_revenue", "total_profit", "margin_pct").collect()
    assert len(got) > 15000
    for row in got:
        exact = row.total_profit / row.total_revenue * 100
        assert row.margin_pct == exact.quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_amounts_that_do_not_fit(bronze_rows):
    rows = bronze_rows(
        {"total_revenue": 1.0, "total_profit": 100.0, "kafka_offset": 0},
        {"total_revenue": 0.0001499, "total_profit": 0.0148, "kafka_offset": 1},
        {"unit_price": 1e14, "kafka_offset": 2},
        {"unit_price": 99999999999999.0, "kafka_offset": 3},
        {"unit_price": 1.00005, "kafka_offset": 4},
    )
    assert {tuple(r) for r in overflowed(rows).collect()} == {
        ("sales-events-0-0", "MARGIN_OVERFLOW"),
        ("sales-events-0-1", "MARGIN_OVERFLOW"),
        ("sales-events-0-2", "MONEY_OVERFLOW"),
    }
    kept = {r[KEY]: r.unit_price for r in to_silver(rows).collect()}
    assert kept["sales-events-0-4"] == Decimal("1.0001")
    assert curate(rows).count() == 5


def test_mean_is_rounded_once(spark):
    rows = spark.range(1_000_000).select(
        F.when(F.col("id") < 333_333, Decimal("12.36")).otherwise(Decimal("12.34")).cast("decimal(6,2)").alias("m")
    )
    total = 333_333 * Decimal("12.36") + 666_667 * Decimal("12.34")
    exact = (total / 1_000_000).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert rows.agg(exact_mean(F.col("m"), 2).cast("decimal(6,2)")).first()[0] == exact
