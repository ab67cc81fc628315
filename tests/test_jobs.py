import csv
import datetime as dt

import pytest

from millrace import Settings
from millrace.errors import StrictValidationError
from millrace.operators import audit
from millrace.plans import jobs
from millrace.schemas import KEY
from millrace.sources.tables import read_bronze, read_silver, read_topic

# The columns in the order of another source, and a row of it.
OTHER_ORDER = [
    "Region", "Country", "Item Type", "Sales Channel", "Order Priority", "Order Date",
    "Ship Date", "Order ID", "Units Sold", "Unit Price", "Unit Cost", "Total Revenue",
    "Total Cost", "Total Profit",
]


@pytest.fixture
def lake(tmp_path):
    settings = Settings(root=str(tmp_path), max_rows=20)
    (tmp_path / "landing").mkdir()

    def land(rows):
        with open(settings.landing_file, "w", newline="", encoding="utf-8") as f:
            out = csv.DictWriter(f, fieldnames=OTHER_ORDER)
            out.writeheader()
            out.writerows(rows)

    return settings, land


def row(n, **changes):
    values = [
        "Europe", "France", "Beverages", "Online", "H", "1/3/2020", "1/10/2020", str(n), "10",
        "9.99", "5.50", "99.90", "55.00", "44.90",
    ]
    return {**dict(zip(OTHER_ORDER, values)), **changes}


def test_csv_to_silver_and_replay(spark, lake):
    settings, land = lake
    land([row(n) for n in range(1, 31)])
    assert jobs.publish(spark, settings) == jobs.RunCounts(20, 0)
    assert jobs.load_bronze(spark, settings) == jobs.RunCounts(20, 0)
    counts = jobs.load_silver(spark, settings)
    assert (counts.received, counts.written, counts.skipped) == (20, 20, 0)
    counts = jobs.load_silver(spark, settings)
    assert (counts.written, counts.skipped) == (0, 20)
    silver = read_silver(spark, settings.layer("silver"))
    for r in silver.collect():
        assert (r.order_year, r.order_month, r.lead_time_days) == (2020, 1, 7)
        assert r.margin_pct > 0 and r[KEY].startswith("sales-events-")
        assert r.order_date == dt.date(2020, 1, 3)
    topic, bronze = read_topic(spark, settings.layer("topic")), read_bronze(spark, settings.layer("bronze"))
    assert audit.reconcile(topic, bronze, silver).first().complete


def test_publishing_twice_makes_new_messages(spark, lake):
    settings, land = lake
    land([row(n) for n in range(5)])
    jobs.publish(spark, settings)
    jobs.publish(spark, settings)
    jobs.load_bronze(spark, settings)
    assert jobs.load_silver(spark, settings).written == 10


def test_bad_rows_are_quarantined(spark, lake):
    settings, land = lake
    rows = [row(1), row(2, **{"Order Date": "bad"}), row(3, **{"Ship Date": "1/1/2020"}), row(4)]
    land([*rows, row(5, **{"Units Sold": "x"})])
    assert jobs.publish(spark, settings) == jobs.RunCounts(2, 3)
    aside = spark.read.parquet(f"{settings.layer('quarantine')}/landing")
    assert sorted((r.reject_class, r.reject_field) for r in aside.collect()) == [
        ("BAD_TYPE", "units_sold"), ("INVALID_DATE", "order_date"), ("SCHEMA_RULE", "ship_date"),
    ]


def test_strict_publishing_stops_before_sending(spark, lake):
    settings, land = lake
    land([row(1), row(2, **{"Units Sold": "x"})])
    with pytest.raises(StrictValidationError):
        jobs.publish(spark, settings, on_error="strict")
    assert read_topic(spark, settings.layer("topic")).count() == 0
    land([row(1), row(2, **{"Order Date": "bad"})])
    assert jobs.publish(spark, settings, on_error="strict") == jobs.RunCounts(1, 1)
