import datetime as dt
from decimal import Decimal

import pytest

from millrace.operators.curate import curate, to_silver
from millrace.operators.merge import merge_into
from millrace.plans.reports import (
    REFERENCE,
    bronze_preview,
    report_month,
    revenue_by_country,
)
from millrace.sources.tables import read_silver


def test_report_month():
    assert report_month(dt.date(1998, 6, 15)) == (1998, 5)
    assert report_month(dt.date(1999, 1, 15)) == (1998, 12)
    assert report_month(dt.date(1998, 6, 15), REFERENCE) == (1998, 5)
    assert report_month(dt.date(1999, 1, 15), REFERENCE) == (1999, 0)
    with pytest.raises(ValueError):
        report_month(dt.date(1999, 1, 15), "other")


@pytest.fixture
def silver(spark, bronze_rows, tmp_path):
    day = lambda y, m, d: {"order_date": dt.date(y, m, d), "ship_date": dt.date(y, m, d)}
    rows = bronze_rows(
        {"country": "A", "total_revenue": 100.0, "total_profit": 33.33, **day(2020, 12, 1)},
        {"country": "A", "total_revenue": 50.0, "total_profit": 0.0, **day(2020, 12, 31)},
        {"country": "B", "total_revenue": 200.0, "total_profit": -10.0, **day(2020, 12, 5)},
        {"country": "A", "total_revenue": 900.0, **day(2020, 11, 5)},
        {"country": "A", "total_revenue": 900.0, **day(2019, 12, 5)},
    )
    path = str(tmp_path / "silver")
    merge_into(curate(rows), path)
    return read_silver(spark, path)


def test_revenue_by_country(silver):
    got = [tuple(r) for r in revenue_by_country(silver, dt.date(2021, 1, 10)).collect()]
    assert got == [
        ("B", Decimal("200.0000"), Decimal("-10.0000"), Decimal("-5.00"), 100),
        ("A", Decimal("150.0000"), Decimal("33.3300"), Decimal("16.67"), 200),
    ]
    assert revenue_by_country(silver, dt.date(2021, 1, 10), REFERENCE).count() == 0


def test_revenue_reads_one_month_and_the_needed_columns(silver):
    plan = revenue_by_country(silver, dt.date(2021, 1, 10))._jdf.queryExecution().executedPlan().toString()
    assert "(order_year" in plan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<country:string,units_sold:int,total_revenue" in plan
    assert "partial_sum" in plan


def test_bronze_preview(bronze_rows):
    stamp = lambda i: dt.datetime(2021, 1, 1, 0, i, tzinfo=dt.timezone.utc)
    rows = bronze_rows(*[{"kafka_offset": i, "ingested_at": stamp(i % 4)} for i in range(40)])
    top = bronze_preview(rows, 12)
    assert [r.kafka_offset for r in top.collect()] == [*range(3, 40, 4), 2, 6]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert to_silver(rows).count() == 40
