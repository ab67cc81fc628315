import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.errors import StrictValidationError
from millrace.operators.validate import (
    judge_landing,
    rejected,
    require_strict,
    run_counters,
    valid,
)
from millrace.schemas import SALES


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_pinned_row_is_typed(csv_rows):
    row = one(valid(judge_landing(csv_rows({}))))
    assert (row.order_id, row.region, row.country) == (123456, "Europe", "France")
    assert (row.order_date, row.ship_date) == (dt.date(2010, 1, 3), dt.date(2010, 2, 9))
    assert (row.units_sold, row.unit_price, row.total_profit) == (250, 9.99, 1122.5)


def test_schema_of_valid_rows(csv_rows):
    got = valid(judge_landing(csv_rows({}))).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in SALES]


def test_both_date_formats(csv_rows):
    rows = csv_rows(
        {"Order Date": "12/31/2020", "Ship Date": "1/15/2021"},
        {"Order Date": "2020-06-15", "Ship Date": "2020-06-20"},
    )
    got = {(r.order_date, r.ship_date) for r in valid(judge_landing(rows)).collect()}
    assert got == {
        (dt.date(2020, 12, 31), dt.date(2021, 1, 15)),
        (dt.date(2020, 6, 15), dt.date(2020, 6, 20)),
    }


REJECTS = [
    ({"Order Date": "not-a-date"}, "INVALID_DATE", "order_date", "not-a-date"),
    ({"Ship Date": ""}, "INVALID_DATE", "ship_date", ""),
    ({"Ship Date": None}, "INVALID_DATE", "ship_date", "None"),
    ({"Order Date": "6/1/2020", "Ship Date": "1/1/2020"}, "SCHEMA_RULE", "ship_date", "2020-01-01"),
    ({"Order ID": "abc"}, "BAD_TYPE", "order_id", "abc"),
    ({"Units Sold": "1e3"}, "BAD_TYPE", "units_sold", "1e3"),
    ({"Unit Price": ""}, "BAD_TYPE", "unit_price", ""),
    # More than one rule broken: dates first, then their order, then types as declared.
    ({"Order Date": "x", "Ship Date": "y"}, "INVALID_DATE", "order_date", "x"),
    ({"Order Date": "x", "Units Sold": "y"}, "INVALID_DATE", "order_date", "x"),
    ({"Order ID": "x", "Ship Date": "y"}, "INVALID_DATE", "ship_date", "y"),
    (
        {"Order ID": "x", "Order Date": "6/1/2020", "Ship Date": "1/1/2020"},
        "SCHEMA_RULE",
        "ship_date",
        "2020-01-01",
    ),
    ({"Total Cost": "x", "Units Sold": "y"}, "BAD_TYPE", "units_sold", "y"),
]


def test_reject_classes_and_precedence(csv_rows):
    rows = csv_rows(*[r[0] for r in REJECTS]).withColumn("n", F.monotonically_increasing_id())
    got = [
        (r.reject_class, r.reject_field, r.reject_value)
        for r in rejected(judge_landing(rows, keep=["n"])).orderBy("n").collect()
    ]
    assert got == [r[1:] for r in REJECTS]


def test_reject_reasons(csv_rows):
    rows = csv_rows(
        {"Order Date": "bad"}, {"Order Date": "6/1/2020", "Ship Date": "1/1/2020"}
    )
    reasons = {r.reject_reason for r in rejected(judge_landing(rows)).collect()}
    assert reasons == {
        "expected format MM/DD/YYYY or YYYY-MM-DD, got 'bad'",
        "ship_date 2020-01-01 is before order_date 2020-06-01",
    }


def test_ship_on_order_day_and_negative_revenue_are_fine(csv_rows):
    rows = csv_rows({"Ship Date": "1/3/2010"}, {"Total Revenue": "-5.00"})
    assert valid(judge_landing(rows)).count() == 2


def test_empty_text_is_valid(csv_rows):
    rows = csv_rows({"Region": "", "Country": None})
    row = one(valid(judge_landing(rows)))
    assert (row.region, row.country) == ("", "")


def test_missing_column_rejects_every_row(csv_rows):
    rows = csv_rows({}, {"Order Date": "bad"}).drop("Ship Date", "Order ID")
    got = rejected(judge_landing(rows)).collect()
    assert [(r.reject_class, r.reject_field) for r in got] == [("MISSING_COLUMN", "Order ID")] * 2
    assert "missing" in got[0].reject_reason


def test_counters_and_strict_mode(csv_rows):
    judged = judge_landing(csv_rows({}, {}, {"Order Date": "bad"}))
    assert tuple(one(run_counters(judged))) == (2, 1)
    require_strict(judged)
    halting = judge_landing(csv_rows({}, {"Units Sold": "x"}, {"Units Sold": "y"}))
    with pytest.raises(StrictValidationError) as error:
        require_strict(halting)
    assert error.value.counts == {"BAD_TYPE": 2}


def test_filter_on_the_verdict_does_not_repeat_the_typing(csv_rows):
    plan = valid(judge_landing(csv_rows({})))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert len(filters) == 1 and "RLIKE" not in filters[0]
