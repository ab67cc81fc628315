import datetime as dt

import pytest
from hypothesis import given, settings as hsettings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.coerce import parse_date, to_double, to_integer

# What strptime makes of each text under the two formats.
DATES = {
    "1/3/2010": "2010-01-03",
    "01/03/2010": "2010-01-03",
    "12/31/2020": "2020-12-31",
    "2020-06-15": "2020-06-15",
    "2010-1-3": "2010-01-03",
    "1/ 3/2010": "2010-01-03",
    "2010-01- 3": "2010-01-03",
    "1/3/0999": "0999-01-03",
    "0001-01-01": "0001-01-01",
    "2/29/2020": "2020-02-29",
    "0000-01-01": None,
    "2/29/2021": None,
    "2/30/2010": None,
    "13/1/2010": None,
    "00/5/2010": None,
    "1/00/2010": None,
    "1/3/10": None,
    "1/3/12010": None,
    "1/3/+12010": None,
    "1/3/-2010": None,
    "-2010-1-3": None,
    "1/3/2010 ": None,
    " 1/3/2010": None,
    "1/3/2010\n": None,
    "1/ 03/2010": None,
    " 1/ 3/2010": None,
    "001/3/2010": None,
    "2010-1-3T": None,
    "2010-01": None,
    "2010": None,
    "2010/1/3": None,
    "1-3-2010": None,
    "1/３/2010": None,
    "not-a-date": None,
    "": None,
    None: None,
}

INTEGERS = {
    "250": 250,
    "250.0": 250,
    "250.00": 250,
    " 7 ": 7,
    "\t7\n": 7,
    "\xa07": 7,
    "+5": 5,
    "-5": -5,
    "007": 7,
    "0.0": 0,
    "-0": 0,
    "-250.0": -250,
    "1_000": 1000,
    "1_0.0": 10,
    "2147483647": 2147483647,
    "2147483648": None,
    "1e3": None,
    "1__0": None,
    "_1": None,
    "1_": None,
    "1.0_0": None,
    "250.": None,
    "250.5": None,
    ".0": None,
    "- 5": None,
    "--5": None,
    "0x1": None,
    "1,000": None,
    "1 0": None,
    "５": None,
    "true": None,
    "": None,
    "  ": None,
    None: None,
}

DOUBLES = {
    "9.99": 9.99,
    " 9.99 ": 9.99,
    "1e3": 1000.0,
    "1E+3": 1000.0,
    ".5": 0.5,
    "5.": 5.0,
    "+5": 5.0,
    "-5.25": -5.25,
    "1_000.5": 1000.5,
    "1_0": 10.0,
    "1e1_0": 1e10,
    "1.0E7": 1e7,
    "9.99d": None,
    "5f": None,
    "0x1p3": None,
    "nan": None,
    "inf": None,
    "Infinity": None,
    "1e999": None,
    "9" * 400: None,
    "1e": None,
    ".": None,
    "9,99": None,
    "_1": None,
    "1__0": None,
    "１": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize(
    "cases, convert",
    [
        (DATES, lambda c: parse_date(c).cast("string")),
        (INTEGERS, lambda c: to_integer(c, T.IntegerType())),
        (DOUBLES, to_double),
    ],
    ids=["dates", "integers", "doubles"],
)
def test_pinned_conversions(spark, cases, convert):
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.v for r in rows.select("t", convert(F.col("t")).alias("v")).collect()}
    assert got == cases


def test_long_range(spark):
    rows = spark.createDataFrame(
        [("9223372036854775807",), ("9223372036854775808",)], "t string"
    )
    got = [r[0] for r in rows.select(to_integer(F.col("t"), T.LongType())).collect()]
    assert got == [9223372036854775807, None]


def _strptime(text):
    for fmt in ("%m/%d/%Y", "%Y-%m-%d"):
        try:
            return dt.datetime.strptime(text, fmt).date()
        except ValueError:
            pass
    return None


@hsettings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="0123456789/- ", min_size=6, max_size=10), min_size=200, max_size=400))
def test_dates_agree_with_strptime(spark, noise):
    shaped = [f"{a}/{b}/{c}" for a, b, c in zip(noise[0::3], noise[1::3], noise[2::3])]
    shaped += [f"{i % 14}/{i % 33}/{1990 + i % 40}" for i in range(500)]
    shaped += [f"{1990 + i % 40}-{i % 14:02d}-{i % 33:02d}" for i in range(500)]
    texts = sorted(set(noise + shaped))
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.d for r in rows.select("t", parse_date(F.col("t")).alias("d")).collect()}
    assert got == {t: _strptime(t) for t in texts}
