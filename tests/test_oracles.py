"""Every query against its SQL on the smallest shared tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    wanted = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in wanted.description]
    columns = sorted(got.columns)
    assert columns == sorted(names)
    types = {d[0]: str(d[1]) for d in wanted.description}
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in got.schema} == types
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(r[i] for i in order) for r in wanted.fetchall())
    found = Counter(tuple(r[c] for c in columns) for r in got.collect())
    assert found == expected
    assert sum(found.values()) > 0


def test_entry(spark):
    assert len(contract.entry(spark).columns) == 5
