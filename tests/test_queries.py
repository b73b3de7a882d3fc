"""Every query of the catalog against its SQL twin, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract
from millrace import catalog

SF_DIR = "/root/testdata/sf0.001"
NAMES = {query.__name__ for query in catalog.QUERIES}
QUERIES = {k: v for k, v in contract.queries().items() if k in NAMES}
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k in NAMES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    places = [want.columns.index(c) for c in columns]
    expected = sorted(repr(tuple(row[p] for p in places)) for row in want.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(columns).collect()) == expected


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["hash", "text", "url", "timestamp"] and found.count() > 0
