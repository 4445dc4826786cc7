"""Every registered query against its SQL on the smallest tables."""

import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from fleetgrid.plans import load

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return int(value) if isinstance(value, decimal.Decimal) and value == int(value) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(ORACLES[name])
    found = [c[0] for c in result.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    want = sorted((tuple(plain(row[i]) for i in at) for row in result.fetchall()), key=repr)
    assert got == want and got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
