"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, collected, normal
from tidemart.plans.batch import batch_queries
from tidemart.plans.streams import stream_queries

FOLDER = "/root/testdata/sf0.001"
# left to check.py for their run time
SLOW = {"stream_day_cards", "stream_layers"}

# the text operators have tests of their own
QUERIES = {**batch_queries(), **stream_queries()}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_equals_sql(spark, duck, name):
    got = normal(collected(QUERIES[name](spark, FOLDER)))
    want = normal(duck.execute(entry_points.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) > 0
    assert got.equals(want)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["dt", "hr", "amount"] and df.count() > 0
