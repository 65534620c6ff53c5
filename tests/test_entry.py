"""Driver contract: entry() smoke, and every queries() entry against its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans.registry import QUERIES
from strata.sources.tables import DRIVER_TABLES, table_path
from tools.check_oracle import _digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "order_id" in df.columns and "is_weekend" in df.columns


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # every query of the library's own operators has an oracle
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows)[0] == _digest(dcols, drows)[0]
