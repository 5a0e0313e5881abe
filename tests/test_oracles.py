"""Every registered query against its SQL in DuckDB on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_oracles import normal  # noqa: E402
from locusframe.plans import ORACLES, QUERIES  # noqa: E402
from locusframe.plans.registry import TABLES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    mine = normal(QUERIES[name](spark, SF).toPandas())
    theirs = normal(con.execute(ORACLES[name]).df())
    assert list(mine.columns) == list(theirs.columns)
    assert mine.to_dict("records") == theirs.to_dict("records")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"break_regression"}))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).columns
