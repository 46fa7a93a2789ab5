"""Every registered query against its SQL twin at the smallest scale."""

import duckdb
import pytest

from catalog import QUERIES, SQL
from check_oracle import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, con, name):
    status, _, _, note = compare(spark, con, name, SF)
    assert status in ("ok", "rows only"), note


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)
