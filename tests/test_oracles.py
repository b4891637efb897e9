"""Every registered query that has SQL gives the same rows as that SQL."""

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check import TABLES, compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return c


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    line = compare(spark, con, name, SF_DIR)
    assert line.startswith("ok"), line
