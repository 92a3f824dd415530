"""The registered queries of the subpackage against their SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from candlespark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    got, expected = queries.QUERIES[name](spark, SF), duck.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(expected.columns)
    rows = sorted(repr(tuple(r)) for r in got.select(*expected.columns).collect())
    assert rows == sorted(repr(r) for r in expected.fetchall())
