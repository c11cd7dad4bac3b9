"""Queries that SQL can express, against DuckDB on the small tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL_DIR

from cohortkit.llm.oracle import ORACLE_SQL
from cohortkit.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL_DIR}/{table}.parquet'")
    expected = con.sql(ORACLE_SQL[name])
    cols = sorted(expected.columns)
    got = QUERIES[name](spark, SMALL_DIR)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(con.sql(ORACLE_SQL[name]).project(", ".join(cols)).fetchall(), key=repr)  # nulls have no order


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
