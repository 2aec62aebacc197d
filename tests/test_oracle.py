"""Every registered query against its SQL on DuckDB, over whole tables."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from query_catalog import CATALOG

FOLDER = "/root/testdata/sf0.01"
TABLES = ("customer", "nation", "orders", "lineitem", "part")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(CATALOG) <= set(queries())
    assert set(CATALOG) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    found = Counter(tuple(row) for row in result.select(*columns).collect())
    relation = duck.sql(oracle_sql()[name])
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(relation.project(picked).fetchall())
    assert sum(expected.values()) > 0
    assert found == expected
