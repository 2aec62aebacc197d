"""Queries that SQL can express, over whole tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from cohortloom.llm.queries import QUERIES, SQL
from .helpers import SMALL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, SMALL)
    columns = sorted(result.columns)
    found = Counter(tuple(row) for row in result.select(*columns).collect())
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    expected = Counter(relation.project(", ".join(columns)).fetchall())
    assert sum(expected.values()) > 0
    assert found == expected


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))
