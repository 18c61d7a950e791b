"""Every named query against its SQL on the same tables."""

import math

import duckdb
import pytest

from pageloom.plans import all_queries
from pageloom.plans.registry import query

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES = all_queries()


def tidy(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(tidy(row[i])) for i in order) for row in rows)


@pytest.fixture(scope="module")
def engine(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf, engine):
    built = QUERIES[name].build(spark, sf)
    rows = [tuple(r) for r in built.collect()]
    if QUERIES[name].sql is None:
        assert rows
        return
    expected = engine.sql(QUERIES[name].sql)
    assert sorted(built.columns) == sorted(expected.columns)
    assert sorted_rows(built.columns, rows) == sorted_rows(expected.columns, expected.fetchall())
    assert rows


def test_names_are_unique():
    with pytest.raises(ValueError):
        query("u02_domain")(lambda spark, sf: None)
