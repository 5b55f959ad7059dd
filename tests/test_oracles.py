"""Every query against its SQL counterpart in DuckDB."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from logfreight.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(name, spark, folder, database):
    frame = entry.queries()[name](spark, folder)
    got = rows_of(frame.columns, frame.collect())
    result = database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(columns, result.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    for field in frame.schema.fields:
        assert KINDS[field.dataType.simpleString()] == kinds[field.name], field.name
    assert len(got) > 0
    assert len(got) == len(expected)
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    assert not wrong, (len(wrong), wrong[:3])
