"""Every query against its SQL twin, value by value."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA

SQL = entry.oracle_sql()


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in values))


def oracle(sql, folder):
    with duckdb.connect() as db:
        for name in os.listdir(folder):
            path = os.path.join(folder, name)
            db.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS FROM '{path}'")
        result = db.execute(sql)
        return [d[0] for d in result.description], result.fetchall()


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name, scale):
    folder = f"{TESTDATA}/{scale}"
    ours = entry.queries()[name](spark, folder)
    columns, expected = oracle(SQL[name], folder)
    assert sorted(ours.columns) == sorted(columns)
    found = rows(ours.columns, ours.collect())
    assert len(found) == len(expected)
    assert found == rows(columns, expected)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1000
