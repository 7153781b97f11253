"""Every query against its SQL twin, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    assert rows
    if name not in ORACLES:
        # Operators that SQL cannot express are tested against brute force.
        assert name.startswith("op") or name == "pipeline"
        return
    result = sql.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert in_order(rows) == in_order(tuple(r[p] for p in places) for r in result.fetchall())
