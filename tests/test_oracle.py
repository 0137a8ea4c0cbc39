"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from core_helpers import TESTDATA
from roadlens.plans import catalog

QUERIES = {name: run for name, run in entry_point.queries().items() if name in catalog.QUERIES}
ORACLES = entry_point.oracle_sql()
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(TESTDATA):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS "
                    f"SELECT * FROM '{TESTDATA}/{file}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in order] for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name not in ORACLES:
        assert got
        return
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(got, df.columns) == canonical(answer.fetchall(), columns)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["ciudad", "tipo", "total"]
    assert df.count() > 0
