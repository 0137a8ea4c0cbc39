"""The registered queries with SQL against DuckDB, and that whole tables are answered."""

import os

import duckdb
import pytest

from roadlens.llm import queries as Q
TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(TESTDATA):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{TESTDATA}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    answer = duck.execute(Q.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, answer.fetchall()))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize(("name", "rows"), [("op1_dom_crf", "pages"), ("op2_kneser_ney", "documents"), ("op5_separator_scan", "documents"),
                                            ("op6_naive_bayes", "documents"), ("op7_label_propagation", "documents"), ("op8_byte_bpe", "documents"), ("op13_elias_fano", "documents")])
def test_whole_tables(spark, sf, name, rows):
    assert Q.QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/{rows}.parquet").count()
