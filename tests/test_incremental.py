"""Answers kept up to date by batches, late rows and repeated batches included, against one run over all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from roadlens.operators import access, dedup, incremental, ordered

BIG = 1 << 60


def data(n=240, seed=6):
    draw = random.Random(seed)
    return [(draw.choice([i, i, i, i, None, BIG + i, -i]), "hot" if i % 3 == 0 else draw.choice(["a", None, "b"]), draw.choice(["x", "y", None]))
            for i in range(n)]


@pytest.mark.parametrize("width", [1 << 40, 50, 7])
def test_any_order_of_arrival(spark, tmp_path, width):
    rest = data()
    random.Random(1).shuffle(rest)
    df = spark.createDataFrame(rest, "seq bigint, k string, v string")
    history = incremental.PreviousByPieces(spark, str(tmp_path / "h"), df.schema, ["k"], "seq", "v", width)
    for number, (a, b) in enumerate([(0, 100), (100, 180), (180, 180), (180, 240)]):
        part = spark.createDataFrame(rest[a:b], df.schema)
        history.add(part, number)
        if number == 1:
            history.add(part, number)  # once more, after a crash
        so_far = spark.createDataFrame(rest[:b], df.schema)
        assert rows(history.answers()) == rows(ordered.previous_in_key(so_far, ["k"], "seq", "v"))
    assert rows(incremental.change_only(history)) == rows(dedup.change_only(df, ["k"], "seq", "v"))


def test_settled_pieces_are_left_alone(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 7).cast("string").alias("k"), (F.col("id") % 3).alias("v"))
    history = incremental.PreviousByPieces(spark, str(tmp_path / "h"), df.schema, ["k"], "seq", "v", 100)
    assert history.add(df.filter("seq != 250"), 0) == list(range(10))
    assert history.add(df.filter("seq = 250"), 1) == [2, 3]  # its own piece, and the key's next one
    assert rows(history.answers()) == rows(ordered.previous_in_key(df, ["k"], "seq", "v"))


def test_late_accesses(spark, tmp_path):
    start = dt.datetime(2025, 1, 1)
    draw = random.Random(3)
    rest = [(i, draw.choice("abc"), start + dt.timedelta(seconds=5 * i)) for i in range(90)]
    df = spark.createDataFrame(rest, "seq bigint, k string, ts timestamp_ntz")
    history = incremental.PreviousByPieces(spark, str(tmp_path / "h"), df.schema, ["k"], "seq", "ts", 10)
    for number, part in enumerate((df.filter("seq % 4 != 1"), df.filter("seq % 4 = 1"))):
        history.add(part, number)
    assert rows(incremental.ttl_access(history, 12)) == rows(access.ttl_access(df, "k", "seq", "ts", 12))
