"""Operators with row order against brute force, with one key holding many of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from roadlens.operators import access, dedup, ordered


def hot_rows(n=600, seed=3):
    """A third of the rows share one key; the key may be null."""
    draw = random.Random(seed)
    order = list(range(n))
    draw.shuffle(order)
    return [(i, "hot" if i % 3 == 0 else draw.choice(["a", "b", None, "c"]),
             draw.choice(["x", "y", None])) for i in order]


@pytest.mark.parametrize("chunk_rows", [1, 7, 100, 10_000])
def test_previous_in_key(spark, chunk_rows):
    data = hot_rows()
    df = spark.createDataFrame(data, "seq bigint, k string, v string").repartition(5)
    last, expected = {}, []
    for seq, k, v in sorted(data):
        expected.append((seq, k, v, k not in last, last.get(k)))
        last[k] = v
    got = ordered.previous_in_key(df, ["k"], "seq", "v", chunk_rows)
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("chunk_rows", [1, 50, 10_000])
def test_change_only_does_not_depend_on_chunks(spark, tables, chunk_rows):
    raw = tables["raw"]
    assert rows(dedup.change_only(raw, chunk_rows=chunk_rows)) == rows(dedup.change_only(raw))


@pytest.mark.parametrize("chunk_rows", [1, 9, 10_000])
def test_running_total(spark, chunk_rows):
    data = [(i, (i * 37) % 11) for i in range(300)]
    df = spark.createDataFrame(data, "seq bigint, v bigint").repartition(4)
    total, expected = 0, []
    for i, v in data:
        total += v
        expected.append((i, v, total))
    assert rows(ordered.running_total(df, "seq", "v", "t", chunk_rows)) == sorted(expected, key=repr)


def test_with_rank(spark):
    ids = random.Random(5).sample(range(10_000), 500)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(6)
    expected = [(i, rank) for rank, i in enumerate(sorted(ids))]
    assert rows(ordered.with_rank(df, ["id"])) == sorted(expected, key=repr)


def test_with_rank_of_nothing(spark):
    assert ordered.with_rank(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("limit", [1000, 2])
def test_top_n_per_group(spark, limit):
    data = hot_rows()
    df = spark.createDataFrame(data, "seq bigint, k string, v string").repartition(7)
    expected = []
    for key in {k for _, k, _ in data}:
        expected += sorted(r for r in data if r[1] == key)[:5]
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    try:
        got = rows(ordered.top_n_per_group(df, ["k"], [F.col("seq")], 5))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == sorted(expected, key=repr)


def test_copies_of_one_row(spark):
    df = spark.createDataFrame([("hot", 1)] * 400 + [("b", 2)] * 3, "k string, v bigint").repartition(8)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", 10)
    try:
        got = ordered.top_n_per_group(df, ["k"], [F.col("v")], 50)
        assert rows(got.groupBy("k").count()) == [("b", 3), ("hot", 50)]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_dedup_is_idempotent_and_ignores_input_order(spark, tables):
    once = dedup.dedup_minute(tables["filtered"])
    assert rows(dedup.dedup_minute(once)) == rows(once)
    shuffled = tables["filtered"].orderBy(F.rand(1)).repartition(3)
    assert rows(dedup.dedup_minute(shuffled)) == rows(once)


def test_upsert_keeps_the_last_value(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), (None, 1, "z")],
                               "k string, seq bigint, v string")
    assert rows(dedup.upsert_latest(df, ["k"], "seq")) == sorted(
        [("a", 3, None), (None, 1, "z")], key=repr)


def test_offset_fetch(spark, tables):
    raw = tables["raw"]
    order = sorted(r.row_id for r in raw.select("row_id").collect())
    for skip in (0, 900):
        assert access.offset_fetch(raw, ["row_id"], skip).first().row_id == order[skip]
    assert access.offset_fetch(raw, ["row_id"], 10**9).count() == 0


@pytest.mark.parametrize("spacing", [1, 10**7])
def test_chunks_follow_rows_not_numbers(spark, spacing):
    """A third of the rows on one key; no window group exceeds a chunk by much."""
    df = (spark.range(3000).select((F.col("id") * spacing).alias("seq"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(
        (F.col("id") % 17).cast("string")).alias("k"), (F.col("id") % 5).alias("v")))
    cuts = ordered._cuts(df, "seq", 100)
    sizes = [r["count"] for r in ordered._chunked(df, "seq", cuts).groupBy("_chunk").count().collect()]
    assert 20 <= len(sizes) <= 31 and max(sizes) <= 200
    got = rows(ordered.previous_in_key(df, ["k"], "seq", "v", 100))
    assert got == rows(ordered.previous_in_key(df, ["k"], "seq", "v"))
    total = ordered.running_total(df, "seq", "v", "t", 100)
    assert rows(total) == rows(ordered.running_total(df, "seq", "v", "t"))


def test_draws_depend_only_on_number_and_seed(spark):
    first = rows(access.draws(spark, 1000, 7))
    assert first == rows(access.draws(spark, 1000, 7).repartition(3))
    assert first != rows(access.draws(spark, 1000, 8))
    values = [u for _, u in first]
    assert all(0 <= u < 1 for u in values)
    assert abs(sum(values) / 1000 - 0.5) < 0.05


def test_exponential_ranks_stay_inside_and_decay(spark):
    table = spark.range(500).select(F.col("id").alias("row_id"))
    ranks = access.sampled_ranks(access.draws(spark, 20_000, 1), table, "exponential")
    low, high, below = ranks.agg(F.min("rank"), F.max("rank"),
                                 F.avg((F.col("rank") < 100).cast("double"))).first()
    assert low == 0 and high <= 499
    # One mean of the law is a fifth of the table.
    assert abs(below - (1 - 2.718281828 ** -1) / (1 - 2.718281828 ** -5)) < 0.02
    assert access.sampled_ranks(access.draws(spark, 10, 1), table.filter("false")).count() == 0


def test_repeat_and_ttl(spark):
    schema = "seq bigint, k string, ts timestamp"
    accesses = [("a", 0), ("a", 10), ("b", 11), ("a", 21), ("a", 30)]
    data = spark.createDataFrame(
        [(i, k, dt.datetime.fromtimestamp(s)) for i, (k, s) in enumerate(accesses)], schema)
    assert rows(access.repeat_access(data, "k")) == [(5, 3, 2)]
    for chunk_rows in (1, 2, 100):
        hits = access.ttl_access(data, "k", "seq", "ts", 10, chunk_rows)
        assert [r.hit for r in hits.orderBy("seq").collect()] == [False, True, False, False, True]


BIG = 1 << 60


def awkward_numbers(n=200, seed=4):
    """Rows without a number, with equal ones and with numbers beyond 2**53; some values are missing."""
    draw = random.Random(seed)
    return [(draw.choice([None, i // 3, BIG + i, BIG + i // 2, -i]), draw.choice("ab") if i % 3 else "hot", draw.choice([1, 2, 3, None]))
            for i in range(n)]


@pytest.mark.parametrize("chunk_rows", [1, 20, 10**6])
def test_no_row_is_lost_by_chunks(spark, chunk_rows):
    data = awkward_numbers()
    df = spark.createDataFrame(data, "seq bigint, k string, v bigint").repartition(5)
    place = lambda r: (r[0] is not None, r[0] or 0, r[2] is not None, r[2] or 0)
    last, expected = {}, []
    for seq, k, v in sorted(data, key=place):
        expected.append((seq, k, v, k not in last, last.get(k)))
        last[k] = v
    assert rows(ordered.previous_in_key(df, ["k"], "seq", "v", chunk_rows)) == sorted(expected, key=repr)
    totals = {s: sum(v or 0 for t, _, v in data if t is None or (s is not None and t <= s)) for s, _, _ in data}
    got = rows(ordered.running_total(df, "seq", "v", "t", chunk_rows))
    assert got == sorted(((s, k, v, totals[s]) for s, k, v in data), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 1000])
def test_cuts_below(spark, n):
    cuts = sorted(random.Random(n).sample(range(BIG, BIG + 5 * n), n))
    asked = [c + d for c in cuts for d in (-1, 0, 1)] + [0, -5, 1 << 62]
    df = spark.createDataFrame([(x,) for x in asked], "x bigint")
    assert rows(df.select("x", ordered.cuts_below(F.col("x"), cuts))) == sorted(((x, sum(c <= x for c in cuts)) for x in asked), key=repr)


@pytest.mark.parametrize("enough", [1, 30, 10**6])
def test_offset_by_range_counts(spark, enough):
    """Several columns, missing and equal first values, every place, against a sort of all rows."""
    draw = random.Random(8)
    data = [(draw.choice([None, "a", "b", "c", f"x{i}"]), draw.choice([None, i]), i) for i in range(300)]
    df = spark.createDataFrame(data, "s string, n bigint, id bigint").repartition(6).cache()
    low = lambda v: (v is not None, v or "")
    order = sorted(data, key=lambda r: (low(r[0]), (r[1] is not None, r[1] or 0), r[2]))
    for skip in (0, 1, 57, 149, 298, 299):
        assert rows(access.offset_fetch(df, ["s", "n", "id"], skip, enough)) == [order[skip]]
    assert access.offset_fetch(df, ["s", "n", "id"], 300, enough).count() == 0
    assert access.offset_fetch(df.filter("id < 0"), ["id"], 0, enough).count() == 0
    copies = spark.range(500).selectExpr("1 AS k").repartition(4)
    assert access.offset_fetch(copies, ["k"], 400, enough).count() == 1


def test_only_the_range_of_the_position_is_sorted(spark, tmp_path):
    spark.range(20_000).repartitionByRange(10, "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    inside, position = ordered.range_of_position(df, ["id"], 15_777, 500)
    assert inside.count() <= 1000 and inside.orderBy("id").collect()[position].id == 15_777
    text = inside._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "GreaterThanOrEqual(id" in text and "LessThanOrEqual(id" in text


def test_ranked_layout(spark, tmp_path):
    ids = random.Random(5).sample(range(100_000), 3000)
    df = spark.createDataFrame([(i, f"v{i}") for i in ids], "id bigint, v string").repartition(6)
    ranked = ordered.Ranked.write(df, ["id"], str(tmp_path / "r"), ranges=20)
    assert ranked.rows == 3000 and len(ranked.parts) == 20
    assert rows(ranked.table()) == sorted(((i, f"v{i}", n) for n, i in enumerate(sorted(ids))), key=repr)
    again = ordered.Ranked(spark, str(tmp_path / "r"), df.schema)
    asked = spark.createDataFrame([(n,) for n in (0, 5, 5, 2999, 3000, -1)], "rank bigint")
    assert rows(access.rank_lookup(asked, again)) == sorted(((n, sorted(ids)[n], f"v{sorted(ids)[n]}") for n in (0, 5, 5, 2999)), key=repr)
    empty = ordered.Ranked.write(df.filter("id < 0"), ["id"], str(tmp_path / "e"))
    assert empty.rows == 0 and empty.table().count() == 0 and access.rank_lookup(asked, empty).count() == 0


def test_few_ranks_read_few_files(spark, tmp_path):
    ranked = ordered.Ranked.write(spark.range(5000), ["id"], str(tmp_path / "r"), ranges=25)
    found = access.rank_lookup(spark.createDataFrame([(7,), (4321,)], "rank bigint"), ranked)
    found.collect()
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in scan

    def files(node):
        own = [node.metrics().apply("numFiles").value()] if node.metrics().contains("numFiles") else []
        kids = node.children()
        return own + [x for i in range(kids.size()) for x in files(kids.apply(i))]

    plan = found._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    leaves = plan.collectLeaves()
    read = [leaves.apply(i) for i in range(leaves.size())]
    counts = []
    for leaf in read:
        inner = leaf.plan() if leaf.getClass().getSimpleName() in ("ShuffleQueryStageExec", "BroadcastQueryStageExec") else leaf
        counts += files(inner)
    assert counts and max(counts) <= 2 < len(ranked.parts)
