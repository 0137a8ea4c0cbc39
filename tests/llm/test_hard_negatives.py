import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import hard_negatives as H
from roadlens.llm import queries as Q

VECTORS = "vec_id long, embedding array<float>, label int, score int, leaf int"


def plain(rows, every=100, n=5):
    """(anchor, positive, rank, negative, positive score, negative score) by sorting all rows for each anchor."""
    ids, labels = [r[0] for r in rows], [r[2] for r in rows]
    q = [[int(np.floor(256 * float(np.float32(x)))) for x in r[1]] for r in rows]
    out = []
    for a, anchor in enumerate(ids):
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q[a], q[b], strict=True)), ids[b], labels[b]) for b in range(len(ids)) if ids[b] != anchor)
        for s, positive, _ in [x for x in scored if x[2] == labels[a]][:n]:
            hard = [x for x in scored if x[2] != labels[a] and -80 * s <= -100 * x[0] <= -100 * s][:n]
            out += [(anchor, positive, rank, negative, -s, -t) for rank, (t, negative, _) in enumerate(hard, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 1) for i, v, y in rows], VECTORS)


def clustered(rng, n, d=8, labels=3):
    centres = rng.normal(size=(12, d))
    v = centres[rng.integers(12, size=n)] + 0.15 * rng.normal(size=(n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, v[i].astype(np.float32).tolist(), int(rng.integers(labels))) for i in range(n)]


def test_query(spark, sf):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(Q.QUERIES["op11_hyperplane_tree"](spark, sf)) == plain(rows)


@pytest.mark.parametrize("sample", [60, 20_000])
def test_tree_in_small_pieces(spark, rng, monkeypatch, sample):
    """Several levels, leaves in pieces, a hot group of equal vectors, ties."""
    monkeypatch.setattr(H, "LEAF_ROWS", 10)
    rows = clustered(rng, 400)
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(150)] + [(2000 + i, [-x for x in rows[7][1]], 1) for i in range(5)]
    df = H.mined(H.quantised(table(spark, rows)), F.col("vec_id") % 20 == 0, sample=sample, piece=16, anchors=4)
    assert got(df) == plain(rows, 20)


def test_elimination_leaves_leaves_out(spark, rng, monkeypatch):
    monkeypatch.setattr(H, "LEAF_ROWS", 20)
    rows = H.quantised(table(spark, clustered(rng, 600)))
    tree, picked = H.fit(rows)
    tree = H.measured(H.indexed(rows, tree), tree)
    q = np.stack(picked["v"]).astype(np.int64)[:50]
    scores = H._dots(q, np.stack(picked["v"]).astype(np.int64))
    leaf = tree.assign(np.stack(picked["v"]).astype(np.int64))
    low, high = np.full(50, 45_000), np.full(50, 55_000)
    alive = tree.alive(q, low, high)
    for i in range(50):
        inside = (scores[i] >= 45_000) & (scores[i] <= 55_000)
        assert alive[i][leaf[inside]].all()
    assert tree.leaves > 10 and alive.mean() < 0.7


def test_awkward(spark, rng):
    rows = clustered(rng, 60, 4, 2)
    odd = [(100, None, 1), (200, [float("nan"), 0.0, 0.0, 0.0], 1), (300, [None, 1.0, 0.0, 0.0], 0), (400, rows[0][1], None), (None, rows[0][1], 0),
           (500, [float("inf"), 0.0, 0.0, 0.0], 0), (600, [1.0, 2.0], 0), (700, [], 1)]
    same = rows + [(900, [0.0] * 4, 0), (1000, [0.0] * 4, 1)]  # zero vectors take part: their scores are 0
    df = table(spark, same + odd + rows[:5])
    assert got(H.mined(H.quantised(df), F.col("vec_id") % 10 == 0)) == plain(same, 10)
    assert got(H.mined(H.quantised(table(spark, [])), F.lit(True))) == []
    assert got(H.mined(H.quantised(table(spark, rows[:1])), F.lit(True))) == []
    one = [(i, v, 1) for i, v, _ in rows]  # no negatives at all
    assert got(H.mined(H.quantised(table(spark, one)), F.lit(True))) == []


def test_large_components(spark):
    rows = [(i, [float(1 << 17) + i, float(-i)], i % 2) for i in range(40)]
    assert got(H.mined(H.quantised(table(spark, rows)), F.col("vec_id") % 10 == 0)) == plain(rows, 10)
    with pytest.raises(ValueError, match="too large"):
        H.quantised(table(spark, [(0, [1e12, 1.0], 0)]))
