"""Hard negatives: a multiway hyperplane tree (GNAT) that eliminates subtrees by window annuli, with exact leaves.

A node has a few split points, rows of a bounded sample; a row belongs to the nearest one, so a subtree is what
its hyperplanes cut out. All rows are put into the tree. For each pair of split point and sibling subtree the
node keeps the least and greatest distance between them, found by Spark over all rows, and for each
subtree the range of norms. A window of inner products with an anchor, together with those norms, is an annulus of
distances around it; a subtree whose range from any split point cannot meet the annulus is left out
before an anchor is sent there. What is left is scored exactly, in whole numbers, leaf by leaf.

Windows start narrow: the sample, which is broadcast with the tree, already gives an anchor some rows, and only
what may be better than its n-th is looked for. First come the positives (no upper end), then for
each of them the negatives in its window. Leaves meet anchors in pieces of ``PIECE`` rows and
``ANCHORS`` anchors, so neither a leaf of equal vectors nor a leaf everyone visits is one task; an anchor is sent
to a piece once, with all its windows. A piece hands on the first n of each window.

Defined results. Rows without an id or label, and vectors that are null or hold null or non-finite components,
take no part, nor do vectors whose length is not the most frequent one (the shortest such). Of rows that
repeat an id the one with the least label, then vector, stays. An anchor without positives gives no rows, nor does
a positive of negative score, whose window is empty. Vectors are scaled to whole numbers; a squared
norm of 2**60 or more raises ValueError. An empty table gives no rows. Columns besides the three named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlens.llm.common import sampled, stored

SCALE = 256
SAMPLE = 20_000
BRANCHES = 8
LEAF_ROWS = 400
PIECE = 8192
ANCHORS = 1024
_SLICE = 128


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and the whole-number vector ``v`` of the rows that take part, one row an id."""
    x = F.col("v")
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                           F.col(embedding).cast("array<double>").alias("v")).dropna()
    rows = named.filter(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    most = F.max(F.array_max(F.transform(x, lambda v: F.abs(v))))
    sizes = rows.groupBy(F.size(x).alias("d")).agg(F.count(F.lit(1)).alias("n"), most.alias("most")).orderBy(F.desc("n"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    if d and d * (SCALE * sizes[0]["most"] + 1) ** 2 >= 2.0 ** 60:
        raise ValueError("components are too large for exact inner products")
    rows = rows.filter(F.size(x) == d).withColumn("v", F.transform(x, lambda v: F.floor(F.lit(SCALE) * v).cast("long")))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows: in doubles where every sum fits, else in integers."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * max(a.shape[1], 1)
    if largest < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _norms(a: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)


@dataclass
class Node:
    splits: np.ndarray
    children: list[int]  # a node's number, or -1 - the leaf's
    #: by split point and child: least and greatest distance; by child: least and greatest squared norm
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)
    norms: np.ndarray = field(default=None)


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0

    def grow(self, rows: np.ndarray, rng: np.random.Generator) -> int:
        parts, splits = _parted(rows, rng) if len(rows) > LEAF_ROWS else ([], None)
        if len(parts) < 2:
            self.leaves += 1
            return -self.leaves
        at = len(self.nodes)
        self.nodes.append(Node(splits, []))
        self.nodes[at].children = [self.grow(rows[p], rng) for p in parts]
        return at

    def descend(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each node that rows come to: its number, their places, squared distances to the splits, and child."""
        todo = [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            at, mine = todo.pop()
            node = self.nodes[at]
            far = _norms(rows[mine])[:, None] + _norms(node.splits) - 2 * _dots(rows[mine], node.splits)
            near = far.argmin(axis=1)
            yield at, mine, far, near
            todo += [(child, mine[near == j]) for j, child in enumerate(node.children) if child >= 0 and (near == j).any()]

    def assign(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int32)
        for at, mine, _, near in self.descend(rows):
            leaf = -1 - np.array(self.nodes[at].children)
            out[mine] = np.maximum(leaf, 0)[near]
        return out

    def alive(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which leaves may hold a row whose inner product with the query lies in [low, high]; by query and leaf."""
        out = np.zeros((len(queries), self.leaves), bool)
        if not self.nodes:
            out[:] = True
            return out
        own = _norms(queries).astype(float)
        todo = [(0, np.flatnonzero(low <= high))]
        while todo:
            at, mine = todo.pop()
            node = self.nodes[at]
            r = np.sqrt(np.maximum(own[mine, None] + _norms(node.splits) - 2.0 * _dots(queries[mine], node.splits), 0))
            for j, child in enumerate(node.children):
                outer = own[mine] + node.norms[1, j] - 2.0 * low[mine]
                inner = np.sqrt(np.maximum(own[mine] + node.norms[0, j] - 2.0 * high[mine], 0))
                possible = (outer >= 0) & (node.norms[0, j] <= node.norms[1, j])
                outer = np.sqrt(np.maximum(outer, 0))
                slack = 1e-6 * (1 + r + outer[:, None])
                nearest = np.maximum(r - outer[:, None], inner[:, None] - r) - slack
                meets = (nearest <= node.high[:, j]) & (r + outer[:, None] + slack >= node.low[:, j])
                left = mine[possible & meets.all(axis=1)]
                if child < 0:
                    out[left, -1 - child] = True
                elif len(left):
                    todo.append((child, left))
        return out


def _parted(rows: np.ndarray, rng: np.random.Generator) -> tuple[list[np.ndarray], np.ndarray]:
    """Split points far from each other, out of three times as many drawn, and the rows nearest to each."""
    drawn = rows[rng.choice(len(rows), min(3 * BRANCHES, len(rows)), replace=False)]
    far = _norms(drawn)[:, None] + _norms(drawn) - 2 * _dots(drawn, drawn)
    picked, least = [0], far[0]
    while len(picked) < BRANCHES and least.max() > 0:
        picked.append(int(least.argmax()))
        least = np.minimum(least, far[picked[-1]])
    splits = drawn[picked]
    near = (_norms(splits) - 2 * _dots(rows, splits)).argmin(axis=1)
    return [np.flatnonzero(near == j) for j in range(len(splits))], splits


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def fit(rows: DataFrame, sample: int = SAMPLE, seed: int = 7) -> tuple[Tree, pd.DataFrame]:
    """A tree over at most ``sample`` rows, those with the least hash of their id, and these rows."""
    picked = sampled(rows, sample, "vec_id").toPandas()
    tree = Tree()
    if len(picked):
        tree.grow(np.stack(picked["v"]).astype(np.int64), np.random.default_rng(seed))
    else:
        tree.leaves = 1
    return tree, picked


def indexed(rows: DataFrame, tree: Tree) -> DataFrame:
    """``rows`` with their leaf."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(_matrix(batch["v"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    return rows.mapInArrow(leaves, "vec_id long, label long, v array<long>, leaf int")


def measured(index: DataFrame, tree: Tree) -> Tree:
    """``tree`` with the ranges of distances and norms of all rows; one row a range, whatever the table's size."""
    shared = index.sparkSession.sparkContext.broadcast(tree)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], tuple[int, int]] = {}
        for batch in batches:
            rows = _matrix(batch["v"])
            norms = _norms(rows)
            for at, mine, far, near in shared.value.descend(rows):
                for j in np.unique(near).tolist():
                    held = near == j
                    least, most = far[held].min(axis=0).tolist(), far[held].max(axis=0).tolist()
                    own = norms[mine[held]]
                    for i, (a, b) in enumerate(zip([*least, int(own.min())], [*most, int(own.max())], strict=True)):
                        key = at, j, i if i < len(least) else -1
                        x, y = found.get(key, (a, b))
                        found[key] = min(a, x), max(b, y)
        rows = [(*key, *value) for key, value in found.items()]
        yield pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(
            [("node", pa.int32()), ("child", pa.int32()), ("split", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])})

    for node in tree.nodes:
        k = len(node.splits)
        node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        node.norms = np.stack([np.full(k, np.inf), np.full(k, -np.inf)])
    rows = (index.select("v").mapInArrow(ranges, "node int, child int, split int, low long, high long")
            .groupBy("node", "child", "split").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
    for r in rows:
        node = tree.nodes[r["node"]]
        if r["split"] < 0:
            node.norms[:, r["child"]] = r["low"], r["high"]
        else:
            node.low[r["split"], r["child"]], node.high[r["split"], r["child"]] = np.sqrt(r["low"]), np.sqrt(r["high"])
    return tree


def _first(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` allowed rows by score, then id."""
    at = np.flatnonzero(allowed)
    if len(at) > n:
        at = at[scores[at] >= np.partition(scores[at], -n)[-n]]
    return at[np.lexsort((ids[at], -scores[at]))[:n]]


_VISIT = "query_id long, label long, v array<long>, goals array<long>, low array<long>, high array<long>, leaf int"


def _visits(queries: DataFrame, tree: Tree, sample: pd.DataFrame, same: bool, n: int) -> DataFrame:
    """A row for each query and leaf that may hold something better than what the sample has for one of its windows.

    ``queries`` have query_id, label, v and arrays goals, low and high, a window for each goal; windows come back narrowed.
    """
    context = queries.sparkSession.sparkContext
    shared = context.broadcast((tree, *(np.stack(sample[c]).astype(np.int64) if len(sample) else np.zeros((0, 0), np.int64) for c in ("vec_id", "label", "v"))))
    names = [c.split()[0] for c in _VISIT.split(", ")]

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, ids, labels, vectors = shared.value
        for whole in batches:
            for begin in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(begin, _SLICE)
                own, label, q = batch["query_id"].to_numpy(), batch["label"].to_numpy(), _matrix(batch["v"])
                low, high = batch["low"].to_pylist(), batch["high"].to_pylist()
                scores = _dots(q, vectors)
                for i in range(len(own)):
                    fits = ((labels == label[i]) == same) & (ids != own[i])
                    for w, (a, b) in enumerate(zip(low[i], high[i], strict=True)):
                        inside = scores[i][fits & (scores[i] >= a) & (scores[i] <= b)]
                        if len(inside) >= n:
                            low[i][w] = int(np.partition(inside, -n)[-n])
                open_ = np.zeros((len(own), tree.leaves), bool)
                for w in range(max(map(len, low), default=0)):
                    has = np.array([i for i in range(len(own)) if len(low[i]) > w])
                    open_[has] |= tree.alive(q[has], np.array([low[i][w] for i in has]), np.array([high[i][w] for i in has]))
                at, leaf = np.nonzero(open_)
                picked = batch.take(pa.array(at))
                columns = {c: picked[c] for c in names[:4]} | {
                    "low": pa.array([low[i] for i in at], pa.list_(pa.int64())), "high": pa.array([high[i] for i in at], pa.list_(pa.int64())),
                    "leaf": pa.array(leaf, pa.int32())}
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return queries.select(names[:-1]).mapInArrow(visits, _VISIT)


_FOUND = "query_id long, goal long, vec_id long, score long"


def search(index: DataFrame, queries: DataFrame, tree: Tree, sample: pd.DataFrame, same: bool, n: int,
           piece: int = PIECE, anchors: int = ANCHORS) -> DataFrame:
    """For each query and goal the first ``n`` rows of the same (or another) label in its window, with their ``rank``."""
    asked = stored(_visits(queries, tree, sample, same, n), "visits")
    cut = lambda df, size, name: df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    pieces = cut(index, piece, "rows_in").join(cut(asked, anchors, "queries_in"), "leaf")  # a row for each leaf of the tree
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    of = lambda key, c: F.pmod(F.xxhash64(key), F.col(c)).cast("int")
    left = (index.join(F.broadcast(pieces), "leaf").withColumn("a", of("vec_id", "rows_in")).withColumn("b", every("queries_in"))
            .select("leaf", "a", "b", "vec_id", "label", "v"))
    right = (asked.join(F.broadcast(pieces), "leaf").withColumn("b", of("query_id", "queries_in")).withColumn("a", every("rows_in"))
             .select("leaf", "a", "b", "query_id", "label", "v", "goals", "low", "high"))

    def found(rows: pa.Table, mine: pa.Table) -> pa.Table:
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        if rows.num_rows and mine.num_rows:
            ids, labels, vectors = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["v"])
            own, label, q = mine["query_id"].to_numpy(), mine["label"].to_numpy(), _matrix(mine["v"])
            goals, low, high = (mine[c].to_pylist() for c in ("goals", "low", "high"))
            for begin in range(0, len(own), _SLICE):
                scores = _dots(q[begin:begin + _SLICE], vectors)
                for i, s in enumerate(scores, begin):
                    fits = ((labels == label[i]) == same) & (s >= min(low[i])) & (ids != own[i])
                    if not fits.any():
                        continue
                    for goal, a, b in zip(goals[i], low[i], high[i], strict=True):
                        best = _first(s, ids, fits & (s >= a) & (s <= b), n)
                        out.append((own[i], goal, ids[best], s[best]))
        lengths = [len(x[2]) for x in out]
        arrays = [np.repeat(np.array([x[0] for x in out], np.int64), lengths), np.repeat(np.array([x[1] for x in out], np.int64), lengths),
                  *(np.concatenate([x[c] for x in out]) if out else np.zeros(0, np.int64) for c in (2, 3))]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=["query_id", "goal", "vec_id", "score"])

    key = ["leaf", "a", "b"]
    rows = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(found, _FOUND)
    order = Window.partitionBy("query_id", "goal").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mined(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
          sample: int = SAMPLE, piece: int = PIECE, anchors: int = ANCHORS) -> DataFrame:
    """For each anchor and each of its first positives, the first negatives that score ``low`` to ``high`` percent of it.

    ``rows`` are as ``quantised`` gives them: vec_id (unique), label, v.
    """
    rows = stored(rows, "quantised")
    tree, picked = fit(rows, sample)
    index = stored(indexed(rows, tree), "index")
    tree = measured(index, tree)
    asked = rows.filter(is_anchor).select(F.col("vec_id").alias("query_id"), "label", "v")
    ends = F.lit(1 << 61)
    wide = asked.select("*", F.array(F.lit(0).cast("long")).alias("goals"), F.array(-ends).alias("low"), F.array(ends).alias("high"))
    near = stored(search(index, wide, tree, picked, True, positives, piece, anchors)
                  .select("query_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = (near.filter("positive_score >= 0").groupBy("query_id")
               .agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p"))  # ``positives`` at most
               .select("query_id", F.transform("p", lambda p: p["rank"].cast("long")).alias("goals"),
                       F.transform("p", lambda p: F.ceil(p["positive_score"] * low / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("low"),
                       F.transform("p", lambda p: F.floor(p["positive_score"] * high / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("high")))
    hard = search(index, asked.join(windows, "query_id"), tree, picked, False, negatives, piece, anchors)
    return (hard.join(near.withColumnRenamed("rank", "goal"), ["query_id", "goal"])
            .select(F.col("query_id").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
