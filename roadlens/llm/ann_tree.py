"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on ``SAMPLE`` rows at most (those with the smallest hash of their id) and broadcast;
its size is bounded by that sample. Every row is put into a leaf. A query walks the tree through a
priority queue of branches, nearest centre first, and visits the first ``visits`` leaves it meets.

``visits`` is calibrated: up to ``PROBES`` rows are searched exactly against all rows in one pass, the
number of leaves each true neighbour needs is read off, and visits grow until ``TARGET`` of them are found.

Leaves and queries meet in chunks: a leaf is cut into pieces of about ``CHUNK`` rows and its queries
too, so a leaf with a third of all rows is many small tasks. Of equal vectors only the ``k`` + 1 with
the smallest ids can be among k neighbours, so Spark cuts copies to those before they are dealt out.

Defined results: null vectors, zero vectors and those with null or non-finite components take no part,
nor do vectors whose length is not the most frequent one. Ties go to the smaller id. With fewer than
k candidates, all are returned. Rows without an id take no part; of rows that repeat an id with equal
vectors each may be found, and each query row gets its k neighbours, repeated ones too. Columns besides the two named are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlens.llm.common import sampled, stored

SAMPLE = 20_000
BRANCHES = 10
LEAF_ROWS = 40
PROBES = 256
TARGET = 0.98
CHUNK = 4096


@dataclass
class Tree:
    """Nodes by number: the centres and numbers of their children; leaves have a leaf number."""

    centres: list[np.ndarray | None] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, rows: np.ndarray, rng: np.random.Generator) -> int:
        at = len(self.leaf)
        self.centres.append(None)
        self.children.append([])
        self.leaf.append(-1)
        parts = _kmeans(rows, BRANCHES, rng) if len(rows) > LEAF_ROWS else []
        if len(parts) < 2:
            self.leaf[at] = self.leaves
            self.leaves += 1
            return at
        self.centres[at] = np.stack([rows[p].mean(axis=0) for p in parts])
        self.children[at] = [self.add(rows[p], rng) for p in parts]
        return at

    def assign(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, mine = todo.pop()
            if self.leaf[node] >= 0:
                out[mine] = self.leaf[node]
            elif len(mine):
                near = _squares(rows[mine], self.centres[node]).argmin(axis=1)
                todo += [(child, mine[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def best_first(self, row: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which a priority queue of branches meets them."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            else:
                far = _squares(row[None], self.centres[node])[0].tolist()
                for d, child in zip(far, self.children[node], strict=True):
                    heapq.heappush(queue, (d, child))


def _squares(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(axis=1) - 2 * rows @ centres.T


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> list[np.ndarray]:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        near = _squares(rows, centres).argmin(axis=1)
        parts = [p for p in (np.flatnonzero(near == i) for i in range(len(centres))) if len(p)]
        centres = np.stack([rows[p].mean(axis=0) for p in parts])
    return parts


def _unit(vectors: pd.Series) -> np.ndarray:
    rows = np.array(vectors.tolist(), np.float64)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def valid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and embedding (double) of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & finite & F.exists(x, lambda v: v != 0)))
    sizes = rows.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size(x) == (sizes[0]["d"] if sizes else 0))


def fit(rows: DataFrame, sample: int = SAMPLE, seed: int = 7) -> Tree:
    picked = sampled(rows, sample, "vec_id").select("embedding").toPandas()
    tree = Tree()
    tree.add(_unit(picked["embedding"]) if len(picked) else np.zeros((0, 1)), np.random.default_rng(seed))
    return tree


def indexed(rows: DataFrame, tree: Tree) -> DataFrame:
    """``rows`` with their leaf."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def leaf_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.assign(_unit(batch)) if len(batch) else [], dtype="int32")

    return rows.withColumn("leaf", leaf_of("embedding"))


def _best(queries: np.ndarray, names: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, keys: np.ndarray | None = None) -> pd.DataFrame:
    """Exact k nearest rows of each query among ``rows``; both are original vectors. Queries are called by ``keys``, or else ``names``."""
    out = []
    keys = names if keys is None else keys
    norms = np.sqrt((rows * rows).sum(axis=1))
    scores = (queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True))) @ (rows / norms[:, None]).T
    scores[names[:, None] == ids[None, :]] = -2
    for q, mine in enumerate(scores):
        edge = np.partition(mine, -k)[-k] if len(mine) > k else -2.0
        at = np.flatnonzero((mine >= edge - 1e-9) & (mine > -2))
        dots = (rows[at] * queries[q]).sum(axis=1)  # the same order of additions for every pair
        exact = dots / (norms[at] * np.sqrt((queries[q] * queries[q]).sum()))
        best = np.lexsort((ids[at], -exact))[:k]
        out.append(pd.DataFrame({"query_id": keys[q], "vec_id": ids[at][best], "score": exact[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


_FOUND = "query_id long, vec_id long, score double"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact(queries: pd.DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Brute force of a few queries (on the driver) against all rows, block by block."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = np.array(shared.value["embedding"].tolist(), np.float64)
        names = shared.value["vec_id"].to_numpy()
        for batch in batches:
            if len(batch):
                yield _best(vectors, names, np.array(batch["embedding"].tolist()), batch["vec_id"].to_numpy(), k)

    return _top(rows.select("vec_id", "embedding").mapInPandas(search, _FOUND), k)


def calibrate(tree: Tree, index: DataFrame, k: int, probes: int = PROBES, target: float = TARGET) -> int:
    """The number of leaves to visit so that ``target`` of the probes' true neighbours are found."""
    asked = sampled(index, probes, "vec_id", F.lit(1)).select("vec_id", "embedding").toPandas().drop_duplicates("vec_id")
    if not len(asked):
        return 1
    near = exact(asked, index, k)
    leaves = near.join(index.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    place = {name: {leaf: i for i, leaf in enumerate(tree.best_first(row))}
             for name, row in zip(asked["vec_id"], _unit(asked["embedding"]), strict=True)}
    needed = np.sort([place[q][leaf] + 1 for q, leaf in leaves.itertuples(index=False)])
    return int(needed[int(np.ceil(target * len(needed))) - 1]) if len(needed) else 1


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, target: float = TARGET,
            sample: int = SAMPLE, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest found, its own id left out."""
    rows = stored(valid(vectors), "vectors")
    copies = Window.partitionBy(F.xxhash64("embedding"), "embedding").orderBy("vec_id")
    tree = fit(rows, sample)
    index = stored(indexed(rows.withColumn("n", F.row_number().over(copies)).filter(F.col("n") <= k + 1).drop("n"), tree), "index")
    visits = calibrate(tree, index, k, target=target)
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("array<int>")
    def visited(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for row in _unit(batch) if len(batch) else []:
                order = shared.value.best_first(row)
                out.append([leaf for leaf, _ in zip(order, range(visits), strict=False)])
            yield pd.Series(out)

    # Equal query rows are answered once; a query is known by its id and vector.
    queries = rows.filter(is_query).select(F.xxhash64("vec_id", "embedding").alias("query"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    asked = queries.dropDuplicates(["query"]).repartition("query").withColumn("leaf", F.explode(visited("q")))
    cut = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias(name))
    pieces = cut(index, "rows_in").join(cut(asked, "queries_in"), "leaf")  # one row per leaf, bounded by the sample
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    of = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = (index.join(F.broadcast(pieces), "leaf").withColumn("a", of("vec_id", "rows_in"))
            .withColumn("b", F.explode(every("queries_in"))).select("leaf", "a", "b", "vec_id", "embedding"))
    right = (asked.join(F.broadcast(pieces), "leaf").withColumn("b", of("query", "queries_in"))
             .withColumn("a", F.explode(every("rows_in"))).select("leaf", "a", "b", "query", "query_id", "q"))

    def search(mine: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _best(np.array(queries["q"].tolist()), queries["query_id"].to_numpy(),
                     np.array(mine["embedding"].tolist()), mine["vec_id"].to_numpy(), k, queries["query"].to_numpy())

    key = ["leaf", "a", "b"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, _FOUND)
    found = _top(found, k).select(F.col("query_id").alias("query"), "rank", "vec_id", "score")
    return queries.select("query", "query_id").join(found, "query").select("query_id", "rank", "vec_id", "score")
