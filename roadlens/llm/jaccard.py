"""N-gram Jaccard self-join by set relations: which documents link, directly or by others.

A document's set is its distinct 5-word shingles, as 64-bit hashes. Equal sets are one set, known
by a 64-bit digest of its size and members. The rest is a prefix join that skips what relations
between sets already answer:

1. Shingles are ordered by the count of their bucket in a fixed-size sketch, then by hash. Counted are
   shingles that repeat within about ``COUNTED`` shingles of one task, which tells passages of many
   documents from the mass of single ones. The sketch only orders: what it misses costs time and
   never results. Each set is indexed under the first ``n - ceil(t n) + 1`` shingles in that order;
   two sets that link meet in at least one list. An entry stays if the next smaller or larger set of its list is near
   enough in size to link; the others meet nobody there.
2. Of each list longer than ``LONG`` one set leads: the one whose own lists are longest, as the original
   of many copies has. Every set there is compared in full with the leader it meets most often. Sets
   similar to it by half form the leader's group and are kept as their difference to it.
3. Within a group every pair's answer follows from the two differences, without the sets. Sets that link to
   their leader are connected already; all others meet the whole group, tile by tile.
4. Lists are read again for pairs of different groups that are not connected yet; stretches of a list
   whose sizes or positions cannot reach the overlap are skipped. The shared prefix shingles
   and the last shared positions bound the overlap, and pairs that pass are compared in full.
5. Components of all links, by contraction.

Lists and groups longer than ``TILE`` are split into tiles that meet pairwise in different tasks. The texts are
read once: the sets are written (8 bytes a shingle) and read again where they are needed, a fixed-size filter keeping those of candidates.

Defined results: a text without words, or null, has no shingles and is alone. Rows that repeat an id
each give a row. Rows without an id take part, but never name a component. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import give_back, packed, stored

SHINGLE = 5
PERCENT = 80
SKETCH_BITS = 20
COUNTED = 4_000_000
FILTER_BITS = 24
TILE = 1000
LONG = 50
GROUP_PERCENT = 50
_ROWS = 1000  # rows that become arrays at a time
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, words: _WordHashes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; with fewer words, of the whole sequence."""
    split = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, split), np.uint64, len(split))
    n = min(k, len(h))
    last = len(h) - n + 1
    s = h[:last] + np.uint64(n)
    for j in range(1, n):
        s = (s ^ (s >> np.uint64(32))) * _M1 + h[j:last + j]
    s = (s ^ (s >> np.uint64(29))) * _M2
    return np.unique(s ^ (s >> np.uint64(32)))


def _set_id(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes(), seed=len(s) & 0xFFFFFFFF) - (1 << 63)


def _summed(df: DataFrame, dtype: type, size: int, add) -> np.ndarray:
    """The arrays in the one binary column of ``df``, reduced in a tree of tasks."""
    arrays = df.rdd.map(lambda r: np.frombuffer(zlib.decompress(r[0]), dtype))
    return arrays.treeAggregate(np.zeros(size, dtype), add, add, 3)


def _scan(docs: DataFrame, bits: int) -> DataFrame:
    """doc_id, n and set_id of each row, with the set itself where a task meets it first; and per task the sketch of
    shingles that its distinct sets share."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, seen = _WordHashes(), set()
        sketch = np.zeros(1 << bits, np.uint32)
        parts: list[np.ndarray] = []
        held = 0

        def count() -> None:
            values, often = np.unique(np.concatenate(parts), return_counts=True)
            again = often > 1
            np.add.at(sketch, (values[again] >> np.uint64(64 - bits)).astype(np.int64), often[again].astype(np.uint32))
            parts.clear()

        for whole in batches:
            for begin in range(0, len(whole), _ROWS):
                batch = whole[begin:begin + _ROWS]
                rows = []
                for text in batch["text"].tolist():
                    s = shingle_set(text, words)
                    key = _set_id(s)
                    new = key not in seen and len(s) > 0
                    rows.append((len(s), key, s.tobytes() if new else None))
                    if new:
                        seen.add(key)
                        parts.append(s)
                        held += len(s)
                        if held >= COUNTED:
                            count()
                            held = 0
                out = pd.DataFrame(rows, columns=["n", "set_id", "members"])
                out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
                yield out.assign(kind=0, sketch=None)
        if parts:
            count()
        yield pd.DataFrame({"doc_id": [None], "n": [0], "set_id": [0], "members": [None], "kind": [1],
                            "sketch": [zlib.compress(sketch.tobytes(), 1)]})
        words.clear()
        give_back()

    return docs.mapInPandas(scan, "doc_id long, n long, set_id long, members binary, kind int, sketch binary")


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Some written sets at a time, by id."""
    for batch in batches:
        for begin in range(0, len(batch), _ROWS):
            rows = batch[begin:begin + _ROWS]
            yield [(key, np.frombuffer(m, np.uint64)) for key, m in zip(rows["set_id"].tolist(), rows["members"].tolist(), strict=True)]


def _prefix(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _index(sets: DataFrame, sketch, bits: int, percent: int) -> DataFrame:
    """Prefix entries: token, set, size and position."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        counts = sketch.value
        for batch in _members(batches):
            tokens, keys, sizes, lengths = [], [], [], []
            for key, s in batch:
                if key not in seen:
                    seen.add(key)
                    rank = counts[s >> np.uint64(64 - bits)].astype(np.uint64) << np.uint64(32) | s & np.uint64(0xFFFFFFFF)
                    p = _prefix(len(s), percent)
                    tokens.append(s[np.argsort(rank, kind="stable")[:p]])
                    keys.append(key)
                    sizes.append(len(s))
                    lengths.append(p)
            if tokens:
                n = np.repeat(sizes, lengths)
                yield pd.DataFrame({
                    "token": np.concatenate(tokens).view(np.int64), "set_id": np.repeat(keys, lengths), "n": n,
                    "pos": np.concatenate([np.arange(p) for p in lengths])})

    return sets.mapInPandas(entries, "token long, set_id long, n int, pos int")


def _lists(entries: DataFrame, percent: int) -> DataFrame:
    """Without copies from several tasks, and without entries that no other one of their list comes near enough in size to link."""

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None  # the last row, until the next one is seen
        near = False  # whether the row before it has its token and a size near enough
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            token, key, n = rows["token"].to_numpy(), rows["set_id"].to_numpy(), rows["n"].to_numpy().astype(np.int64)
            new = np.ones(len(rows), bool)
            new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            rows, token, n = rows[new], token[new], n[new]
            if not len(rows):
                continue
            after = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])  # in order of size the next one is nearest
            before = np.concatenate([[near], after])
            keep = before[:-1] | after
            if keep.any():
                yield rows[:-1][keep]
            held, near = rows[-1:], before[-1]
        if held is not None and near:
            yield held

    return (entries.repartition("token").sortWithinPartitions("token", "n", "set_id")
            .mapInPandas(shared, "token long, set_id long, n int, pos int"))


def _leaders(lists: DataFrame) -> DataFrame:
    """set_id and the leader that most of its long lists have, itself perhaps."""
    long = lists.join(lists.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > LONG), "token")
    weight = long.groupBy("set_id").agg(F.sum("m").alias("weight"))
    lead = (long.join(weight, "set_id").groupBy("token")
            .agg(F.max(F.struct("weight", "set_id"))["set_id"].alias("leader")))
    return (long.join(lead, "token").groupBy("set_id", "leader").agg(F.sum("m").alias("m"))
            .groupBy("set_id").agg(F.max_by("leader", F.struct("m", "leader")).alias("leader")))


def _compared(written: DataFrame, pairs: DataFrame, percent: int, keep: int = 0) -> DataFrame:
    """Pairs a, b of sets that link (100 |a and b| >= percent |a or b|), or reach ``keep`` percent.

    With the size of a, the places in a that b lacks, and what only b has (both empty without ``keep``).
    """
    sc = pairs.sparkSession.sparkContext
    size = 1 << (FILTER_BITS - 3)

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            for c in ("a", "b"):
                mine[batch[c].to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
        yield pd.DataFrame({"bits": [zlib.compress(np.packbits(mine).tobytes(), 1)]})

    wanted = sc.broadcast(_summed(pairs.mapInPandas(bits, "bits binary"), np.uint8, size, np.bitwise_or))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        want = np.unpackbits(wanted.value)
        for batch in _members(batches):
            out = []
            for key, s in batch:
                if key not in seen and want[(key & 0xFFFFFFFFFFFFFFFF) >> (64 - FILTER_BITS)]:
                    seen.add(key)
                    out.append((key, s.tobytes()))
            yield pd.DataFrame(out, columns=["set_id", "members"])

    ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    sets = written.mapInPandas(fetch, "set_id long, members binary").join(ids, "set_id", "left_semi")
    sets = stored(sets.groupBy("set_id").agg(F.first("members").alias("members")), "wanted")  # joined twice

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, b, x, y in batch.itertuples(index=False):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                in_y = np.isin(x, y, assume_unique=True)
                both = int(in_y.sum())
                either = len(x) + len(y) - both
                if 100 * both >= (keep or percent) * either:
                    lacks, more = np.flatnonzero(~in_y).astype(np.uint64), np.setdiff1d(y, x, assume_unique=True)
                    out.append((a, b, 100 * both >= percent * either, len(x), *((lacks.tobytes(), more.tobytes()) if keep else (b"", b""))))
            yield pd.DataFrame(out, columns=["a", "b", "linked", "na", "lacks", "more"])

    return (pairs.join(sets.select(F.col("set_id").alias("a"), F.col("members").alias("x")), "a")
            .join(sets.select(F.col("set_id").alias("b"), F.col("members").alias("y")), "b")
            .select("a", "b", "x", "y").mapInPandas(compare, "a long, b long, linked boolean, na long, lacks binary, more binary"))


def _overlaps(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of a leader's sets, and of all their intersections, from their differences to the leader."""
    lacks = [np.frombuffer(x, np.uint64) for x in rows["lacks"]]
    more = [np.frombuffer(x, np.uint64) for x in rows["more"]]
    na = rows["na"].to_numpy()
    common = na - np.array([len(x) for x in lacks])
    both = (common[:, None] + common[None, :] - na[:, None]).astype(np.float64)
    for part in (lacks, more):
        at = np.repeat(np.arange(len(part)), [len(x) for x in part])
        values, which, often = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
        place = np.cumsum(often > 1) - 1  # only what two sets differ in alike counts for a pair
        use = often[which] > 1
        at, column = at[use], place[which[use]]
        for first in range(0, int((often > 1).sum()), 4096):
            mine = (column >= first) & (column < first + 4096)
            grid = np.zeros((len(part), 4096), np.float32)
            grid[at[mine], column[mine] - first] = 1
            both += grid @ grid.T
    return common + np.array([len(x) for x in more]), both


def _spanning(names: np.ndarray, linked: np.ndarray) -> pd.DataFrame:
    """Each name with the first of its component, where that is another."""
    label = np.arange(len(names))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(names)).min(axis=1, initial=len(names)))
        if (least == label).all():
            break
        label = least[least]
    other = label != np.arange(len(names))
    return pd.DataFrame({"a": names[label[other]], "b": names[other]})


def _inside_groups(members: DataFrame, percent: int) -> DataFrame:
    """Links that connect the sets of one leader's group as far as they link; a, b."""
    tiles = (members.groupBy("a").agg(F.ceil(F.count_if(~F.col("linked")) / TILE).cast("int").alias("open"),
                                      F.ceil(F.count_if("linked") / TILE).cast("int").alias("done"))
             .filter("open > 0"))
    placed = members.join(tiles, "a")
    tile = F.when(F.col("linked"), F.col("open") + F.pmod(F.xxhash64("b"), F.greatest("done", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("b"), F.col("open"))).cast("int")
    others = F.when(F.col("linked"), F.sequence(F.lit(0), F.col("open") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("open") + F.col("done") - 1))
    rows = (placed.withColumn("tile", tile).withColumn("other", F.explode(others))
            .select("a", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), "b", "na", "lacks", "more"))

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        n, both = _overlaps(rows)
        linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        return _spanning(rows["b"].to_numpy(), linked)

    return rows.groupBy("a", "t1", "t2").applyInPandas(meet, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges a, b: set_id and root, for every set with an edge.

    Each round points every vertex at its smallest neighbour, follows the pointers twice and
    contracts; chains shrink by a constant factor, stars are done at once.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a != b").distinct()
    left = stored(both, "edges")
    roots = None
    while not left.isEmpty():
        up = left.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("p"))
        up = stored(up, "parents")
        for _ in range(2):
            up = up.join(up.select(F.col("v").alias("p"), F.col("p").alias("pp")), "p", "left").select(
                "v", F.coalesce("pp", "p").alias("p"))
        up = stored(up, "parents")
        roots = up.select(F.col("v").alias("set_id"), F.col("p").alias("root")) if roots is None else (
            roots.join(up, roots["root"] == up["v"], "left").select("set_id", F.coalesce("p", "root").alias("root")))
        roots = stored(roots, "roots")
        moved = (left.join(up.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a")
                 .join(up.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
                 .filter("pa != pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
        left = stored(moved, "edges")
    if roots is None:
        return left.select(F.col("a").alias("set_id"), F.col("b").alias("root"))
    return roots


def _pairs(lists: DataFrame, groups: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different groups, not connected yet, whose prefixes still allow a link."""
    hot = (lists.groupBy("token").count().filter(F.col("count") > TILE)
           .select("token", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")))
    tile = F.pmod(F.xxhash64("set_id"), F.coalesce("tiles", F.lit(1))).cast("int")
    known = groups.join(roots, "set_id", "full")
    rows = (lists.join(hot, "token", "left").join(known, "set_id", "left")
            .withColumn("tile", tile)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)))
            .select("token", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"),
                    "set_id", "n", "pos", "tile", F.coalesce("grp", "set_id").alias("grp"), F.coalesce("root", "set_id").alias("root")))
    by = ["token", "t1", "t2"]

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            token, t1, t2, tile, key, n, pos, grp, root = (
                rows[c].to_numpy() for c in (*by, "tile", "set_id", "n", "pos", "grp", "root"))
            starts = (token[1:] != token[:-1]) | (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])
            group = np.concatenate([[0], np.cumsum(starts)])
            n = n.astype(np.int64)
            live, d = np.arange(len(key)), 0
            while len(live):
                d += 1
                live = live[live + d < len(key)]
                live = live[group[live + d] == group[live]]
                live = live[100 * n[live] >= percent * n[live + d]]  # sizes only grow from here on
                i, j = live, live + d
                need = -(-percent * (n[i] + n[j]) // (100 + percent))
                reach = np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j])
                ok = (root[i] != root[j]) & (grp[i] != grp[j]) & (reach >= need)
                ok &= (t1[i] == t2[i]) | (tile[i] != tile[j])  # pairs within a tile meet where both tiles are it
                if ok.any():
                    i, j = i[ok], j[ok]
                    swap = key[i] > key[j]
                    i, j = np.where(swap, j, i), np.where(swap, i, j)
                    yield pd.DataFrame({"a": key[i], "b": key[j], "na": n[i], "nb": n[j], "pa": pos[i], "pb": pos[j]})

        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            last = (rows[by] == rows[by].iloc[-1]).all(axis=1).to_numpy()
            held = rows[last]
            if not last.all():
                yield from pairs(rows[~last])
        if held is not None and len(held) > 1:
            yield from pairs(held)

    found = (rows.repartition(*by).sortWithinPartitions(*by, "n", "set_id")
             .mapInPandas(meet, "a long, b long, na long, nb long, pa int, pb int")
             .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb")))
    # What the prefixes do not share can only be shared behind one of them, and behind the last shared places.
    prefix = lambda n: n - F.floor((F.lit(percent) * n + 99) / 100) + 1
    rest = F.least(F.greatest(F.col("na") - prefix(F.col("na")), F.col("nb") - prefix(F.col("nb"))),
                   F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
    return found.filter((F.col("c") + rest) * (100 + percent) >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def links(docs: DataFrame, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows' sets (doc_id, n, set_id) and links between different sets (a, b).

    The links connect all sets that link, directly or by others; not every link is listed.
    """
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    scanned = stored(_scan(docs, sketch_bits), "sets")
    sketch = _summed(scanned.filter("kind = 1").select("sketch"), np.uint32, 1 << sketch_bits, np.add)
    sets = scanned.filter("members IS NOT NULL").select("set_id", "members")
    lists = stored(_lists(_index(sets, sc.broadcast(sketch), sketch_bits, percent), percent), "lists")

    best = stored(_leaders(lists).filter("set_id != leader").select(F.col("leader").alias("a"), F.col("set_id").alias("b")), "leaders")
    members = stored(_compared(sets, best, percent, GROUP_PERCENT), "members")
    inside = members.filter("linked").select("a", "b").union(_inside_groups(members, percent))
    inside = stored(inside, "links")
    groups = members.select(F.col("b").alias("set_id"), F.col("a").alias("grp"))
    pairs = stored(_pairs(lists, groups, components(inside), percent), "pairs")
    rest = _compared(sets, pairs, percent).select("a", "b")
    return scanned.filter("kind = 0").select("doc_id", "n", "set_id"), stored(inside.union(rest), "links")


def link_components(docs: DataFrame, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id that links reach."""
    sets, found = links(docs, percent, sketch_bits)
    least = sets.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id"))
    root = least.join(components(found), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    named = root.join(root.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("set_id", "component_id")
    return sets.join(named, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row of each component, the one with the smallest id; a row without an id comes last. Rows without words stay.

    A row is known by its doc_id and text together: of equal rows one stays, and rows that share only an
    id are decided each by its own text.
    """
    key = F.xxhash64("doc_id", "text")
    sets, found = links(docs.select(key.alias("doc_id"), "text"), percent, sketch_bits)
    ids = docs.select(key.alias("_key"), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")).alias("_id")).distinct()
    rows = sets.filter("n > 0").groupBy(F.col("doc_id").alias("_key"), "set_id").agg(F.count(F.lit(1)).alias("_rows"))
    named = (rows.join(ids, "_key").join(components(found), "set_id", "left")
             .select("_key", "_id", "_rows", F.coalesce("root", "set_id").alias("root")))
    named = stored(named, "named")  # read twice
    first = (named.groupBy("root").agg(F.min(F.struct("_id", "_key"))["_key"].alias("_first"), F.sum("_rows").alias("_all"))
             .filter("_all > 1").drop("_all"))
    fate = (named.join(first, "root").select("_key", (F.col("_key") != F.col("_first")).alias("_later"), "_rows")
            .filter("_later OR _rows > 1"))
    fate = stored(fate, "fate")
    alone, rest = packed(docs, "doc_id", "text")
    marked = alone.withColumn("_key", key)
    once = marked.join(fate.select("_key"), "_key", "left_anti")
    repeated = marked.join(fate.filter("NOT _later").select("_key"), "_key").dropDuplicates(["_key"])
    return once.unionByName(repeated).select(*rest.values())
