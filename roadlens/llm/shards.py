"""Sharding by balanced label propagation: linked documents share a shard, shards stay even.

A node is a group of equal texts, known by a 64-bit hash, and weighs its number of rows. Two groups are
linked by every long line they share, through the line's smallest group, so a line found everywhere
gives one edge per group. Rounds of propagation start from a hash of the group. In each, a
group wishes to move to the shard where its neighbours weigh most; wishes are counted by shard,
target and hash bucket, and the buckets that fit the targets' quotas move, whole groups at a time.
Only that bounded table of counts reaches the driver.

Last, rows are put in the order of shard, strongest neighbour, group and id, and that order is cut
into equal parts (law ``rows``): counts differ by one at most, few neighbours are parted and of the
groups of equal texts only those that a cut goes through, or that exceed a shard.

Defined results: a null text weighs one byte and its group is that of empty texts, as is its crc32.
Repeated rows each get a slot. Rows without an id come first within their group. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import stored
from roadlens.operators.ordered import with_rank

ROUNDS = 3
SLACK = 0.05
LINE_CHARS = 60
BUCKETS = 256


def line_links(docs: DataFrame, chars: int = LINE_CHARS) -> DataFrame:
    """a, b, w: groups and the hub of the long lines they share, with the number of such lines."""
    lines = (docs.select("grp", F.explode(F.split("text", "\n")).alias("line"))
             .filter(F.length("line") >= chars).select("grp", F.xxhash64("line").alias("line")).distinct())
    lines = stored(lines, "lines")
    hubs = (lines.groupBy("line").agg(F.min("grp").alias("hub"), F.max("grp").alias("last"))
            .filter("hub < last").drop("last"))
    return (lines.join(hubs, "line").filter("grp != hub").groupBy(F.col("grp").alias("a"), F.col("hub").alias("b"))
            .agg(F.count(F.lit(1)).alias("w")))


def _accepted(wishes: list, sizes: dict[int, int], quota: float) -> list[tuple[int, int, int]]:
    """Buckets of wishes that fit: what leaves a shard makes room for what comes."""
    taken, left = [], sorted(wishes, key=lambda r: (r["bucket"], r["shard"], r["target"]))
    moved = True
    while moved and left:
        moved, rest = False, []
        for r in left:
            if sizes.get(r["target"], 0) + r["rows"] <= quota:
                sizes[r["target"]] = sizes.get(r["target"], 0) + r["rows"]
                sizes[r["shard"]] -= r["rows"]
                taken.append((r["shard"], r["target"], r["bucket"]))
                moved = True
            else:
                rest.append(r)
        left = rest
    return taken


def propagate(nodes: DataFrame, edges: DataFrame, shards: int, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """nodes (grp, rows) and edges (a, b, w) to grp, shard, near: the strongest neighbour or itself."""
    spark = nodes.sparkSession
    both = stored(edges.union(edges.select("b", "a", "w")), "edges")
    near = both.groupBy("a").agg(F.max_by("b", F.struct("w", -F.col("b"))).alias("near"))
    state = (nodes.join(near, nodes["grp"] == near["a"], "left")
             .select("grp", "rows", F.coalesce("near", "grp").alias("near"),
                     F.pmod(F.xxhash64(F.coalesce("near", "grp")), F.lit(shards)).cast("int").alias("shard")))
    state = stored(state, "shards")
    total = state.agg(F.sum("rows")).first()[0] or 0
    quota = total / shards * (1 + slack)
    for turn in range(rounds):
        pull = (both.join(state.select(F.col("grp").alias("b"), F.col("shard").alias("at"), "rows"), "b")
                .groupBy(F.col("a").alias("grp"), "at").agg(F.sum("w").alias("w"))
                .groupBy("grp").agg(F.max_by("at", F.struct("w", -F.col("at"))).alias("target")))
        bucket = F.pmod(F.xxhash64("grp", F.lit(turn)), F.lit(BUCKETS)).cast("int")
        wished = state.join(pull, "grp", "left").withColumn("bucket", bucket)
        counts = (wished.filter("target != shard").groupBy("shard", "target", "bucket").agg(F.sum("rows").alias("rows")))
        sizes = {r["shard"]: r["rows"] for r in state.groupBy("shard").agg(F.sum("rows").alias("rows")).collect()}
        taken = _accepted(counts.collect(), sizes, quota)
        if not taken:
            break
        go = F.broadcast(spark.createDataFrame(taken, "shard int, target int, bucket int").withColumn("go", F.lit(True)))
        state = stored(wished.join(go, ["shard", "target", "bucket"], "left")
                       .select("grp", "rows", "near", F.when(F.col("go"), F.col("target")).otherwise(F.col("shard")).alias("shard")),
                       "shards")
    return state


def shard(docs: DataFrame, shards: int = 16, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce("text", F.lit(""))
    marked = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("grp"))
    rows = stored(marked.select("doc_id", "grp", (F.octet_length("text") + 1).cast("long").alias("size"),
                                F.crc32(F.col("text").cast("binary")).alias("text_crc32")), "rows")
    nodes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("rows"))
    state = propagate(nodes, line_links(marked), shards, rounds)
    placed = stored(rows.join(state.select("grp", "near", F.col("shard").alias("at")), "grp"), "placed")
    total = placed.count()
    home = F.floor(F.col("rank") * shards / F.lit(max(total, 1))).cast("int")
    first = F.ceil(home * F.lit(max(total, 1)) / shards).cast("long")
    ranked = with_rank(placed, ["at", "near", "grp", "doc_id"])
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), home.alias("shard"),
                         (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
