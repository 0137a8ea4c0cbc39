"""Operators that need row order inside a key or over a whole table.

None of them sends a whole key or table through one task: a window group has about
``chunk_rows`` rows at most, and what crosses chunks is one row per key and chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window, WindowSpec

from roadlens.session import shared_dir

CHUNK_ROWS = 1_000_000
MAX_CHUNKS = 10_000


def _cuts(df: DataFrame, order: str, chunk_rows: int, rows: int | None = None) -> list[int]:
    """Where to cut the whole number ``order`` so that a piece has about ``chunk_rows`` rows, however the numbers lie.

    One pass over the order column (with ``rows``, their number, no second one); at most ``MAX_CHUNKS`` pieces, larger ones beyond.
    """
    rows = df.count() if rows is None else rows
    pieces = min(-(-rows // chunk_rows), MAX_CHUNKS)
    if pieces < 2:
        return []
    shares = [i / pieces for i in range(1, pieces)]
    found = df.agg(F.percentile_approx(F.col(order).cast("long"), shares, 10 * pieces).alias("at")).first()["at"]
    return sorted(set(found or []))


def _chunked(df: DataFrame, order: str, cuts: list[int]) -> DataFrame:
    """Adds ``_chunk``, the piece of each row, ascending; equal numbers share one. Rows without a number come first, in piece -1."""
    if not cuts:
        return df.withColumn("_chunk", F.lit(0))
    number = F.col(order).cast("long")
    return df.withColumn("_chunk", F.when(number.isNull(), -1).otherwise(cuts_below(number, cuts)))


def cuts_below(number: Column, cuts: Sequence[int]) -> Column:
    """How many of the ascending whole numbers ``cuts`` are at or below ``number``; a binary search in steps of powers of two."""
    table = F.array(*[F.lit(c).cast("long") for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        at + step <= len(cuts), F.when(F.element_at(table, at + step) <= number, step).otherwise(0)).otherwise(0))


def _partition(keys: Sequence[str]) -> WindowSpec:
    """Window over ``keys``, sorted by their hash first: comparing it settles most pairs."""
    return Window.partitionBy(F.xxhash64(*keys), *keys)


def previous_in_key(df: DataFrame, keys: Sequence[str], order: str, value: str,
                    chunk_rows: int = CHUNK_ROWS, rows: int | None = None) -> DataFrame:
    """Adds ``is_first`` and ``previous``: the ``value`` of the key's row before this one.

    ``order`` is a unique whole number; rows that share one, or have none (these come first), stand in the order of
    ``value``, so the answer does not depend on the pieces. The table is cut into pieces of about ``chunk_rows`` rows
    by that number, so a hot key spreads over many tasks. Of each key and piece the last value is
    found on the map side; it stands as an extra row before the key's next piece, so one
    window pass answers all rows. A table of one piece is a plain window. ``rows`` is the table's size, if known.
    """
    cuts = _cuts(df, order, chunk_rows, rows)
    local = _partition([*keys, "_chunk"]).orderBy(F.col("_seed").desc(), order, value)
    boxed = F.struct(F.col(value).alias("v"))
    rows = _chunked(df, order, cuts).withColumns({"_seed": F.lit(False), "_value": boxed})
    if cuts:
        tails = rows.groupBy(*keys, "_chunk").agg(F.max_by("_value", F.struct(order, value)).alias("_value"))
        across = _partition(keys).orderBy("_chunk")
        seeds = (tails.withColumn("_value", F.lag("_value").over(across)).filter(F.col("_value").isNotNull())
                 .withColumn("_seed", F.lit(True)))
        rows = rows.unionByName(seeds, allowMissingColumns=True)
    return (rows.withColumn("_prev", F.lag("_value").over(local)).filter(~F.col("_seed"))
            .select(*df.columns, F.col("_prev").isNull().alias("is_first"), F.col("_prev.v").alias("previous")))


def running_total(df: DataFrame, order: str, value: str, name: str,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds the running sum of a whole-number ``value`` over the table in ``order``.

    Rows that share a number share a total. Rows without one come before all others and share theirs, which is the
    sum of their piece, so any number of them spreads over tasks. A missing value adds nothing.
    """
    added = F.coalesce(F.col(value), F.lit(0))
    chunked = _chunked(df, order, _cuts(df, order, chunk_rows)).withColumn("_chunk", F.when(F.col(order).isNull(), -1).otherwise(F.col("_chunk")))
    before = (Window.orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    # One row per chunk reaches the window without a partition, MAX_CHUNKS and one at most.
    offsets = (chunked.groupBy("_chunk").agg(F.sum(added).alias("_sum"))
               .select("_chunk", "_sum", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")))
    salt = F.when(F.col("_chunk") < 0, F.pmod(F.xxhash64(value, F.monotonically_increasing_id()), F.lit(1000))).otherwise(0)
    local = Window.partitionBy("_chunk", "_salt").orderBy(order)
    inside = F.when(F.col("_chunk") < 0, F.col("_sum")).otherwise(F.col(name) + F.col("_base"))
    return (chunked.withColumn("_salt", salt).withColumn(name, F.sum(added).over(local))
            .join(F.broadcast(offsets), "_chunk")
            .withColumn(name, inside)
            .drop("_chunk", "_salt", "_sum", "_base"))


def _order_key(df: DataFrame, order: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)])


def _splits(df: DataFrame, order: Sequence[str], rows: int, parts: int, seed: int = 3) -> list:
    """At most ``parts`` - 1 ascending keys that cut ``df`` into ranges of similar size, from a sample of at most some 40 keys a part."""
    share = min(1.0, 20 * parts / max(rows, 1))
    drawn = df.select(_order_key(df, order).alias("k")).sample(share, seed).limit(40 * parts)
    found = [r["k"] for r in drawn.orderBy("k").collect()]
    cuts = found[len(found) // parts::max(1, len(found) // parts)]
    return [k for i, k in enumerate(cuts) if i == 0 or k != cuts[i - 1]][:parts - 1]


def _literal(df: DataFrame, order: Sequence[str], key) -> Column:
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(f"k{i}") for i, (c, v) in enumerate(zip(order, key, strict=True))])


def range_of_position(df: DataFrame, order: Sequence[str], position: int, enough: int = CHUNK_ROWS,
                      parts: int = 64) -> tuple[DataFrame, int]:
    """The rows of a range of ``order`` that holds ``position``, ``enough`` of them at most, and the position inside it.

    Rows per range of a sampled split are counted in one pass, without a shuffle of rows; the range that holds the
    position is split again while it is too long. Its bounds stand as filters on the first column too, so files that
    lie outside are not read. Rows that share the whole key cannot be parted and stay together. Without such a position
    no row is returned.
    """
    key, rows = _order_key(df, order), df.count()
    inside = df
    if position >= rows:
        return df.limit(0), 0
    while rows > enough:
        splits = _splits(inside, order, rows, parts)
        at = [_literal(df, order, k) for k in splits]
        # How many rows lie below each split: sums made in each task.
        below = inside.agg(*[F.count_if(key < x).alias(f"n{i}") for i, x in enumerate(at)]).first() if at else []
        i = sum(n <= position for n in below)
        first, last = (below[i - 1] if i else 0), (below[i] if i < len(splits) else rows)
        if last - first == rows:
            break  # one key, or none that the sample could part
        if i:
            inside = _from_first(inside.filter(key >= at[i - 1]), order, splits[i - 1], True)
        if i < len(splits):
            inside = _from_first(inside.filter(key < at[i]), order, splits[i], False)
        position, rows = position - first, last - first
    return inside, position


def _from_first(df: DataFrame, order: Sequence[str], key, low: bool) -> DataFrame:
    """The bound on the first column alone, in a form that reaches the files. Missing values come first."""
    value, c = key[0], F.col(f"`{order[0]}`")
    if value is None:
        return df if low else df.filter(c.isNull())
    bound = F.lit(value).cast(df.schema[order[0]].dataType)
    return df.filter(c >= bound) if low else df.filter(c.isNull() | (c <= bound))


def _laid(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The rows in ranges of ``order``, with the number of their range and their place in it."""
    laid = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return (laid.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
            .withColumns({"_part": F.shiftright("_at", 33).cast("int"), "_pos": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at"))


class Ranked:
    """A table written once in ranges of its rank: a folder a range, rows sorted by rank.

    The first rank of each range, one number a range, is all that is kept besides the files. What asks for few
    ranks reads the folders that hold them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.schema = schema
        ddl = StructType([*schema.fields, StructField("_pos", LongType()), StructField("_part", IntegerType())])
        self._files = spark.read.schema(ddl).parquet(path)
        sizes = sorted(tuple(r) for r in self._files.groupBy("_part").count().collect())  # from the files' footers
        self.parts = [p for p, _ in sizes]
        self.firsts = [0]
        for _, n in sizes:
            self.firsts.append(self.firsts[-1] + n)
        self.rows = self.firsts.pop()

    @classmethod
    def write(cls, df: DataFrame, order: Sequence[str], path: str, ranges: int | None = None) -> Ranked:
        """Ranks ``df`` by ``order``, which should identify a row. Tasks that run again write the same ranges."""
        _laid(df, order, ranges).write.mode("overwrite").partitionBy("_part").parquet(path)
        return cls(df.sparkSession, path, df.schema)

    def _ranked(self, files: DataFrame, name: str) -> DataFrame:
        if not self.parts:
            return files.select(*self.schema.names, F.col("_pos").alias(name))
        first = F.element_at(F.create_map(*[F.lit(x) for p in zip(self.parts, self.firsts, strict=True) for x in p]), F.col("_part"))
        return files.select(*[F.col(f"`{c}`") for c in self.schema.names], (F.col("_pos") + first.cast("long")).alias(name))

    def table(self, name: str = "rank") -> DataFrame:
        """All rows with their 0-based rank."""
        return self._ranked(self._files, name)

    def holding(self, ranks: DataFrame, name: str = "rank") -> DataFrame:
        """The rows of the ranges that hold one of ``ranks``, read from their folders alone. One number a range comes to the driver."""
        if not self.parts:
            return self.table(name)
        asked = ranks.filter(F.col(name).between(0, self.rows - 1)).select(cuts_below(F.col(name), self.firsts).alias("i")).distinct().collect()
        wanted = sorted({self.parts[r["i"] - 1] for r in asked})
        return self._ranked(self._files.filter(F.col("_part").isin(wanted)) if len(wanted) < len(self.parts) else self._files, name)


def with_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Adds the 0-based position of each row in ``order``, without a global window.

    The rows are range-partitioned and sorted once and that layout is written to
    the checkpoint folder, so counting the partitions and numbering the rows see
    the same ranges even when executors are lost. ``order`` should identify a row.
    """
    shared_dir(df.sparkSession)
    laid = (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("_at", F.monotonically_increasing_id())
            .checkpoint())
    part = F.shiftright("_at", 33)
    position = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    laid = laid.withColumns({"_part": part, name: position}).drop("_at")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so at most as many rows as there are shuffle partitions.
    offsets = (laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    return (laid.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col(name) + F.col("_base"))
            .drop("_part", "_base"))


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group in ``order``.

    Spark cuts each task's rows to ``n`` per group before the shuffle while ``n``
    is below its group-limit threshold. Beyond it the same cut is made here, first
    per input task and then per 1,000 sets of tasks, so a hot group stays spread.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    columns = df.columns
    stages: list[list[str]] = [[]]
    if n > limit:
        task = F.spark_partition_id()
        df = df.withColumn("_task", task).withColumn("_set", F.col("_task") % 1000)
        stages = [["_task", "_set"], ["_set"], []]
    for extra in stages:
        group = _partition([*keys, *extra]).orderBy(*order)
        df = df.withColumn("_n", F.row_number().over(group)).filter(F.col("_n") <= n)
    return df.select(columns)
