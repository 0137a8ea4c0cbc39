"""Change detection and time-to-live hits kept up to date as rows arrive, late ones too.

The rows are kept in pieces of ``width`` order numbers, and of every key and piece the last value. A batch
rewrites the last values of the pieces it touches. The answer for a row depends on its piece and on the key's last
value in the nearest piece before, so answered anew are the pieces touched and, for keys of the batch, the next piece
that has them. Everything else stays as it was settled. After any batches, in any order of their numbers, the answers are those of one run over all
rows. A batch that runs again replaces itself.

Rows without an order number come first, in a piece of their own; rows that share one stand in the order of the value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from roadlens.sinks.batches import children

FIRST_PIECE = -(1 << 62)


class PreviousByPieces:
    """``is_first`` and ``previous`` of every row that was added, as ``ordered.previous_in_key`` gives them."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: str, value: str, width: int):
        self.spark, self.root, self.schema = spark, root, schema
        self.keys, self.order, self.value, self.width = list(keys), order, value, width

    def _read(self, name: str, fields: Sequence[T.StructField]) -> DataFrame:
        schema = T.StructType([*fields, T.StructField("_piece", T.LongType())])
        path = f"{self.root}/{name}"
        if not children(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _write(self, df: DataFrame, name: str, *by: str) -> None:
        """Replaces the folders that ``df`` has rows for, and no others."""
        (df.repartition(*by, F.pmod(F.xxhash64(*self.keys), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(f"{self.root}/{name}"))

    def rows(self) -> DataFrame:
        return self._read("rows", [*self.schema.fields, T.StructField("_batch", T.LongType())])

    def _boxed(self) -> T.StructField:
        return T.StructField("_value", T.StructType([T.StructField("v", self.schema[self.value].dataType)]))

    def tails(self) -> DataFrame:
        return self._read("tails", [*[self.schema[k] for k in self.keys], self._boxed()])

    def answers(self) -> DataFrame:
        """All rows with ``is_first`` and ``previous``."""
        added = [T.StructField("is_first", T.BooleanType()), T.StructField("previous", self.schema[self.value].dataType)]
        return self._read("answers", [*self.schema.fields, *added]).drop("_piece")

    def add(self, rows: DataFrame, batch: int) -> list[int]:
        """Takes in batch number ``batch`` and returns the pieces that were answered anew."""
        down = F.expr(f"(`{self.order}` - pmod(`{self.order}`, {self.width})) div {self.width}")  # whole numbers, however large
        piece = F.coalesce(down.cast("long"), F.lit(FIRST_PIECE))
        self._write(rows.select(*self.schema.names).withColumns({"_piece": piece, "_batch": F.lit(batch).cast("long")}), "rows", "_piece", "_batch")
        new = self.rows().filter(F.col("_batch") == batch)
        touched = [r["_piece"] for r in new.select("_piece").distinct().collect()]  # one number a piece
        if not touched:
            return []
        last = F.max_by(F.struct(F.col(self.value).alias("v")), F.struct(self.order, self.value))
        fresh = self.rows().filter(F.col("_piece").isin(touched)).groupBy("_piece", *self.keys).agg(last.alias("_value"))
        self._write(fresh, "tails", "_piece")
        # For every key and piece the last value before it, and the piece after it.
        place = Window.partitionBy(F.xxhash64(*self.keys), *self.keys).orderBy("_piece")
        around = self.tails().withColumns({"_seed": F.lag("_value").over(place), "_next": F.lead("_piece").over(place)})
        own = new.select("_piece", *self.keys).distinct().withColumnsRenamed({c: f"_own{c}" for c in ("_piece", *self.keys)})
        equal = [F.col(c).eqNullSafe(F.col(f"_own{c}")) for c in ("_piece", *self.keys)]
        follow = around.join(own, reduce(Column.__and__, equal), "left_semi")
        dirty = sorted({*touched, *(r["_next"] for r in follow.select("_next").dropna().distinct().collect())})
        seeds = (around.filter(F.col("_piece").isin(dirty) & F.col("_seed").isNotNull())
                 .select(*self.keys, "_piece", F.col("_seed").alias("_value"), F.lit(True).alias("_is_seed")))
        mine = (self.rows().filter(F.col("_piece").isin(dirty)).drop("_batch")
                .withColumns({"_value": F.struct(F.col(self.value).alias("v")), "_is_seed": F.lit(False)}))
        local = Window.partitionBy(F.xxhash64(*self.keys, "_piece"), *self.keys, "_piece").orderBy(F.desc("_is_seed"), self.order, self.value)
        answered = (mine.unionByName(seeds, allowMissingColumns=True).withColumn("_prev", F.lag("_value").over(local)).filter(~F.col("_is_seed"))
                    .select(*self.schema.names, F.col("_prev").isNull().alias("is_first"), F.col("_prev.v").alias("previous"), "_piece"))
        self._write(answered, "answers", "_piece")
        return dirty


def change_only(history: PreviousByPieces) -> DataFrame:
    """Rows whose key was new or whose value differed from the key's preceding row, late rows counted in their place."""
    changed = F.col("is_first") | ~F.col("previous").eqNullSafe(F.col(history.value))
    return history.answers().filter(changed).select(*history.schema.names)


def ttl_access(history: PreviousByPieces, ttl_seconds: int) -> DataFrame:
    """Adds ``hit``: the key's preceding access is at most ``ttl_seconds`` old; ``history`` is kept over the time stamps."""
    alive = F.col("previous") + F.make_dt_interval(secs=F.lit(ttl_seconds)) >= F.col(history.value)
    return history.answers().select(*history.schema.names, F.coalesce(alive, F.lit(False)).alias("hit"))
