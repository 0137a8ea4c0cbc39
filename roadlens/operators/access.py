"""Random access traces and repeat-access statistics.

The random number of a draw is a column ``u`` in [0, 1), so every operator here
is a plain expression and a trace can be computed again after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators.ordered import CHUNK_ROWS, Ranked, previous_in_key, range_of_position, running_total
from roadlens.session import scratch_path

CONCENTRATION = 5


def unit_draw(seq: Column, seed: int) -> Column:
    """A number in [0, 1) that depends only on ``seq`` and ``seed``."""
    return F.shiftrightunsigned(F.xxhash64(seq, F.lit(seed)), 11) * F.lit(2.0 ** -53)


def draws(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """``n`` draws ``(seq, u)``."""
    return spark.range(n).select(F.col("id").alias("seq"),
                                 unit_draw(F.col("id"), seed).alias("u"))


def uniform_rank(u: Column, population: Column) -> Column:
    return F.floor(u * population)


def exponential_rank(u: Column, population: Column) -> Column:
    """Rank of an exponential with mean population/5, cut to the population."""
    beta = population / F.lit(float(CONCENTRATION))
    inside = F.lit(1.0) - u * (F.lit(1.0) - F.exp(F.lit(float(-CONCENTRATION))))
    return F.floor(-beta * F.ln(inside))


RANKS = {"uniform": uniform_rank, "exponential": exponential_rank}


def sampled_ranks(trace: DataFrame, table: DataFrame | Ranked, law: str = "exponential") -> DataFrame:
    """Adds ``rank``: the row of ``table`` each access goes to."""
    size = F.lit(table.rows).cast("long") if isinstance(table, Ranked) else table.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (trace.withColumn("_n", size)
            .filter(F.col("_n") > 0)
            .withColumn("rank", RANKS[law](F.col("u"), F.col("_n")).cast("bigint")).drop("_n"))


def rank_lookup(ranks: DataFrame, ranked: DataFrame | Ranked) -> DataFrame:
    """The row behind each rank; ``ranked`` has one row per rank. Of a written one only the ranges asked for are read."""
    return ranks.join(ranked.holding(ranks) if isinstance(ranked, Ranked) else ranked, "rank")


def ranked(table: DataFrame, order: Sequence[str], path: str | None = None, ranges: int | None = None) -> Ranked:
    """``table`` written in ranges of its rank, below the shared folder unless a ``path`` is given."""
    return Ranked.write(table, order, path or scratch_path(table.sparkSession, "ranked"), ranges)


def sample(trace: DataFrame, table: DataFrame | Ranked, order: Sequence[str],
           law: str = "exponential") -> DataFrame:
    """Rows of ``table`` drawn with replacement, one per access of ``trace``.

    The table is written once in ranges of its rank; a ``Ranked`` one is used as it is, for any number of traces.
    """
    table = table if isinstance(table, Ranked) else ranked(table, order)
    return rank_lookup(sampled_ranks(trace, table, law), table)


def offset_fetch(df: DataFrame, order: Sequence[str], skip: int, enough: int = CHUNK_ROWS) -> DataFrame:
    """The one row after ``skip`` rows, near or far. ``order`` should identify a row.

    Rows are counted by ranges; only the range that holds the row is put in order, and of it each task keeps what can
    come before the row.
    """
    inside, position = range_of_position(df, order, skip, enough)
    return inside.orderBy(*order).offset(position).limit(1)


def trace_intervals(trace: DataFrame, law: str = "exponential",
                    chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds the wait after each access and the time reached, in whole microseconds."""
    u = F.col("u")
    seconds = {"uniform": F.lit(0.1) + F.lit(0.9) * u,
               "exponential": -F.ln(F.lit(1.0) - u)}[law]
    waits = trace.withColumn("gap_us", F.floor(seconds * F.lit(1e6)).cast("bigint"))
    return running_total(waits, "seq", "gap_us", "at_us", chunk_rows)


def repeat_access(df: DataFrame, key: str) -> DataFrame:
    """One row: accesses, hits (key seen before) and inserts. Counted per key first."""
    return (df.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("hits"),
                 F.count(F.lit(1)).alias("inserts")))


def ttl_access(df: DataFrame, key: str, order: str, stamp: str, ttl_seconds: int,
               chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``hit``: the key's preceding access is at most ``ttl_seconds`` old."""
    seen = previous_in_key(df, [key], order, stamp, chunk_rows)
    alive = F.col("previous") + F.make_dt_interval(secs=F.lit(ttl_seconds)) >= F.col(stamp)
    return seen.select(*df.columns, F.coalesce(alive, F.lit(False)).alias("hit"))
