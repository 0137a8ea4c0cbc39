"""Small helpers the operators share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import scratch_path

ARROW_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in Arrow batches of about ``ARROW_BYTES``, unless the session says otherwise.

    By default only the rows of a batch are bounded, and executor and worker hold a batch of long texts several times.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(ARROW_BYTES))


def lower_az(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, summed by Spark."""
    return docs.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0


def sampled(df: DataFrame, n: int, *by: str | Column) -> DataFrame:
    """At most ``n`` rows, those with the smallest hash of ``by``.

    Thinned to about twice as many first, so that no task hands on ``n`` rows of its own.
    """
    place = F.pmod(F.xxhash64(*by), F.lit(1 << 40))
    share = min(1.0, (2 * n + 100) / max(df.count(), 1))
    return df.filter(place < F.lit(int(share * (1 << 40)))).orderBy(place, *by).limit(n)


def give_back() -> None:
    """Returns what a task's Python has freed to the system; a worker that waits for its next task would hold it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def packed(df: DataFrame, *keep: str) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` as the columns ``keep`` and one struct of all others, and how to select each column back.

    So columns an operator adds or joins cannot clash with a column it only passes through.
    """
    others = [c for c in df.columns if c not in keep]
    names = [F.col(f"`{c}`") for c in keep]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None)
    back = {c: F.col(f"`{c}`") if c in keep else F.col("_rest").getField(c).alias(c) for c in df.columns}
    return df.select(*names, rest.alias("_rest")), back
