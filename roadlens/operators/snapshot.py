"""Keyed snapshots and the checks made on saved data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.text import content_key
from roadlens.schemas import SNAPSHOT_DATASETS, snapshot_dataset


def kv_snapshot(df: DataFrame, namespace: str) -> DataFrame:
    """Each row as JSON under its namespace and content key; equal rows are one entry."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.distinct().select(
        F.lit(namespace).alias("namespace"),
        F.concat(F.lit(f"{namespace}:"), content_key(columns)).alias("key"),
        F.to_json(F.struct(*columns)).alias("value"),
    )


def known_datasets(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {n: f for n, f in frames.items() if snapshot_dataset(n)}


def load_snapshot(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Snapshot rows of every known dataset; unknown names are skipped."""
    parts = [kv_snapshot(f, snapshot_dataset(n).namespace)
             for n, f in known_datasets(frames).items()]
    whole = reduce(DataFrame.unionAll, parts)
    # Two datasets may share a namespace, and then a row.
    shared = len(parts) > len({snapshot_dataset(n).namespace for n in known_datasets(frames)})
    return whole.distinct() if shared else whole


def load_stats(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row: known datasets and their total rows."""
    parts = [f.agg(F.count(F.lit(1)).alias("n")) for f in known_datasets(frames).values()]
    return reduce(DataFrame.unionAll, parts).agg(
        F.count(F.lit(1)).alias("archivos_procesados"),
        F.sum("n").alias("total_documentos"))


def load_stats_of(counts: DataFrame) -> DataFrame:
    """The same row from the documents per dataset, as the files' footers give them."""
    aliases = [a for d in SNAPSHOT_DATASETS for a in d.aliases]
    known = reduce(Column.__or__, [F.col("dataset").contains(a) for a in aliases])
    return counts.filter(known).agg(F.count(F.lit(1)).alias("archivos_procesados"),
                                    F.coalesce(F.sum("doc_count"), F.lit(0)).cast("bigint").alias("total_documentos"))


def completeness(counts: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Per expected dataset its documents and whether it has any.

    ``counts`` is the result of ``index_counts``; ``expected`` is a short list of names.
    """
    names = counts.sparkSession.createDataFrame([(n,) for n in expected], "dataset string")
    found = F.coalesce(F.col("doc_count"), F.lit(0).cast("bigint"))
    return (names.join(counts, "dataset", "left")
            .select("dataset", found.alias("doc_count"), (found > 0).alias("present")))


def is_complete(counts: DataFrame, expected: Sequence[str]) -> DataFrame:
    return completeness(counts, expected).agg(F.bool_and("present").alias("complete"))


def roundtrip_verify(original: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: both counts and whether the two frames hold the same rows equally often.

    Each row counts +1 or -1, summed on the map side, so copies cost one shuffled row.
    """
    columns = original.columns
    signed = (original.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
              .unionAll(loaded.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    return (signed.groupBy(*(f"`{c}`" for c in columns))
            .agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))
            .agg(F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("original"),
                 F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("loaded"),
                 (F.count_if(F.col("a") != F.col("b")) == 0).alias("matches")))
