"""Duplicate removal and keyed state in batch form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import text
from roadlens.operators.ordered import CHUNK_ROWS, previous_in_key, top_n_per_group

CHANGE_KEY = ("tipo", "lat", "lon", "subtipo")


def dedup_minute(df: DataFrame, order: Sequence[str] = ("hora", "row_id")) -> DataFrame:
    """One row per (tipo, ciudad, minute, ubicacion): the lowest in ``order``."""
    keyed = df.withColumn("_minute", text.minute_bucket(F.col("hora")))
    keys = ("tipo", "ciudad", "_minute", "ubicacion")
    return top_n_per_group(keyed, keys, [F.col(c) for c in order], 1).drop("_minute")


def change_only(df: DataFrame, keys: Sequence[str] = CHANGE_KEY, order: str = "row_id",
                value: str = "hora", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows whose key is new or whose ``value`` differs from the key's preceding row."""
    seen = previous_in_key(df, keys, order, value, chunk_rows)
    changed = F.col("is_first") | ~F.col("previous").eqNullSafe(F.col(value))
    return seen.filter(changed).select(df.columns)


def upsert_latest(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row written for each key, combined on the map side."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
            .select(*keys, "_row.*").select(df.columns))


def with_content_key(df: DataFrame, columns: Sequence[str] | None = None,
                     name: str = "key") -> DataFrame:
    names = list(columns or df.columns)
    return df.withColumn(name, text.content_key([F.col(f"`{c}`") for c in names]))
