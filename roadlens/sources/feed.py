"""Incident feed: nested payloads, one record per poll, to flat event records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.text import epoch_iso, natural_key
from roadlens.schemas import ALERT, FEED, FEED_KINDS


def read_feed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Payloads of a landing folder: JSON lines, or one indented document per file."""
    return spark.read.schema(FEED).option("multiLine", multi_line).json(path)


def alerts_of(kinds: Sequence[str] = FEED_KINDS) -> Column:
    """The requested arrays one after the other; a missing one is empty."""
    unknown = set(kinds) - set(FEED_KINDS)
    if unknown:
        raise ValueError(f"unknown kinds {sorted(unknown)}")
    empty = F.array().cast(f"array<{ALERT}>")
    return F.concat(*(F.coalesce(F.col(kind), empty) for kind in kinds))


def event_record(alert: str) -> list[Column]:
    """The seven event columns from an alert struct column."""
    return [
        F.col(f"{alert}.type").alias("tipo"),
        F.col(f"{alert}.subtype").alias("subtipo"),
        F.col(f"{alert}.street").alias("ubicacion"),
        F.col(f"{alert}.city").alias("ciudad"),
        epoch_iso(F.col(f"{alert}.pubMillis")).alias("hora"),
        F.col(f"{alert}.location.y").alias("lat"),
        F.col(f"{alert}.location.x").alias("lon"),
    ]


def flatten_feed(payloads: DataFrame, kinds: Sequence[str] = FEED_KINDS) -> DataFrame:
    """One event record per alert."""
    return payloads.select(F.explode(alerts_of(kinds)).alias("a")).select(*event_record("a"))


def flatten_in_order(payloads: DataFrame, kinds: Sequence[str] = FEED_KINDS, extra: Sequence[str] = (),
                     empty: bool = False) -> DataFrame:
    """Event records with their arrival place ``(poll, pos)``, natural key and ``extra`` columns of their payload.

    With ``empty`` a payload without alerts gives a row without ``pos``.
    """
    spread = F.posexplode_outer if empty else F.posexplode
    return (payloads.select("poll", *extra, spread(alerts_of(kinds)).alias("pos", "a"))
            .select("poll", "pos", *extra, *event_record("a"))
            .withColumn("clave", natural_key(F.col("tipo"), F.col("lat"),
                                             F.col("lon"), F.col("subtipo"))))
