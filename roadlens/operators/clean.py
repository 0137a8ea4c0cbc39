"""Row validity and standardisation: one narrow stage, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import text


@dataclass(frozen=True)
class Box:
    top: float
    bottom: float
    left: float
    right: float


# The polled area.
DEFAULT_BOX = Box(top=-33.182467560110695, bottom=-33.66043364754692,
                  left=-70.89892476797105, right=-70.45397847890855)


def bbox_filter(df: DataFrame, box: Box = DEFAULT_BOX) -> DataFrame:
    """Events inside the area."""
    return df.filter(F.col("lat").between(box.bottom, box.top)
                     & F.col("lon").between(box.left, box.right))


def valid_events(df: DataFrame) -> DataFrame:
    """Events with a type, coordinates and a stamp that starts with a date."""
    return df.filter(
        F.col("tipo").isNotNull()
        & F.col("hora").isNotNull()
        & text.full_match(F.col("hora"), text.DATE_PREFIX_PATTERN)
        & F.col("lat").isNotNull()
        & F.col("lon").isNotNull())


def clean_events(df: DataFrame) -> DataFrame:
    """Valid events with one hazard type and upper-case cities."""
    return valid_events(df).withColumns({
        "tipo": text.standardise_type(F.col("tipo")),
        "ciudad": F.upper("ciudad"),
    })


def valid_date(df: DataFrame) -> DataFrame:
    """Adds ``fecha`` and keeps the rows where it is a date."""
    return (df.withColumn("fecha", text.event_date(F.col("hora")))
            .filter(text.full_match(F.col("fecha"), text.DATE_PATTERN)))


def valid_hour(df: DataFrame) -> DataFrame:
    """Adds ``hora_dia`` and keeps the rows that have one."""
    return (df.withColumn("hora_dia", text.event_hour(F.col("hora")))
            .filter(F.col("hora_dia").isNotNull()))
