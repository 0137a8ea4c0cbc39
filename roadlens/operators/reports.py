"""The seven incident reports. `count("tipo")` leaves out rows without a type.

Each report is one aggregate with a map-side part. All seven together are sums
over one base count, so the events are read and shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import text
from roadlens.operators.clean import valid_date, valid_hour


def incidents_by_city(df: DataFrame) -> DataFrame:
    return df.groupBy("ciudad").agg(F.count("tipo").alias("total"),
                                    F.count(F.lit(1)).alias("cantidad_incidentes"))


def incidents_by_city_type(df: DataFrame) -> DataFrame:
    return df.groupBy("ciudad", "tipo").agg(F.count("tipo").alias("total"))


def event_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("tipo").agg(F.count("tipo").alias("total"))


def daily_evolution(df: DataFrame) -> DataFrame:
    return valid_date(df).groupBy("fecha").agg(F.count("tipo").alias("total_incidentes"))


def daily_evolution_by_type(df: DataFrame) -> DataFrame:
    return valid_date(df).groupBy("fecha", "tipo").agg(F.count("tipo").alias("total"))


def hourly_distribution(df: DataFrame) -> DataFrame:
    return valid_hour(df).groupBy("hora_dia").agg(F.count("tipo").alias("total_incidentes"))


def hourly_peaks_by_type(df: DataFrame) -> DataFrame:
    return valid_hour(df).groupBy("hora_dia", "tipo").agg(F.count("tipo").alias("total"))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "incidentes_por_comuna": incidents_by_city,
    "incidentes_ciudad_tipo": incidents_by_city_type,
    "event_counts": event_counts,
    "evolucion_temporal_diaria": daily_evolution,
    "evolucion_por_tipo": daily_evolution_by_type,
    "distribucion_horaria": hourly_distribution,
    "picos_por_hora_tipo": hourly_peaks_by_type,
}


def report_base(df: DataFrame) -> DataFrame:
    """Counts at the grain every report can be summed from."""
    return (df.groupBy("ciudad", "tipo",
                       text.event_date(F.col("hora")).alias("fecha"),
                       text.event_hour(F.col("hora")).alias("hora_dia"))
            .agg(F.count("tipo").alias("n"), F.count(F.lit(1)).alias("n_all")))


def reports_from_base(base: DataFrame) -> dict[str, DataFrame]:
    """All seven reports as sums over ``report_base``; persist the base to share it."""
    dated = base.filter(text.full_match(F.col("fecha"), text.DATE_PATTERN))
    timed = base.filter(F.col("hora_dia").isNotNull())

    def roll(rows: DataFrame, keys: tuple[str, ...], name: str = "total") -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("n").alias(name))

    return {
        "incidentes_por_comuna": base.groupBy("ciudad").agg(
            F.sum("n").alias("total"), F.sum("n_all").alias("cantidad_incidentes")),
        "incidentes_ciudad_tipo": roll(base, ("ciudad", "tipo")),
        "event_counts": roll(base, ("tipo",)),
        "evolucion_temporal_diaria": roll(dated, ("fecha",), "total_incidentes"),
        "evolucion_por_tipo": roll(dated, ("fecha", "tipo")),
        "distribucion_horaria": roll(timed, ("hora_dia",), "total_incidentes"),
        "picos_por_hora_tipo": roll(timed, ("hora_dia", "tipo")),
    }


def flatten_key(df: DataFrame, key: str) -> DataFrame:
    """Spreads a composite group key into its columns."""
    rest = [c for c in df.columns if c != key]
    return df.select(f"{key}.*", *rest)
