"""Schemas of the feed, the event tables and the named datasets."""

from __future__ import annotations

from dataclasses import dataclass

# Columns and types of the feed, the event tables and the reports.
ALERT = (
    "struct<type string, subtype string, street string, city string, "
    "pubMillis bigint, location struct<x double, y double>>"
)

# One record per poll. `poll` is the capture number or time written by whoever
# lands the payload; the payload itself carries only the two arrays.
FEED = f"alerts array<{ALERT}>, traffic array<{ALERT}>, poll bigint"

FEED_KINDS = ("alerts", "traffic")

EVENT_COLUMNS = ("tipo", "subtipo", "ubicacion", "ciudad", "hora", "lat", "lon")

POSITIONAL = (
    "tipo string, subtipo string, ubicacion string, ciudad string, "
    "hora string, lat float, lon float"
)

DOCUMENT_NAMES = {
    "ubicacion": "calle",
    "ciudad": "comuna",
    "hora": "fecha",
    "lat": "latitud",
    "lon": "longitud",
}

# An unknown file has at least this many columns.
GENERIC_WIDTH = 10

REPORT_SCHEMAS = {
    "incidentes_por_comuna": "ciudad string, total bigint, cantidad_incidentes bigint",
    "incidentes_ciudad_tipo": "ciudad string, tipo string, total bigint",
    "event_counts": "tipo string, total bigint",
    "evolucion_temporal_diaria": "fecha string, total_incidentes bigint",
    "evolucion_por_tipo": "fecha string, tipo string, total bigint",
    "distribucion_horaria": "hora_dia string, total_incidentes bigint",
    "picos_por_hora_tipo": "hora_dia string, tipo string, total bigint",
}


@dataclass(frozen=True)
class Dataset:
    """Where a named CSV goes in the keyed snapshot and how its columns are called."""

    namespace: str
    ddl: str
    aliases: tuple[str, ...]


_DOCUMENT_DDL = (
    "tipo string, subtipo string, calle string, comuna string, "
    "fecha string, latitud double, longitud double"
)

# Snapshot namespaces, column names and the names by which a file is recognised.
SNAPSHOT_DATASETS = (
    Dataset("incidentes:por_ciudad", "comuna string, tipo string, conteo bigint",
            ("incidentes_ciudad_tipo", "incidentes_por_ciudad")),
    Dataset("incidentes:global", "tipo string, conteo bigint",
            ("conteo_eventos", "event_counts")),
    Dataset("incidentes:horarios", "hora string, tipo string, conteo bigint",
            ("peak_por_horario", "picos_por_hora_tipo")),
    Dataset("incidentes:horarios", "hora string, conteo bigint",
            ("distribucion_horaria",)),
    Dataset("incidentes:resumen_comunas", "comuna string, total bigint, dummy bigint",
            ("incidente_por_comuna", "incidentes_por_comuna")),
    Dataset("datos:sin_procesar", _DOCUMENT_DDL, ("no_processing_data",)),
    Dataset("datos:filtrados", _DOCUMENT_DDL, ("filtered_events",)),
    Dataset("datos:unicos", _DOCUMENT_DDL, ("data_unique",)),
    Dataset("analisis:evolucion_diaria", "fecha string, cantidad bigint",
            ("evolucion_temporal_diaria",)),
    Dataset("analisis:evolucion_tipo", "fecha string, tipo_evento string, cantidad bigint",
            ("evolucion_por_tipo",)),
)

# Index side: datasets whose columns have names; every other one is read as generic.
INDEX_SCHEMAS = {
    "no_processing_data": _DOCUMENT_DDL,
    "filtered_events": _DOCUMENT_DDL,
    "data_unique": _DOCUMENT_DDL,
    "event_counts": "tipo_evento string, cantidad bigint",
}


def snapshot_dataset(name: str) -> Dataset | None:
    """The dataset a file name stands for, or None when it is not known."""
    return next((d for d in SNAPSHOT_DATASETS if any(a in name for a in d.aliases)), None)


# Index types of the fields that every document may have, and of the named datasets.
COMMON_MAPPING = {"@timestamp": "date", "location": "geo_point"}
EVENT_MAPPING = {
    "tipo": "keyword",
    "subtipo": "keyword",
    "calle": "text",
    "comuna": "keyword",
    "fecha": "date",
    "latitud": "float",
    "longitud": "float",
}
INDEX_MAPPINGS = {
    "no_processing_data": EVENT_MAPPING,
    "filtered_events": EVENT_MAPPING,
    "data_unique": EVENT_MAPPING,
    "event_counts": {"tipo_evento": "keyword", "cantidad": "integer"},
}


def index_mapping(name: str) -> dict[str, str] | None:
    """Declared field types of an indexed dataset, or None."""
    return next((fields for key, fields in INDEX_MAPPINGS.items() if key in name), None)


def index_schema(name: str) -> str | None:
    """DDL of an indexed dataset, or None when its columns are generic."""
    return next((ddl for key, ddl in INDEX_SCHEMAS.items() if key in name), None)
