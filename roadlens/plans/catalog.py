"""Every operator as a named query over the given tables, with its oracle SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions import text, typing
from roadlens.operators import access, clean, dedup, incremental, ordered, reports, snapshot
from roadlens.operators import documents as D
from roadlens.operators import search as S
from roadlens.plans import incident_tables as tables
from roadlens.plans import oracle as O
from roadlens.plans import pipeline
from roadlens.schemas import POSITIONAL, REPORT_SCHEMAS
from roadlens.session import scratch_path
from roadlens.sinks.batches import children
from roadlens.sinks import files as sinks
from roadlens.sources import feed
from roadlens.sources import files as sources
from roadlens.streaming import changes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.datetime(2024, 1, 31)
EXPECTED = ["data_unique", "filtered_events", "distribucion_horaria"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 4)
                           for c in ("lat", "lon") if c in df.columns})


def _events(df: DataFrame) -> DataFrame:
    return _rounded(df.drop("row_id"))


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return feed.read_feed(spark, tables.land_feed(spark, sf, scratch_path(spark, "landing")))


def _doc_source(df: DataFrame) -> DataFrame:
    return D.doc_rename(df.drop("row_id"))


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return D.documents(_doc_source(tables.unique(spark, sf)), AS_OF)


# ---- sources -----------------------------------------------------------------------------

@query("feed_flatten", O.derived(f"SELECT {O.FEED_EVENTS} FROM incidents"))
def _(spark, sf):
    return _rounded(feed.flatten_feed(_feed(spark, sf)))


@query("store_scan", O.derived(
    f"SELECT row_id, {O.EVENTS} FROM raw ORDER BY row_id LIMIT 100"))
def _(spark, sf):
    path = scratch_path(spark, "store")
    sinks.store_append(tables.raw(spark, sf), path)
    return _rounded(sources.store_scan(spark, path, 100, ["row_id"]))


@query("store_scan_all", O.derived(f"SELECT row_id, {O.EVENTS} FROM raw"))
def _(spark, sf):
    path = scratch_path(spark, "store")
    sinks.store_append(tables.raw(spark, sf), path)
    return _rounded(sources.store_scan_all(spark, path))


@query("load_positional", O.derived(f"SELECT {O.EVENTS} FROM raw"))
def _(spark, sf):
    path = scratch_path(spark, "positional")
    sinks.store_delimited(tables.raw(spark, sf).drop("row_id"), path)
    return _rounded(sources.load_positional(spark, path))


@query("load_named", O.derived(
    "SELECT tipo, subtipo, ubicacion AS calle, ciudad AS comuna, hora AS fecha, "
    "round(lat, 4) AS latitud, round(lon, 4) AS longitud FROM filtered"))
def _(spark, sf):
    path = scratch_path(spark, "named")
    sinks.store_delimited(tables.filtered(spark, sf).drop("row_id"), path)
    rows = sources.load_named(spark, path, "filtered_events.csv")
    return rows.withColumns({c: F.round(c, 4) for c in ("latitud", "longitud")})


@query("load_generic", O.derived(
    "SELECT tipo AS campo_0, subtipo AS campo_1, ubicacion AS campo_2, ciudad AS campo_3, "
    "hora AS campo_4, round(lat, 4) AS campo_5, round(lon, 4) AS campo_6, "
    "CAST(NULL AS DOUBLE) AS campo_7, CAST(NULL AS DOUBLE) AS campo_8, "
    "CAST(NULL AS DOUBLE) AS campo_9 FROM raw"))
def _(spark, sf):
    path = scratch_path(spark, "generic")
    sinks.store_delimited(tables.raw(spark, sf).drop("row_id"), path)
    rows = sources.load_generic(spark, path)
    return rows.withColumns({c: F.round(c, 4) for c in ("campo_5", "campo_6")})


@query("result_read", O.derived("SELECT tipo, count(tipo) AS total FROM uniq GROUP BY tipo"))
def _(spark, sf):
    path = scratch_path(spark, "result")
    sinks.result_save(reports.event_counts(tables.unique(spark, sf)), path)
    return sources.result_read(spark, path, REPORT_SCHEMAS["event_counts"])


@query("dataset_inventory", O.derived(
    "SELECT 'event_counts' AS dataset, CAST(sum(strlen(tipo) + strlen(CAST(total AS VARCHAR)) + 2) AS BIGINT) AS bytes "
    "FROM (SELECT tipo, count(tipo) AS total FROM uniq GROUP BY tipo) q UNION ALL "
    "SELECT 'filtered_events', CAST(sum(strlen(CAST(row_id AS VARCHAR)) + strlen(tipo) + coalesce(strlen(subtipo), 0) + "
    "coalesce(strlen(ubicacion), 0) + coalesce(strlen(ciudad), 0) + strlen(hora) + strlen(CAST(lat AS VARCHAR)) + "
    "strlen(CAST(lon AS VARCHAR)) + 8) AS BIGINT) FROM filtered"))
def _(spark, sf):
    root = scratch_path(spark, "inventory")
    filtered = tables.filtered(spark, sf)
    sinks.store_delimited(filtered, f"{root}/filtered_events")
    sinks.replace_output(filtered, f"{root}/not_listed")
    sinks.publish(reports.event_counts(dedup.dedup_minute(filtered)), f"{root}/event_counts")
    return (sources.dataset_inventory(spark, root)
            .groupBy(F.element_at(F.split("path", "/"), -2).alias("dataset"))
            .agg(F.sum("bytes").alias("bytes")))


def _ingested(spark: SparkSession, sf: str, changes_only: bool) -> DataFrame:
    root = scratch_path(spark, "ingest")
    # The polls land in order, in three parts, and are read a part at a time: state crosses batches.
    landing = tables.land_feed(spark, sf, f"{root}/landing", writes=3, files=4)
    files = max(1, sum(n.startswith("part-") for n in children(spark, landing)) // 3)
    run = lambda: changes.start_ingest(spark, landing, f"{root}/store", f"{root}/checkpoint", changes_only,
                                       available_now=True, max_files=files).awaitTermination()
    run()
    if not changes_only:  # all polls are delivered again under other names, and the loop starts anew
        spark.read.text(landing).write.mode("append").text(landing)
        run()
    return _rounded(sources.store_scan_all(spark, f"{root}/store"))


@query("feed_stream", O.derived(f"SELECT {O.FEED_EVENTS} FROM incidents"))
def _(spark, sf):
    return _ingested(spark, sf, changes_only=False)


# The feed's arrival order: polls, in a poll alerts before traffic, in both by row_id.
CHANGED_FEED = f"""
SELECT {O.FEED_EVENTS} FROM (
  SELECT *, lag(coalesce(pub_millis, 0)) OVER w AS prev, row_number() OVER w AS rn FROM incidents
  WINDOW w AS (PARTITION BY tipo, lat, lon, subtipo
               ORDER BY row_id // 1000, event_id % 2, row_id)) q
WHERE rn = 1 OR prev <> coalesce(pub_millis, 0)"""


@query("stream_change_only", O.derived(CHANGED_FEED))
def _(spark, sf):
    return _ingested(spark, sf, changes_only=True)


# ---- sinks -------------------------------------------------------------------------------

@query("store_append", O.derived(f"SELECT row_id, {O.EVENTS} FROM raw"))
def _(spark, sf):
    path = scratch_path(spark, "store")
    rows = tables.raw(spark, sf)
    for batch in (rows.filter("ciudad IS NULL"), rows.filter("ciudad IS NOT NULL")):
        sinks.store_append(batch, path)
    return _rounded(sources.store_scan_all(spark, path))


@query("csv_export", O.derived(f"SELECT {O.EVENTS} FROM raw"))
def _(spark, sf):
    path = scratch_path(spark, "export")
    sinks.csv_export(tables.raw(spark, sf).withColumnRenamed("row_id", "_id"), path)
    return _rounded(spark.read.schema(POSITIONAL).option("header", True).csv(path))


@query("store_delimited", O.derived(f"SELECT {O.EVENTS} FROM filtered"))
def _(spark, sf):
    path = scratch_path(spark, "delimited")
    sinks.store_delimited(tables.filtered(spark, sf).drop("row_id"), path, quoted=False)
    return _rounded(sources.load_positional(spark, path, quoted=False))


@query("replace_output", O.derived(f"SELECT row_id, {O.EVENTS} FROM filtered"))
def _(spark, sf):
    path = scratch_path(spark, "replaced")
    sinks.replace_output(tables.raw(spark, sf), path)
    sinks.replace_output(tables.filtered(spark, sf), path)
    return _rounded(spark.read.parquet(path))


BY_CITY_TYPE = "SELECT ciudad, tipo, count(tipo) AS total FROM uniq GROUP BY ciudad, tipo"


@query("publish_single", O.derived(BY_CITY_TYPE))
def _(spark, sf):
    path = scratch_path(spark, "publish")
    sinks.publish(reports.incidents_by_city_type(tables.unique(spark, sf)), path, single=True)
    return spark.read.schema(REPORT_SCHEMAS["incidentes_ciudad_tipo"]).csv(path)


DOCUMENTS = ('SELECT tipo, subtipo, calle, comuna, fecha, round(latitud, 4) AS latitud, '
             'round(longitud, 4) AS longitud, location, stamp AS "@timestamp" FROM docs')


@query("doc_index", O.derived(DOCUMENTS))
def _(spark, sf):
    root = scratch_path(spark, "index")
    path = sinks.doc_index(_docs(spark, sf), root, "data_unique")
    return spark.read.parquet(path).withColumns(
        {c: F.round(c, 4) for c in ("latitud", "longitud")})


def _datasets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Raw, filtered and unique events; each later one starts from the earlier one."""
    raw = tables.raw(spark, sf)
    filtered = clean.clean_events(raw)
    return {"no_processing_data": raw, "filtered_events": filtered,
            "data_unique": dedup.dedup_minute(filtered)}


@query("doc_index_all", O.derived(
    "SELECT 'data_unique' AS dataset, count(*) AS doc_count FROM uniq UNION ALL "
    "SELECT 'filtered_events', count(*) FROM filtered"))
def _(spark, sf):
    indexed = pipeline.index_events(_datasets(spark, sf), scratch_path(spark, "index"), AS_OF)
    return S.index_counts(indexed)


@query("result_copy", O.derived(BY_CITY_TYPE))
def _(spark, sf):
    path = scratch_path(spark, "copy")
    sinks.result_copy(reports.incidents_by_city_type(tables.unique(spark, sf)), path)
    return spark.read.schema(REPORT_SCHEMAS["incidentes_ciudad_tipo"]).csv(path)


CONTENT = ("tipo", "subtipo", "ubicacion", "ciudad", "hora", "lat", "lon")


@query("kv_snapshot", O.derived(
    "SELECT DISTINCT 'datos:unicos' AS namespace, "
    f"concat('datos:unicos:', {O.content_hash(CONTENT)}) AS key FROM uniq"))
def _(spark, sf):
    rows = tables.unique(spark, sf).drop("row_id")
    saved = pipeline.publish_snapshot({"data_unique": rows}, scratch_path(spark, "snapshot"))
    return saved.select("namespace", "key")


@query("result_save", O.derived(
    "SELECT nullif(regexp_extract(hora, '.*T(\\d{2}):\\d{2}:\\d{2}', 1), '') AS hora_dia, "
    "count(tipo) AS total_incidentes FROM uniq GROUP BY 1 HAVING hora_dia IS NOT NULL"))
def _(spark, sf):
    path = scratch_path(spark, "result")
    sinks.result_save(reports.hourly_distribution(tables.unique(spark, sf)), path)
    return sources.result_read(spark, path, REPORT_SCHEMAS["distribucion_horaria"])


# ---- projections -------------------------------------------------------------------------

@query("event_record", O.derived(f"SELECT {O.FEED_EVENTS} FROM incidents"))
def _(spark, sf):
    alerts = _feed(spark, sf).select(F.explode(feed.alerts_of()).alias("alert"))
    return _rounded(alerts.select(*feed.event_record("alert")))


@query("natural_key", O.derived(f"SELECT row_id, {O.NATURAL_KEY} AS clave FROM raw"))
def _(spark, sf):
    key = text.natural_key(F.col("tipo"), F.col("lat"), F.col("lon"), F.col("subtipo"))
    return tables.raw(spark, sf).select("row_id", key.alias("clave"))


@query("epoch_iso", O.derived(
    f"SELECT ms, {O.iso_millis('ms')} AS hora FROM ("
    "SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE 1700000000000 + event_id * 125 END AS ms "
    "FROM events) q"))
def _(spark, sf):
    event = F.col("event_id")
    ms = F.when(event % 7 != 0, F.lit(1700000000000) + event * 125)
    return (tables.table(spark, sf, "events").select(ms.alias("ms"))
            .withColumn("hora", text.epoch_iso(F.col("ms"))))


@query("standardise_type", O.derived(
    "SELECT row_id, CASE WHEN regexp_full_match(tipo, 'HAZARD.*') THEN 'HAZARD' "
    "ELSE tipo END AS tipo FROM raw"))
def _(spark, sf):
    return tables.raw(spark, sf).select(
        "row_id", text.standardise_type(F.col("tipo")).alias("tipo"))


@query("upper_city", O.derived("SELECT row_id, upper(ciudad) AS ciudad FROM raw"))
def _(spark, sf):
    return tables.raw(spark, sf).select("row_id", F.upper("ciudad").alias("ciudad"))


@query("minute_bucket", O.derived(
    "SELECT row_id, nullif(regexp_extract(hora, "
    "'(\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}).*', 1), '') AS minuto FROM raw"))
def _(spark, sf):
    return tables.raw(spark, sf).select(
        "row_id", text.minute_bucket(F.col("hora")).alias("minuto"))


@query("event_date", O.derived("SELECT row_id, substring(hora, 1, 10) AS fecha FROM raw"))
def _(spark, sf):
    return tables.raw(spark, sf).select("row_id", text.event_date(F.col("hora")).alias("fecha"))


@query("event_hour", O.derived(
    "SELECT row_id, nullif(regexp_extract(hora, '.*T(\\d{2}):\\d{2}:\\d{2}', 1), '') AS hora_dia "
    "FROM raw"))
def _(spark, sf):
    return tables.raw(spark, sf).select(
        "row_id", text.event_hour(F.col("hora")).alias("hora_dia"))


@query("flatten_key", O.derived(BY_CITY_TYPE))
def _(spark, sf):
    grouped = (tables.unique(spark, sf).groupBy(F.struct("ciudad", "tipo").alias("grupo"))
               .agg(F.count("tipo").alias("total")))
    return reports.flatten_key(grouped, "grupo")


@query("doc_rename", O.derived(
    "SELECT tipo, subtipo, ubicacion AS calle, ciudad AS comuna, hora AS fecha, "
    "lat AS latitud, lon AS longitud FROM raw"))
def _(spark, sf):
    return _doc_source(tables.raw(spark, sf))


@query("stringify_id", O.derived(
    "SELECT CAST(row_id AS VARCHAR) AS _id, tipo, hora FROM raw"))
def _(spark, sf):
    return tables.raw(spark, sf).select(F.col("row_id").cast("string").alias("_id"),
                                        "tipo", "hora")


# ---- filters -----------------------------------------------------------------------------

@query("bbox_filter", O.derived(
    f"SELECT row_id, {O.place()} FROM raw WHERE lat BETWEEN -33.66043364754692 "
    "AND -33.182467560110695 AND lon BETWEEN -70.89892476797105 AND -70.45397847890855"))
def _(spark, sf):
    return _rounded(clean.bbox_filter(tables.raw(spark, sf)).select("row_id", "lat", "lon"))


@query("feed_type_filter", O.derived(
    f"SELECT {O.FEED_EVENTS} FROM incidents WHERE event_id % 2 = 0"))
def _(spark, sf):
    return _rounded(feed.flatten_feed(_feed(spark, sf), kinds=("alerts",)))


@query("valid_events", O.derived(
    f"SELECT row_id, {O.EVENTS} FROM raw WHERE tipo IS NOT NULL AND hora IS NOT NULL "
    "AND regexp_full_match(hora, '\\d{4}-\\d{2}-\\d{2}.*') "
    "AND lat IS NOT NULL AND lon IS NOT NULL"))
def _(spark, sf):
    return _rounded(clean.valid_events(tables.raw(spark, sf)))


@query("clean_events", O.derived(f"SELECT row_id, {O.EVENTS} FROM filtered"))
def _(spark, sf):
    return _rounded(tables.filtered(spark, sf))


@query("valid_date", O.derived(
    "SELECT row_id, substring(hora, 1, 10) AS fecha FROM raw "
    "WHERE regexp_full_match(substring(hora, 1, 10), '\\d{4}-\\d{2}-\\d{2}')"))
def _(spark, sf):
    return clean.valid_date(tables.raw(spark, sf)).select("row_id", "fecha")


@query("valid_hour", O.derived(
    "SELECT * FROM (SELECT row_id, nullif(regexp_extract(hora, "
    "'.*T(\\d{2}):\\d{2}:\\d{2}', 1), '') AS hora_dia FROM raw) q WHERE hora_dia IS NOT NULL"))
def _(spark, sf):
    return clean.valid_hour(tables.raw(spark, sf)).select("row_id", "hora_dia")


# ---- document typing ---------------------------------------------------------------------

K_SQL = "regexp_extract(props, '([0-9]+)', 1)"
BAD_NUMBER_SQL = (f"CASE WHEN event_id % 7 = 0 THEN concat({K_SQL}, 'd') "
                  f"WHEN event_id % 11 = 0 THEN concat(' ', {K_SQL}, ' ') ELSE {K_SQL} END")


def _numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric text from the events, partly malformed or padded."""
    event, k = F.col("event_id"), F.get_json_object("props", "$.k")
    number = (F.when(event % 7 == 0, F.concat(k, F.lit("d")))
              .when(event % 11 == 0, F.concat(F.lit(" "), k, F.lit(" "))).otherwise(k))
    return tables.table(spark, sf, "events").select("event_id", "value", number.alias("number"))


@query("doc_to_float",
       f"SELECT event_id, TRY_CAST({BAD_NUMBER_SQL} AS DOUBLE) AS latitud, "
       "value AS longitud FROM events")
def _(spark, sf):
    rows = _numbers(spark, sf)
    return rows.select(
        "event_id",
        typing.coerce(F.col("number"), "latitud", rows.schema["number"].dataType).alias("latitud"),
        typing.coerce(F.col("value"), "longitud", rows.schema["value"].dataType).alias("longitud"))


@query("doc_to_int",
       f"SELECT event_id, TRY_CAST({BAD_NUMBER_SQL} AS BIGINT) AS cantidad, "
       "CAST(trunc(value) AS BIGINT) AS hora FROM events")
def _(spark, sf):
    rows = _numbers(spark, sf)
    return rows.select(
        "event_id",
        typing.coerce(F.col("number"), "cantidad", rows.schema["number"].dataType).alias("cantidad"),
        typing.coerce(F.col("value"), "hora", rows.schema["value"].dataType).alias("hora"))


@query("doc_to_date", O.derived(
    "SELECT row_id, TRY_CAST(nullif(hora, 'hora') AS TIMESTAMP) AS fecha FROM raw"))
def _(spark, sf):
    rows = tables.raw(spark, sf)
    return rows.select("row_id", typing.coerce(F.col("hora"), "fecha",
                                               rows.schema["hora"].dataType).alias("fecha"))


@query("doc_to_string", O.derived(
    "SELECT CAST(row_id AS VARCHAR) AS row_id, tipo, subtipo, ubicacion AS calle, "
    "ciudad AS comuna FROM raw"))
def _(spark, sf):
    rows = D.doc_rename(tables.raw(spark, sf))
    return D.coerced(rows.select("row_id", "tipo", "subtipo", "calle", "comuna"))


@query("doc_geo_point", O.derived(
    "SELECT row_id, CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 "
    "THEN concat(CAST(lat AS VARCHAR), ',', CAST(lon AS VARCHAR)) END AS location FROM raw"))
def _(spark, sf):
    return tables.raw(spark, sf).select(
        "row_id", typing.geo_point(F.col("lat"), F.col("lon")).alias("location"))


# Coordinates from a positional file are 32-bit numbers and must keep their digits.
POSITIONAL_PLACE = ("CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 THEN concat(CAST(CAST(lat AS FLOAT) AS VARCHAR), "
                    "',', CAST(CAST(lon AS FLOAT) AS VARCHAR)) END")
POSITIONAL_KEY = ("concat(coalesce(tipo, 'None'), '_', coalesce(CAST(CAST(lat AS FLOAT) AS VARCHAR), 'None'), '_', "
                  "coalesce(CAST(CAST(lon AS FLOAT) AS VARCHAR), 'None'), '_', coalesce(subtipo, 'None'))")


@query("positional_documents", O.derived(
    f"SELECT tipo, hora, {POSITIONAL_PLACE} AS location, {POSITIONAL_KEY} AS clave FROM raw"))
def _(spark, sf):
    path = scratch_path(spark, "positional")
    sinks.store_delimited(tables.raw(spark, sf).drop("row_id"), path)
    key = text.natural_key(F.col("tipo"), F.col("lat"), F.col("lon"), F.col("subtipo"))
    return sources.load_positional(spark, path).select(
        "tipo", "hora", typing.geo_point(F.col("lat"), F.col("lon")).alias("location"), key.alias("clave"))


@query("doc_to_date_offsets", O.derived(
    "SELECT row_id, TRY_CAST(hora AS TIMESTAMP) - INTERVAL 2 HOUR AS plus, TRY_CAST(hora AS TIMESTAMP) AS zulu FROM filtered"))
def _(spark, sf):
    rows = tables.filtered(spark, sf)
    dates = {name: typing.to_date(F.concat("hora", F.lit(offset)), T.StringType())
             for name, offset in (("plus", "+02:00"), ("zulu", "Z"))}
    return rows.select("row_id", *[c.alias(n) for n, c in dates.items()])


@query("line_breaks", O.derived(
    "SELECT tipo, ubicacion || chr(10) || 'a, \"b\"' || chr(13) || chr(10) || 'c' AS ubicacion, hora FROM filtered"))
def _(spark, sf):
    path = scratch_path(spark, "breaks")
    rows = tables.filtered(spark, sf).drop("row_id").withColumn(
        "ubicacion", F.concat("ubicacion", F.lit('\na, "b"\r\nc')))
    sinks.store_delimited(rows, path)
    named = sources.load_named(spark, path, "filtered_events")
    positional = sources.load_positional(spark, path)
    both = named.select("tipo", F.col("calle").alias("ubicacion"), F.col("fecha").alias("hora"))
    same = snapshot.roundtrip_verify(positional.select("tipo", "ubicacion", "hora"), both).filter("matches")
    return both.join(F.broadcast(same.select("matches")), F.lit(True), "left_semi")


@query("doc_timestamp", O.derived(
    "SELECT CAST(row_id AS VARCHAR) AS row_id, coalesce(TRY_CAST(hora AS TIMESTAMP), "
    "TIMESTAMP '2024-01-31 00:00:00') AS stamp FROM raw"))
def _(spark, sf):
    rows = D.doc_rename(tables.raw(spark, sf)).select("row_id", "fecha")
    return D.documents(rows, AS_OF).select("row_id", F.col("@timestamp").alias("stamp"))


@query("doc_reject", O.derived(
    "SELECT count(*) FILTER (WHERE NOT empty) AS indexed, count(*) FILTER (WHERE empty) AS "
    "rejected FROM (SELECT subtipo IS NULL AND ubicacion IS NULL AND "
    "(hora = 'hora' OR ciudad IS NULL) AS empty FROM raw) q"))
def _(spark, sf):
    # A row whose stamp is a placeholder and whose texts are missing has nothing left.
    fecha = F.when(F.col("ciudad").isNotNull(), F.col("hora"))
    rows = tables.raw(spark, sf).select("subtipo", F.col("ubicacion").alias("calle"),
                                        fecha.alias("fecha"))
    return D.doc_reject(rows)


NAMED_FIELDS = [("tipo", "tipo", "keyword"), ("subtipo", "subtipo", "keyword"), ("calle", "ubicacion", "text"), ("comuna", "ciudad", "keyword"),
                ("fecha", "hora", "date"), ("latitud", "lat", "float"), ("longitud", "lon", "float")]


def _type_sql(dataset: str, source: str, field: str, column: str, declared: str | None) -> str:
    """The type of one column by its content, or the declared one while every value has it."""
    text, some = f"CAST({column} AS VARCHAR)", f"count({column})"
    integers, floats, dates = (f"count(TRY_CAST({text} AS {t}))" for t in ("BIGINT", "DOUBLE", "TIMESTAMP"))
    found = (f"CASE WHEN count(*) = {integers} AND {some} > 0 THEN 'integer' WHEN {some} = {floats} THEN 'float' "
             f"WHEN {some} = {dates} THEN 'date' WHEN bool_or(regexp_matches({text}, '\\s')) THEN 'text' ELSE 'keyword' END")
    fits = {"integer": f"{some} = {integers}", "float": f"{some} = {floats}", "date": f"{some} = {dates}", None: "false"}.get(declared, "true")
    return f"SELECT '{dataset}' AS dataset, '{field}' AS field, CASE WHEN {fits} THEN '{declared}' ELSE {found} END AS type FROM {source}"


_BY_DAY_TYPE = f"(SELECT fecha, tipo, count(tipo) AS total FROM (SELECT *, substring(hora, 1, 10) AS fecha FROM uniq WHERE regexp_full_match(substring(hora, 1, 10), '\\d{{4}}-\\d{{2}}-\\d{{2}}')) q GROUP BY fecha, tipo) m"
MAPPING_SQL = " UNION ALL ".join([
    *(_type_sql(d, t, *f) for d, t in (("data_unique", "uniq"), ("filtered_events", "filtered")) for f in NAMED_FIELDS),
    *(_type_sql("event_counts", "(SELECT tipo, count(tipo) AS total FROM uniq GROUP BY tipo) m", *f)
      for f in (("tipo_evento", "tipo", "keyword"), ("cantidad", "total", "integer"))),
    *(_type_sql("evolucion_por_tipo", _BY_DAY_TYPE, f"campo_{i}", c, None) for i, c in enumerate(["fecha", "tipo", "total", *["CAST(NULL AS DOUBLE)"] * 7])),
    "SELECT d, f, t FROM (VALUES ('data_unique'), ('filtered_events'), ('event_counts'), ('evolucion_por_tipo')) a(d), "
    "(VALUES ('@timestamp', 'date'), ('location', 'geo_point')) b(f, t)"])


@query("doc_mapping", O.derived(MAPPING_SQL))
def _(spark, sf):
    root = scratch_path(spark, "mapping")
    unique = tables.unique(spark, sf)
    sinks.replace_output(unique.drop("row_id"), f"{root}/unique")
    unique = spark.read.parquet(f"{root}/unique")
    sinks.store_delimited(unique, f"{root}/data_unique")
    sinks.publish(reports.event_counts(unique), f"{root}/event_counts")
    sinks.publish(reports.daily_evolution_by_type(unique), f"{root}/evolucion_por_tipo")
    sinks.store_delimited(tables.filtered(spark, sf).drop("row_id"), f"{root}/filtered_events")
    names = ("data_unique", "filtered_events", "event_counts", "evolucion_por_tipo")
    return reduce(DataFrame.unionAll, [D.content_mapping(n, sources.load_named(spark, f"{root}/{n}", n)) for n in names])


# ---- dedup and keyed state ---------------------------------------------------------------

@query("dedup_minute", O.derived(f"SELECT row_id, {O.EVENTS} FROM uniq"))
def _(spark, sf):
    return _rounded(tables.unique(spark, sf))


@query("change_only", O.derived(f"""
SELECT row_id, {O.EVENTS} FROM (
  SELECT *, lag(hora) OVER w AS prev, row_number() OVER w AS rn FROM raw
  WINDOW w AS (PARTITION BY tipo, lat, lon, subtipo ORDER BY row_id)) q
WHERE rn = 1 OR prev IS DISTINCT FROM hora"""))
def _(spark, sf):
    return _rounded(dedup.change_only(tables.raw(spark, sf)))


@query("upsert_latest", O.derived(f"""
SELECT row_id, {O.EVENTS} FROM (
  SELECT *, row_number() OVER (PARTITION BY tipo, lat, lon, subtipo
                               ORDER BY row_id DESC) AS rn FROM raw) q WHERE rn = 1"""))
def _(spark, sf):
    return _rounded(dedup.upsert_latest(tables.raw(spark, sf), dedup.CHANGE_KEY, "row_id"))


@query("content_key", O.derived(
    f"SELECT row_id, {O.content_hash(CONTENT)} AS key FROM uniq"))
def _(spark, sf):
    return dedup.with_content_key(tables.unique(spark, sf), CONTENT).select("row_id", "key")


# ---- reports -----------------------------------------------------------------------------

DATE_SQL = ("(SELECT *, substring(hora, 1, 10) AS fecha FROM uniq WHERE regexp_full_match("
            "substring(hora, 1, 10), '\\d{4}-\\d{2}-\\d{2}')) q")
HOUR_SQL = ("(SELECT * FROM (SELECT *, nullif(regexp_extract(hora, "
            "'.*T(\\d{2}):\\d{2}:\\d{2}', 1), '') AS hora_dia FROM uniq) h "
            "WHERE hora_dia IS NOT NULL) q")

REPORT_QUERIES = {
    "incidents_by_city": (reports.incidents_by_city,
                          "SELECT ciudad, count(tipo) AS total, count(*) AS cantidad_incidentes "
                          "FROM uniq GROUP BY ciudad"),
    "incidents_by_city_type": (reports.incidents_by_city_type, BY_CITY_TYPE),
    "event_counts": (reports.event_counts,
                     "SELECT tipo, count(tipo) AS total FROM uniq GROUP BY tipo"),
    "daily_evolution": (reports.daily_evolution,
                        "SELECT fecha, count(tipo) AS total_incidentes "
                        f"FROM {DATE_SQL} GROUP BY fecha"),
    "daily_evolution_by_type": (reports.daily_evolution_by_type,
                                "SELECT fecha, tipo, count(tipo) AS total "
                                f"FROM {DATE_SQL} GROUP BY fecha, tipo"),
    "hourly_distribution": (reports.hourly_distribution,
                            "SELECT hora_dia, count(tipo) AS total_incidentes "
                            f"FROM {HOUR_SQL} GROUP BY hora_dia"),
    "hourly_peaks_by_type": (reports.hourly_peaks_by_type,
                             "SELECT hora_dia, tipo, count(tipo) AS total "
                             f"FROM {HOUR_SQL} GROUP BY hora_dia, tipo"),
}

for _name, (_report, _sql) in REPORT_QUERIES.items():
    query(_name, O.derived(_sql))(
        lambda spark, sf, report=_report: report(tables.unique(spark, sf)))


@query("report_suite", O.derived(f"""
SELECT 'incidentes_por_comuna' AS report, ciudad AS k1, NULL AS k2, count(tipo) AS total
  FROM uniq GROUP BY ciudad
UNION ALL SELECT 'incidentes_ciudad_tipo', ciudad, tipo, count(tipo) FROM uniq GROUP BY ciudad, tipo
UNION ALL SELECT 'event_counts', tipo, NULL, count(tipo) FROM uniq GROUP BY tipo
UNION ALL SELECT 'evolucion_temporal_diaria', fecha, NULL, count(tipo) FROM {DATE_SQL}
  GROUP BY fecha
UNION ALL SELECT 'evolucion_por_tipo', fecha, tipo, count(tipo) FROM {DATE_SQL} GROUP BY fecha, tipo
UNION ALL SELECT 'distribucion_horaria', hora_dia, NULL, count(tipo) FROM {HOUR_SQL}
  GROUP BY hora_dia
UNION ALL SELECT 'picos_por_hora_tipo', hora_dia, tipo, count(tipo) FROM {HOUR_SQL}
  GROUP BY hora_dia, tipo"""))
def _(spark, sf):
    root = scratch_path(spark, "batch")
    pipeline.batch_reports(tables.raw(spark, sf), root)
    parts = {}
    for name, ddl in REPORT_SCHEMAS.items():
        saved = spark.read.schema(ddl).csv(f"{root}/{name}.csv")
        keys = [c for c in saved.columns if saved.schema[c].dataType.simpleString() == "string"]
        total = next(c for c in saved.columns if c.startswith("total"))
        k2 = F.col(keys[1]) if len(keys) > 1 else F.lit(None).cast("string")
        parts[name] = saved.select(F.col(keys[0]).alias("k1"), k2.alias("k2"),
                                   F.col(total).alias("total"))
    return S.family_union(parts).withColumnRenamed("dataset", "report")


# ---- buckets and counts ------------------------------------------------------------------

@query("terms_type", O.derived(O.terms("tipo", 10)))
def _(spark, sf):
    return S.terms(_docs(spark, sf), "tipo", 10)


@query("terms_city", O.derived(O.terms("comuna", 10)))
def _(spark, sf):
    return S.terms(_docs(spark, sf), "comuna", 10)


@query("date_histogram", O.derived(O.histogram("day", "1 DAY")))
def _(spark, sf):
    return S.date_histogram(_docs(spark, sf), "day")


# The same steps for the oracle; a week starts on Monday on both sides.
ORACLE_STEPS = {"minute": "1 MINUTE", "hour": "1 HOUR", "week": "7 DAY", "month": "1 MONTH",
                "quarter": "3 MONTH", "year": "1 YEAR"}


@query("date_histogram_units", O.derived(" UNION ALL ".join(
    f"SELECT '{unit}' AS unit, key, doc_count FROM ({O.histogram(unit, step)}) h"
    for unit, step in ORACLE_STEPS.items())))
def _(spark, sf):
    docs = _docs(spark, sf).select("@timestamp")
    return S.family_union({unit: S.date_histogram(docs, unit) for unit in ORACLE_STEPS}
                          ).withColumnRenamed("dataset", "unit")


@query("recent_count", O.derived(
    "SELECT count(*) AS total FROM docs WHERE stamp >= TIMESTAMP '2024-01-30 00:00:00'"))
def _(spark, sf):
    return S.recent_count(_docs(spark, sf), AS_OF, 24)


@query("total_hits", O.derived("SELECT count(*) AS total FROM docs"))
def _(spark, sf):
    return S.total_hits(_docs(spark, sf))


COUNTS_SQL = ("SELECT 'data_unique' AS dataset, count(*) AS doc_count FROM uniq UNION ALL "
              "SELECT 'filtered_events', count(*) FROM filtered UNION ALL "
              "SELECT 'no_processing_data', count(*) FROM raw")


def _written_datasets(spark: SparkSession, sf: str) -> dict[str, str]:
    """Raw, filtered and unique events, each written once, the later ones from the files of the earlier."""
    root = scratch_path(spark, "datasets")
    paths = {name: f"{root}/{name}" for name in ("no_processing_data", "filtered_events", "data_unique")}
    sinks.replace_output(tables.raw(spark, sf), paths["no_processing_data"])
    sinks.replace_output(clean.clean_events(spark.read.parquet(paths["no_processing_data"])), paths["filtered_events"])
    sinks.replace_output(dedup.dedup_minute(spark.read.parquet(paths["filtered_events"])), paths["data_unique"])
    return paths


@query("index_counts", O.derived(COUNTS_SQL))
def _(spark, sf):
    return S.footer_counts(spark, _written_datasets(spark, sf))


@query("load_stats", O.derived(
    "SELECT count(*) AS archivos_procesados, CAST(sum(doc_count) AS BIGINT) AS total_documentos "
    f"FROM ({COUNTS_SQL}) q"))
def _(spark, sf):
    paths = _written_datasets(spark, sf)
    return snapshot.load_stats_of(S.footer_counts(spark, {**paths, "not_known": paths["data_unique"]}))


@query("publish_stats", O.derived(
    "SELECT count(*) AS archivos_procesados, CAST(sum(doc_count) AS BIGINT) AS total_documentos "
    f"FROM ({COUNTS_SQL}) q"))
def _(spark, sf):
    path = scratch_path(spark, "stats")
    pipeline.publish_stats({n: spark.read.parquet(p) for n, p in _written_datasets(spark, sf).items()}, path)
    return sources.result_read(spark, path, "archivos_procesados bigint, total_documentos bigint")


@query("freshness", O.derived(
    "SELECT NOT bool_and(coalesce(n, 0) > 0) AS reload, count(*) FILTER (coalesce(n, 0) > 0) AS present "
    "FROM (VALUES ('data_unique'), ('filtered_events'), ('distribucion_horaria')) e(dataset) LEFT JOIN "
    "(SELECT 'data_unique' AS dataset, count(*) AS n FROM uniq UNION ALL SELECT 'filtered_events', count(*) FROM filtered) q USING (dataset)"))
def _(spark, sf):
    """The hour report is not indexed, so the index must be loaded again."""
    root = scratch_path(spark, "index")
    pipeline.index_events(_datasets(spark, sf), root, AS_OF)
    return pipeline.freshness(spark, root, EXPECTED)


@query("completeness_check", O.derived(
    "SELECT e.dataset, coalesce(q.doc_count, 0) AS doc_count, coalesce(q.doc_count, 0) > 0 AS "
    "present FROM (VALUES ('data_unique'), ('filtered_events'), ('distribucion_horaria')) "
    f"e(dataset) LEFT JOIN ({COUNTS_SQL}) q ON q.dataset = e.dataset"))
def _(spark, sf):
    return snapshot.completeness(S.footer_counts(spark, _written_datasets(spark, sf)), EXPECTED)


# ---- order, limits, set operations -------------------------------------------------------

@query("first_per_group", O.derived("""
SELECT row_id, ciudad, tipo, hora FROM (
  SELECT *, row_number() OVER (PARTITION BY ciudad, tipo ORDER BY hora, row_id) AS rn FROM filtered
) q WHERE rn <= 3"""))
def _(spark, sf):
    rows = tables.filtered(spark, sf).select("row_id", "ciudad", "tipo", "hora")
    return ordered.top_n_per_group(rows, ["ciudad", "tipo"], [F.col("hora"), F.col("row_id")], 3)


@query("top_buckets", O.derived(O.terms("calle", 5)))
def _(spark, sf):
    return S.terms(_docs(spark, sf), "calle", 5)


@query("bucket_preview", O.derived(O.terms("comuna", 3)))
def _(spark, sf):
    return S.bucket_preview(S.terms(_docs(spark, sf), "comuna", 10), 3)


@query("offset_fetch", O.derived(
    f"SELECT row_id, {O.EVENTS} FROM raw ORDER BY row_id LIMIT 1 OFFSET 777"))
def _(spark, sf):
    return _rounded(access.offset_fetch(tables.raw(spark, sf), ["row_id"], 777))


@query("offset_fetch_far", O.derived(
    f"SELECT row_id, {O.EVENTS} FROM raw ORDER BY row_id LIMIT 1 OFFSET 1150"))
def _(spark, sf):
    return _rounded(access.offset_fetch(tables.raw(spark, sf), ["row_id"], 1150))


@query("sorted_listing", O.derived(
    "SELECT 'data-unique' AS dataset FROM uniq UNION SELECT 'filtered-events' FROM filtered"))
def _(spark, sf):
    """What the written index holds; the raw events are not indexed."""
    root = scratch_path(spark, "index")
    pipeline.index_events(_datasets(spark, sf), root, AS_OF)
    return S.indexed_listing(spark, root, sinks.INDEX_PREFIX)


@query("feed_union", O.derived(
    f"SELECT {O.FEED_EVENTS} FROM incidents WHERE event_id % 2 = 0 UNION ALL "
    f"SELECT {O.FEED_EVENTS} FROM incidents WHERE event_id % 2 = 1"))
def _(spark, sf):
    payloads = _feed(spark, sf)
    alerts, traffic = (feed.flatten_feed(payloads, (kind,)) for kind in ("alerts", "traffic"))
    return _rounded(alerts.unionAll(traffic))


@query("family_union", O.derived("""
SELECT 'event_counts' AS dataset, CAST(NULL AS BIGINT) AS row_id, tipo, NULL AS ciudad,
       count(tipo) AS total FROM uniq GROUP BY tipo
UNION ALL SELECT 'data_unique', row_id, tipo, ciudad, NULL FROM uniq
UNION ALL SELECT 'filtered_events', row_id, tipo, ciudad, NULL FROM filtered
UNION ALL SELECT 'no_processing_data', row_id, tipo, ciudad, NULL FROM raw"""))
def _(spark, sf):
    frames = _datasets(spark, sf)
    frames["event_counts"] = reports.event_counts(frames["data_unique"])
    return S.family_union(frames, ("row_id", "tipo", "ciudad", "total"))


@query("roundtrip_verify", O.derived(
    "SELECT count(*) AS original, count(*) AS loaded, true AS matches FROM filtered"))
def _(spark, sf):
    path = scratch_path(spark, "roundtrip")
    rows = tables.filtered(spark, sf)
    sinks.result_save(rows, path)
    return snapshot.roundtrip_verify(rows, sources.result_read(spark, path, rows.schema))


# ---- requests ----------------------------------------------------------------------------

def _answer_sql(name: str, buckets: str, where: str = "true") -> str:
    return (f"SELECT '{name}' AS request, 'hits' AS aggregation, CAST(NULL AS VARCHAR) AS key, "
            f"count(*) AS doc_count FROM docs WHERE {where}" + buckets)


def _buckets_sql(name: str, aggregation: str, sql: str, key: str = "key") -> str:
    return (f" UNION ALL SELECT '{name}', '{aggregation}', {key}, doc_count "
            f"FROM ({sql}) b_{aggregation}")


STATIC_SQL = " UNION ALL ".join([
    _answer_sql("eventos_por_tipo",
                _buckets_sql("eventos_por_tipo", "tipos", O.terms("tipo", 10))),
    _answer_sql("eventos_por_comuna",
                _buckets_sql("eventos_por_comuna", "comunas", O.terms("comuna", 10))),
    _answer_sql("eventos_recientes_24h", "", "stamp >= TIMESTAMP '2024-01-30 00:00:00'"),
])


@query("search", O.derived(_answer_sql("por_tiempo", _buckets_sql(
    "por_tiempo", "por_tiempo", O.histogram("day", "1 DAY"),
    "strftime(key, '%Y-%m-%dT%H:%M:%S')")) + " UNION ALL " + STATIC_SQL))
def _(spark, sf):
    docs = _docs(spark, sf)
    requests = {"por_tiempo": S.histogram_request("por_tiempo"), **S.STATIC_REQUESTS}
    return S.family_union({name: S.search(docs, request, AS_OF)
                           for name, request in requests.items()}
                          ).withColumnRenamed("dataset", "request")


# All indexed datasets as one family: events, filtered events and the hour report.
FAMILY = """family AS (
  SELECT tipo, comuna, stamp FROM docs UNION ALL
  SELECT tipo, ciudad, coalesce(TRY_CAST(hora AS TIMESTAMP), TIMESTAMP '2024-01-31 00:00:00') FROM filtered UNION ALL
  SELECT NULL, NULL, TIMESTAMP '2024-01-31 00:00:00' FROM (
    SELECT DISTINCT regexp_extract(hora, '.*T(\\d{2}):\\d{2}:\\d{2}', 1) AS h FROM uniq) q WHERE h <> '')"""


def _family_terms(field: str) -> str:
    return O.terms(field, 10).replace("FROM docs", "FROM family")


FAMILY_SQL = f"WITH {O.INCIDENTS}, {FAMILY} " + (" UNION ALL ".join([
    _answer_sql("eventos_por_tipo", _buckets_sql("eventos_por_tipo", "tipos", _family_terms("tipo"))),
    _answer_sql("eventos_por_comuna", _buckets_sql("eventos_por_comuna", "comunas", _family_terms("comuna"))),
    _answer_sql("eventos_recientes_24h", "", "stamp >= TIMESTAMP '2024-01-30 00:00:00'"),
    _answer_sql("por_tiempo", _buckets_sql("por_tiempo", "por_tiempo", O.histogram("day", "1 DAY", "family"),
                                           "strftime(key, '%Y-%m-%dT%H:%M:%S')")),
]).replace("FROM docs WHERE", "FROM family WHERE"))


def _indexed_files(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The chain from CSV files by name: names, types, documents, index. Reports are indexed too."""
    root = scratch_path(spark, "csv")
    frames = _datasets(spark, sf)
    for name in ("filtered_events", "data_unique"):
        sinks.store_delimited(frames[name].drop("row_id"), f"{root}/{name}")
    sinks.publish(reports.hourly_distribution(frames["data_unique"]), f"{root}/distribucion_horaria")
    loaded = {name: sources.load_named(spark, f"{root}/{name}", name)
              for name in ("filtered_events", "data_unique", "distribucion_horaria")}
    return pipeline.index_events(loaded, f"{root}/index", AS_OF)


@query("search_family", FAMILY_SQL)
def _(spark, sf):
    family = S.family_union(_indexed_files(spark, sf), ("tipo", "comuna", "@timestamp"))
    requests = {"por_tiempo": S.histogram_request("por_tiempo"), **S.STATIC_REQUESTS}
    return S.family_union({name: S.search(family, request, AS_OF) for name, request in requests.items()}
                          ).withColumnRenamed("dataset", "request")


@query("index_complete", O.derived(
    "SELECT 'data_unique' AS dataset, count(*) AS doc_count, count(*) > 0 AS present FROM uniq UNION ALL "
    "SELECT 'filtered_events', count(*), count(*) > 0 FROM filtered UNION ALL "
    "SELECT 'distribucion_horaria', count(*), count(*) > 0 FROM (SELECT DISTINCT "
    "regexp_extract(hora, '.*T(\\d{2}):\\d{2}:\\d{2}', 1) AS h FROM uniq) q WHERE h <> ''"))
def _(spark, sf):
    return snapshot.completeness(S.index_counts(_indexed_files(spark, sf)), EXPECTED)


@query("static_report", O.derived(STATIC_SQL))
def _(spark, sf):
    root = scratch_path(spark, "static")
    path = sinks.doc_index(_docs(spark, sf), root, "data_unique")
    saved = pipeline.static_report(spark.read.parquet(path), root, AS_OF)
    return pipeline.saved_answers(spark, saved)


# ---- access traces -----------------------------------------------------------------------

def _trace(spark: SparkSession, sf: str) -> DataFrame:
    """One access per event, with a draw computed from its number."""
    u = ((F.col("event_id") * 7919 + 104729) % 100003).cast("double") / 100003.0
    return tables.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), "ts", u.alias("u"))


def _sample_sql(law: str) -> str:
    return O.traced(f"SELECT t.seq, t.rank, r.row_id, r.tipo FROM trace_{law} t "
                    "JOIN ranked r ON r.rank = t.rank")


def _sampled(spark: SparkSession, sf: str, law: str) -> DataFrame:
    rows = tables.raw(spark, sf).select("row_id", "tipo")
    return (access.sample(_trace(spark, sf), rows, ["row_id"], law)
            .select("seq", "rank", "row_id", "tipo"))


@query("sample_uniform", _sample_sql("uniform"))
def _(spark, sf):
    return _sampled(spark, sf, "uniform")


@query("sample_exponential", _sample_sql("exponential"))
def _(spark, sf):
    return _sampled(spark, sf, "exponential")


@query("rank_lookup", O.traced(f"SELECT rank, row_id, {O.EVENTS} FROM ranked"))
def _(spark, sf):
    ranked = access.ranked(tables.raw(spark, sf), ["row_id"])
    return _rounded(access.rank_lookup(ranked.table().select("rank"), ranked))


@query("rank_lookup_few", O.traced(
    f"SELECT rank, row_id, {O.EVENTS} FROM ranked WHERE rank IN (SELECT event_id % 3 FROM events)"))
def _(spark, sf):
    """Few ranks of a table in many ranges: only the folders that hold them are read."""
    ranked = access.ranked(tables.raw(spark, sf), ["row_id"], ranges=16)
    asked = tables.table(spark, sf, "events").select((F.col("event_id") % 3).alias("rank")).distinct()
    return _rounded(access.rank_lookup(asked, ranked))


@query("trace_intervals", O.traced("""
SELECT law, seq, gap_us, CAST(sum(gap_us) OVER (PARTITION BY law ORDER BY seq) AS BIGINT) AS at_us
FROM (SELECT 'uniform' AS law, seq, CAST(floor((0.1 + 0.9 * u) * 1e6) AS BIGINT) AS gap_us FROM draws
      UNION ALL
      SELECT 'exponential', seq, CAST(floor(-ln(1.0 - u) * 1e6) AS BIGINT) FROM draws) q"""))
def _(spark, sf):
    trace = _trace(spark, sf).select("seq", "u")
    return (S.family_union({law: access.trace_intervals(trace, law) for law in access.RANKS})
            .select(F.col("dataset").alias("law"), "seq", "gap_us", "at_us"))


def _accesses(spark: SparkSession, sf: str) -> DataFrame:
    return access.sampled_ranks(_trace(spark, sf), tables.raw(spark, sf))


@query("repeat_access", O.traced(
    "SELECT count(*) AS total, count(*) - count(DISTINCT rank) AS hits, "
    "count(DISTINCT rank) AS inserts FROM trace_exponential"))
def _(spark, sf):
    return access.repeat_access(_accesses(spark, sf), "rank")


@query("ttl_access", O.traced("""
SELECT seq, rank, coalesce(ts - prev <= INTERVAL 3600 SECOND, false) AS hit FROM (
  SELECT *, lag(ts) OVER (PARTITION BY rank ORDER BY seq) AS prev FROM trace_exponential) q"""))
def _(spark, sf):
    return (access.ttl_access(_accesses(spark, sf), "rank", "seq", "ts", 3600)
            .select("seq", "rank", "hit"))


# ---- snapshot of all datasets ------------------------------------------------------------

# Dataset, namespace, columns as the report or table has them, names in the snapshot, rows.
_EVENT_NAMES = "tipo subtipo calle comuna fecha latitud longitud"
SNAPSHOT_SUITE = [
    ("incidentes_por_comuna", "incidentes:resumen_comunas", "ciudad total cantidad_incidentes", "comuna total dummy", "incidents_by_city"),
    ("incidentes_ciudad_tipo", "incidentes:por_ciudad", "ciudad tipo total", "comuna tipo conteo", "incidents_by_city_type"),
    ("event_counts", "incidentes:global", "tipo total", "tipo conteo", "event_counts"),
    ("evolucion_temporal_diaria", "analisis:evolucion_diaria", "fecha total_incidentes", "fecha cantidad", "daily_evolution"),
    ("evolucion_por_tipo", "analisis:evolucion_tipo", "fecha tipo total", "fecha tipo_evento cantidad", "daily_evolution_by_type"),
    ("distribucion_horaria", "incidentes:horarios", "hora_dia total_incidentes", "hora conteo", "hourly_distribution"),
    ("picos_por_hora_tipo", "incidentes:horarios", "hora_dia tipo total", "hora tipo conteo", "hourly_peaks_by_type"),
    ("no_processing_data", "datos:sin_procesar", " ".join(CONTENT), _EVENT_NAMES, "raw"),
    ("filtered_events", "datos:filtrados", " ".join(CONTENT), _EVENT_NAMES, "filtered"),
    ("data_unique", "datos:unicos", " ".join(CONTENT), _EVENT_NAMES, "uniq"),
]


def _suite_sql(namespace: str, columns: str, names: str, source: str) -> str:
    pairs = list(zip(columns.split(), names.split(), strict=True))
    number = ("total", "cantidad_incidentes", "total_incidentes", "lat", "lon")
    fields = ", ".join(f"""'"{n}":' || """ + (f"CAST({c} AS VARCHAR)" if c in number else f"to_json({c})") for c, n in pairs)
    body = REPORT_QUERIES[source][1] if source in REPORT_QUERIES else f"SELECT * FROM {source}"
    return (f"SELECT DISTINCT '{namespace}' AS namespace, concat('{namespace}:', {O.content_hash(columns.split())}) AS key, "
            f"concat('{{', concat_ws(',', {fields}), '}}') AS value FROM ({body}) s_{source}")


@query("snapshot_suite", O.derived(" UNION ".join(_suite_sql(*rest) for _, *rest in SNAPSHOT_SUITE)))
def _(spark, sf):
    root = scratch_path(spark, "suite")
    events = tables.raw(spark, sf)
    written = pipeline.batch_reports(events, root)
    for name, frame in {**written, "no_processing_data": events}.items():
        sinks.store_delimited(frame.drop("row_id"), f"{root}/csv/{name}")
    loaded = {}
    for name, *_ in SNAPSHOT_SUITE:
        path = f"{root}/{name}.csv" if name in REPORT_SCHEMAS else f"{root}/csv/{name}"
        loaded[name] = sources.load_named(spark, path, name, side="snapshot")
    return pipeline.publish_snapshot(loaded, f"{root}/snapshot").select("namespace", "key", "value")


# ---- drawing in the engine ---------------------------------------------------------------

@query("access_draws", O.traced("""
SELECT CAST(t.rank * 10 // p.n AS BIGINT) AS tenth, count(*) AS accesses, count(DISTINCT r.row_id) AS row_ids, count(DISTINCT r.ciudad) AS cities
FROM trace_exponential t JOIN ranked r ON r.rank = t.rank, population p GROUP BY 1"""))
def _(spark, sf):
    """Accesses by tenth of the ranked table, with the rows and cities they meet."""
    ranked = access.ranked(tables.raw(spark, sf).select("row_id", "ciudad"), ["row_id"])
    drawn = access.sample(_trace(spark, sf), ranked, ["row_id"])
    return (drawn.groupBy(F.floor(F.col("rank") * 10 / F.lit(max(ranked.rows, 1))).alias("tenth"))
            .agg(F.count(F.lit(1)).alias("accesses"), F.countDistinct("row_id").alias("row_ids"), F.countDistinct("ciudad").alias("cities")))


# ---- late rows ---------------------------------------------------------------------------

def _in_batches(spark: SparkSession, df: DataFrame, keys: list[str], order: str, value: str, width: int) -> incremental.PreviousByPieces:
    """``df`` added in three batches: every fifth number comes last, long after its place was settled; the second batch runs twice."""
    history = incremental.PreviousByPieces(spark, scratch_path(spark, "pieces"), df.schema, keys, order, value, width)
    late, far = F.col(order) % 5 == 2, F.floor(F.col(order) / width) % 2 == 1
    for number, rows in enumerate((df.filter(~late & ~far), df.filter(~late & far), df.filter(~late & far), df.filter(late))):
        history.add(rows, max(0, number - (number > 1)))
    return history


@query("change_only_late", ORACLES["change_only"])
def _(spark, sf):
    raw = tables.raw(spark, sf)
    return _rounded(incremental.change_only(_in_batches(spark, raw, list(dedup.CHANGE_KEY), "row_id", "hora", 50_000)))


@query("ttl_access_late", ORACLES["ttl_access"])
def _(spark, sf):
    accesses = _accesses(spark, sf).select("seq", "rank", "ts")
    return incremental.ttl_access(_in_batches(spark, accesses, ["rank"], "seq", "ts", 25_000), 3600).select("seq", "rank", "hit")
