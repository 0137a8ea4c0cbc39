"""Records to typed index documents. Null means the document lacks the field."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions import typing
from roadlens.functions.text import iso_text, moment
from roadlens.schemas import COMMON_MAPPING, DOCUMENT_NAMES, index_mapping


def doc_rename(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(DOCUMENT_NAMES)


def coerced(df: DataFrame) -> DataFrame:
    """Every column under the rule of its name."""
    return df.select([typing.coerce(F.col(f"`{f.name}`"), f.name, f.dataType).alias(f.name)
                      for f in df.schema.fields])


def _all_null(df: DataFrame) -> Column:
    nothing = F.lit(True)
    for name in df.columns:
        nothing = nothing & F.col(f"`{name}`").isNull()
    return nothing


def documents(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Typed documents with ``location`` and ``@timestamp``; empty ones are left out.

    ``as_of`` is the load time given to documents without a usable ``fecha``.
    """
    typed = coerced(df)
    kept = typed.filter(~_all_null(typed))
    extra = {}
    if {"latitud", "longitud"} <= set(kept.columns):
        extra["location"] = typing.geo_point(F.col("latitud"), F.col("longitud"))
    loaded = moment(as_of)
    extra["@timestamp"] = F.coalesce("fecha", loaded) if "fecha" in kept.columns else loaded
    return kept.withColumns(extra)


def doc_reject(df: DataFrame) -> DataFrame:
    """One row: how many rows give a document and how many are rejected as empty."""
    typed = coerced(df)
    empty = _all_null(typed)
    return typed.agg(F.count_if(~empty).alias("indexed"), F.count_if(empty).alias("rejected"))


def document_json(df: DataFrame) -> DataFrame:
    """One JSON text per document, without its missing fields and with ISO stamps."""
    fields = [iso_text(F.col(f"`{f.name}`")).alias(f.name)
              if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
              else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def _generic_type(field: T.StructField) -> str:
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return "float"
    return "date" if typing.rule_of(field.name) == "date" else "text"


def doc_mapping(name: str, df: DataFrame) -> dict[str, str]:
    """Field types of a dataset: declared for the named ones, else from its columns."""
    declared = index_mapping(name) or {f.name: _generic_type(f) for f in df.schema.fields}
    return {**COMMON_MAPPING, **declared}


def content_mapping(name: str, df: DataFrame) -> DataFrame:
    """``dataset, field, type`` of a dataset from what its columns hold: one aggregate of typed counts per column.

    A column whose values are all whole numbers, without a gap, is an integer; all numbers, or nothing, a float; all
    dates, a date; others are keywords, or text if a value holds white space. A declared type stands as long as every value
    has it (keyword and text take any), else the content's type takes its place.
    """
    declared = index_mapping(name) or {}
    counts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        as_text, stamp = c.cast("string"), typing.to_date(c, f.dataType)
        counts.append(F.struct(
            F.lit(f.name).alias("field"), F.lit(declared.get(f.name)).cast("string").alias("declared"), F.count(c).alias("some"),
            F.count_if(as_text.rlike(typing.INTEGER_TEXT) & as_text.try_cast("bigint").isNotNull()).alias("integers"),
            F.count_if(as_text.rlike(typing.FLOAT_TEXT)).alias("floats"), F.count_if(stamp.isNotNull()).alias("dates"),
            F.count_if(as_text.rlike(r"\s")).alias("spaced"), F.count(F.lit(1)).alias("rows")))
    some = F.col("some")
    found = (F.when((F.col("integers") == F.col("rows")) & (some > 0), "integer").when(F.col("floats") == some, "float")
             .when(F.col("dates") == some, "date").when(F.col("spaced") > 0, "text").otherwise("keyword"))
    fits = (F.when(F.col("declared") == "integer", F.col("integers") == some).when(F.col("declared") == "float", F.col("floats") == some)
            .when(F.col("declared") == "date", F.col("dates") == some).otherwise(F.col("declared").isNotNull()))
    typed = df.agg(F.array(*counts).alias("c")).select(F.inline("c")).select("field", F.when(fits, F.col("declared")).otherwise(found).alias("type"))
    common = F.explode(F.create_map(*[F.lit(x) for pair in COMMON_MAPPING.items() for x in pair])).alias("field", "type")
    return df.sparkSession.range(1).select(common).unionAll(typed).select(F.lit(name).alias("dataset"), "field", "type")
