"""Typing rules of index documents: a value that cannot be coerced becomes null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.text import float_text

# Field names with a numeric rule and words that are not dates.
FLOAT_FIELDS = ("latitud", "longitud", "lat", "lng", "latitude", "longitude")
INTEGER_FIELDS = ("cantidad", "count", "hora", "hour")
DATE_WORDS = ("fecha", "date")
NOT_DATES = ("hora", "hour", "fecha", "date", "time", "n/a", "null", "none", "")

# The JVM also reads `5d` and hexadecimal text as doubles; documents must not.
FLOAT_TEXT = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity)\s*$"
# A time of day with an offset from UTC.
OFFSET_TEXT = r"\d{1,2}:\d{2}.*(?:[zZ]|[+-]\d{1,2}(?::?\d{2})?)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"


def rule_of(field: str) -> str:
    """Which of the four rules a field name falls under."""
    if field in FLOAT_FIELDS:
        return "float"
    if field in INTEGER_FIELDS:
        return "integer"
    if any(word in field.lower() for word in DATE_WORDS):
        return "date"
    return "string"


def to_float(column: Column, dtype: T.DataType) -> Column:
    number = column.try_cast("double")
    if isinstance(dtype, T.FloatType):
        number = column.cast("string").cast("double")  # its own digits, not those of a wider number
    if isinstance(dtype, T.StringType):
        number = F.when(column.rlike(FLOAT_TEXT), number)
    return F.when(F.isnan(number), None).otherwise(number)


def to_integer(column: Column, dtype: T.DataType) -> Column:
    """Text must be a plain integer; a number is cut at the decimal point."""
    if isinstance(dtype, T.StringType):
        return F.when(column.rlike(INTEGER_TEXT), column.try_cast("bigint"))
    return column.try_cast("double").try_cast("bigint")


def to_date(column: Column, dtype: T.DataType, formats: Sequence[str] = ()) -> Column:
    """Text that is a date or time stamp; other types are not accepted as dates.

    Text with an offset counts in UTC. ``formats`` are further forms to try on other text, in order.
    """
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column.cast("timestamp_ntz")
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("timestamp_ntz")
    word = F.lower(F.trim(column))
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.try_cast("timestamp").cast("timestamp_ntz"))
    stamp = F.when(column.rlike(OFFSET_TEXT), zoned).otherwise(column.try_cast("timestamp_ntz"))
    others = (F.try_to_timestamp(column, F.lit(form)).cast("timestamp_ntz") for form in formats)
    return F.when(~word.isin(*NOT_DATES), F.coalesce(stamp, *others))


def to_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), float_text(column))
    if isinstance(dtype, T.BooleanType):
        return F.initcap(column.cast("string"))
    return column.cast("string")


def geo_point(lat: Column, lon: Column) -> Column:
    """``lat,lon`` when both lie in their geographic range."""
    inside = lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(inside, F.concat_ws(",", float_text(lat), float_text(lon)))


def coerce(column: Column, field: str, dtype: T.DataType) -> Column:
    rule = {"float": to_float, "integer": to_integer, "date": to_date, "string": to_text}
    return rule[rule_of(field)](column, dtype)
