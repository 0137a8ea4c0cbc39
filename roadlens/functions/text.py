"""Text expressions: regex semantics, stamps, keys. All stay inside codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of stamps.
MINUTE_PATTERN = r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}).*"
HOUR_PATTERN = r".*T(\d{2}):\d{2}:\d{2}"
DATE_PREFIX_PATTERN = r"\d{4}-\d{2}-\d{2}.*"
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"


def full_match(column: Column, pattern: str) -> Column:
    """True when the whole text matches; ``rlike`` alone only searches."""
    return column.rlike(rf"\A(?:{pattern})\z")


def regex_find(column: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match anywhere in the text, null when there is none."""
    return F.nullif(F.regexp_extract(column, pattern, group), F.lit(""))


def standardise_type(column: Column) -> Column:
    return F.when(full_match(column, "HAZARD.*"), F.lit("HAZARD")).otherwise(column)


def minute_bucket(column: Column) -> Column:
    """The stamp cut to its minute, as text."""
    return regex_find(column, MINUTE_PATTERN)


def event_date(column: Column) -> Column:
    return F.substring(column, 1, 10)


def event_hour(column: Column) -> Column:
    """Two-digit hour of the day, as text."""
    return regex_find(column, HOUR_PATTERN)


def moment(at: dt.datetime) -> Column:
    """A point in time as a literal that no time zone shifts; an aware one counts in UTC."""
    if at.tzinfo:
        at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def iso_text(stamp: Column) -> Column:
    """ISO text of a timestamp; the fraction appears only when it is not zero."""
    exact = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.replace(exact, F.lit(".000000"), F.lit(""))


def epoch_iso(millis: Column) -> Column:
    """Milliseconds since the epoch (missing counts as 0) as ISO text in the session zone."""
    return iso_text(F.timestamp_millis(F.coalesce(millis, F.lit(0).cast("bigint"))))


def float_text(value: Column) -> Column:
    """Shortest text of a number: positional digits between 1e-4 and 1e16, else ``1.5e-05``.

    A 32-bit number keeps its own digits: it becomes a double by way of its text.
    """
    number = value.cast("string").cast("double")
    size = F.abs(number)
    plain = number.cast("string")
    digits = F.regexp_replace(number.try_cast("decimal(38,20)").cast("string"),
                              r"(\.\d+?)0+$", "$1")
    positional = ((size >= 1e-4) & (size < 1e-3)) | ((size >= 1e7) & (size < 1e16))
    power = F.regexp_replace(F.regexp_replace(plain, r"\.0E", "E"), r"E-(\d)$", "E-0$1")
    power = F.regexp_replace(F.regexp_replace(power, r"E(\d)", "E+$1"), "E", "e")
    extreme = ((size > 0) & (size < 1e-4)) | ((size >= 1e16) & (size < float("inf")))
    return F.when(positional, digits).when(extreme, power).otherwise(plain)


def natural_key(type_: Column, lat: Column, lon: Column, subtype: Column) -> Column:
    """``type_lat_lon_subtype``; a missing part prints as ``None``."""
    parts = (type_, float_text(lat), float_text(lon), subtype)
    return F.concat_ws("_", *(F.coalesce(p, F.lit("None")) for p in parts))


def content_key(columns: Sequence[Column]) -> Column:
    """Stable hash of the data columns; the same content gives the same key in every run.

    Each part stands with its length and a missing one as ``~``, so no two rows share an encoding.
    """
    texts = (c.cast("string") for c in columns)
    parts = (F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("~")) for t in texts)
    return F.sha2(F.concat_ws("|", *parts), 256)


# Signs that stand for line feed and carriage return in delimited files, and the sign before a literal one.
LINE_FEED, CARRIAGE_RETURN, LITERAL = "\u240A", "\u240D", "\u241B"


def line_breaks_out(column: Column) -> Column:
    """Text without line breaks, from which ``line_breaks_in`` makes the text again."""
    marked = F.regexp_replace(column, f"([{LINE_FEED}{CARRIAGE_RETURN}{LITERAL}])", f"{LITERAL}$1")
    return F.replace(F.replace(marked, F.lit("\n"), F.lit(LINE_FEED)), F.lit("\r"), F.lit(CARRIAGE_RETURN))


def line_breaks_in(column: Column) -> Column:
    """Turns the signs of line breaks back; text without any is left as it is."""
    free = f"(?<!{LITERAL})((?:{LITERAL}{LITERAL})*)"
    text = column
    for sign, mark in ((LINE_FEED, "\n"), (CARRIAGE_RETURN, "\r")):
        text = F.regexp_replace(F.regexp_replace(text, f"{free}{sign}", f"$1{mark}"), f"{free}{sign}", f"$1{mark}")
    text = F.regexp_replace(text, f"{LITERAL}([{LINE_FEED}{CARRIAGE_RETURN}{LITERAL}])", "$1")
    return F.when(column.rlike(f"[{LINE_FEED}{CARRIAGE_RETURN}{LITERAL}]"), text).otherwise(column)
