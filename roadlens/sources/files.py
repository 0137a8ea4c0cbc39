"""Readers of event stores, delimited text, named and unknown datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.text import line_breaks_in
from roadlens.functions.typing import FLOAT_TEXT, INTEGER_TEXT
from roadlens.schemas import GENERIC_WIDTH, POSITIONAL, index_schema, snapshot_dataset

# Texts that stand for a missing value in named and unknown datasets.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def store_scan_all(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All events; with a ``schema`` a store without files reads as empty."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def store_scan(spark: SparkSession, path: str, limit: int | None = 10,
               order: Sequence[str] = ()) -> DataFrame:
    """The first ``limit`` events, in ``order`` when given; no limit reads all."""
    events = store_scan_all(spark, path)
    if not limit:
        return events
    return (events.orderBy(*order) if order else events).limit(limit)


def _texts(rows: DataFrame, of) -> DataFrame:
    return rows.withColumns({f.name: of(F.col(f"`{f.name}`")) for f in rows.schema.fields
                             if isinstance(f.dataType, T.StringType)})


def load_positional(spark: SparkSession, path: str, quoted: bool = True,
                    schema: str = POSITIONAL, multi_line: bool = False) -> DataFrame:
    """Comma text by position: short rows and bad numbers become null.

    A header is read as a row; the validity filter drops it. With ``quoted=False``
    quotes are ordinary characters, so a comma inside them shifts the columns. ``multi_line``
    reads foreign files with line breaks inside quotes, a whole file per task.
    """
    rows = (spark.read.schema(schema).option("multiLine", multi_line)
            .option("quote", '"' if quoted else "").option("escape", '"' if quoted else "\\")
            .option("mode", "PERMISSIVE").csv(path))
    return _texts(rows, line_breaks_in) if quoted and not multi_line else rows


def _present(column: Column) -> Column:
    return F.when(~column.isin(*MISSING_TEXTS), column)


def _read_text_columns(spark: SparkSession, path: str, ddl: str, header: bool,
                       multi_line: bool = False) -> DataFrame:
    rows = (spark.read.schema(ddl).option("header", header).option("enforceSchema", True)
            .option("multiLine", multi_line).option("escape", '"').csv(path))
    return rows if multi_line else _texts(rows, line_breaks_in)


def _width(spark: SparkSession, path: str, multi_line: bool = False) -> int:
    """The most columns a line has: its commas outside quotes, and one. With ``multi_line`` a quoted break is no end of a line."""
    bare = F.regexp_replace("value", '"(?:[^"]|"")*"', "")
    lines = spark.read.text(path, wholetext=multi_line).select(F.explode(F.split(bare, "\n")) if multi_line else bare).toDF("line")
    found = lines.agg(F.max(F.regexp_count("line", F.lit(","))).alias("n")).first().n
    return (found or 0) + 1


def load_named(spark: SparkSession, path: str, name: str, side: str = "index",
               header: bool = False, multi_line: bool = False) -> DataFrame:
    """A headerless CSV whose columns are called by its dataset name.

    ``side`` picks the names of the index or of the snapshot. A dataset the index
    has no names for is read as an unknown one.
    """
    if side == "snapshot":
        dataset = snapshot_dataset(name)
        if dataset is None:
            raise ValueError(f"unknown dataset {name!r}")
        ddl = dataset.ddl
    else:
        ddl = index_schema(name)
        if ddl is None:
            return load_generic(spark, path, header=header, multi_line=multi_line)
    rows = _read_text_columns(spark, path, ddl, header, multi_line)
    present = {}
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            present[field.name] = _present(column)
        elif isinstance(field.dataType, T.DoubleType):
            present[field.name] = F.when(~F.isnan(column), column)
    return rows.withColumns(present)


def load_generic(spark: SparkSession, path: str, width: int = GENERIC_WIDTH, header: bool = False,
                 multi_line: bool = False) -> DataFrame:
    """An unknown CSV as ``campo_0 …``; types come from one pass over all rows. With ``header`` each file's first line is left out.

    There are as many columns as the widest line has, and at least ``width``. Whole numbers without gaps are bigint, other numbers and empty columns double,
    the rest text. The pass brings one row of counts to the driver.
    """
    names = [f"campo_{i}" for i in range(max(width, _width(spark, path, multi_line)))]
    text = _read_text_columns(spark, path, ", ".join(f"{n} string" for n in names), header, multi_line)
    text = text.select([_present(F.col(n)).alias(n) for n in names])
    counts = text.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(n).alias(f"{n}_some") for n in names),
        *(F.count_if(F.col(n).rlike(INTEGER_TEXT) & F.col(n).try_cast("bigint").isNotNull())
          .alias(f"{n}_int") for n in names),
        *(F.count_if(F.col(n).rlike(FLOAT_TEXT)).alias(f"{n}_float") for n in names),
    ).first()

    def typed(n: str) -> Column:
        some = counts[f"{n}_some"]
        if counts[f"{n}_int"] == counts["rows"] > 0:
            return F.trim(n).cast("bigint").alias(n)
        if counts[f"{n}_float"] == some:
            return F.trim(n).cast("double").alias(n)
        return F.col(n)

    return text.select([typed(n) for n in names])


def result_read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A saved query result."""
    return spark.read.schema(schema).json(path)


def dataset_inventory(spark: SparkSession, path: str) -> DataFrame:
    """CSV files below a folder that hold data, with their size; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", True).load(path)
            .select("path", F.col("length").alias("bytes")))
