"""Writers. Spark's job commit makes each output appear whole or not at all."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.text import line_breaks_out

INDEX_PREFIX = "incidents_"


def _csv(df: DataFrame, header: bool):
    return (df.write.mode("overwrite").option("header", header)
            .option("nullValue", "").option("emptyValue", "").option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def store_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_output(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def csv_export(df: DataFrame, path: str) -> None:
    """CSV with a header and without the surrogate id; missing values are empty."""
    _csv(df.drop("_id"), True).csv(path)


def store_delimited(df: DataFrame, path: str, quoted: bool = True) -> None:
    """Headerless comma text. ``quoted=False`` writes the plain, ambiguous form.

    Line breaks inside texts are written as visible signs, which the readers turn back: a row
    is always one line, so files of any size can be split.
    """
    if quoted:
        texts = {f.name: line_breaks_out(F.col(f"`{f.name}`")) for f in df.schema.fields
                 if isinstance(f.dataType, T.StringType)}
        _csv(df.withColumns(texts), False).csv(path)
        return
    fields = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns)
    df.select(F.concat_ws(",", *fields).alias("value")).write.mode("overwrite").text(path)


def publish(df: DataFrame, path: str, single: bool = False) -> None:
    """A report as CSV. ``single`` writes one file, which takes one task: for results known to be short."""
    _csv(df.coalesce(1) if single else df, False).csv(path)


def index_name(dataset: str, prefix: str = INDEX_PREFIX) -> str:
    return prefix + dataset.removesuffix(".csv").replace("_", "-")


def by_time(documents: DataFrame) -> DataFrame:
    """Lays documents out in ranges of their time, so that range requests skip files.

    The source task breaks ties: documents of one instant, such as those that got
    the load time, still spread over many ranges.
    """
    return (documents.withColumn("_task", F.spark_partition_id())
            .repartitionByRange("`@timestamp`", "_task")
            .sortWithinPartitions("`@timestamp`").drop("_task"))


def doc_index(documents: DataFrame, root: str, dataset: str, prefix: str = INDEX_PREFIX) -> str:
    """Writes the typed documents of one dataset and returns where."""
    path = f"{root}/{index_name(dataset, prefix)}"
    by_time(documents).write.mode("overwrite").parquet(path)
    return path


def doc_index_all(frames: Mapping[str, DataFrame], root: str,
                  prefix: str = INDEX_PREFIX) -> dict[str, str]:
    """Writes every processed dataset; the raw one stays out."""
    return {name: doc_index(frame, root, name, prefix) for name, frame in frames.items()
            if "no_processing_data" not in name}


def result_copy(df: DataFrame, path: str) -> None:
    """Headerless copy of an indexed dataset."""
    _csv(df, False).csv(path)


def result_save(df: DataFrame, path: str) -> None:
    """A query result as JSON; missing values are written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
