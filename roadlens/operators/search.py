"""The four request shapes: top terms, date histogram, recency range, count only."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.text import iso_text, moment

# Calendar units and the step between two of their buckets.
UNITS = {
    "minute": "INTERVAL 1 MINUTE",
    "hour": "INTERVAL 1 HOUR",
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAY",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTH",
    "year": "INTERVAL 1 YEAR",
}

TIME_FIELD = "@timestamp"


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def _count_by(df: DataFrame, key: Column) -> DataFrame:
    return (df.select(key.alias("key")).groupBy("key")
            .agg(F.count(F.lit(1)).alias("doc_count")))


def _top(counts: DataFrame, size: int) -> DataFrame:
    """The largest buckets. The null key is dropped after the cut, so that the counts
    below stay the ones the total is summed from."""
    order = (F.desc("doc_count"), F.asc("key"))
    return (counts.orderBy(*order).limit(size + 1)
            .filter(F.col("key").isNotNull()).orderBy(*order).limit(size))


def terms(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """The ``size`` most frequent values; ties in key order, missing values left out."""
    return _top(_count_by(df.filter(_named(field).isNotNull()), _named(field)), size)


def bucket_preview(buckets: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` buckets of a terms result."""
    return buckets.orderBy(F.desc("doc_count"), F.asc("key")).limit(n)


def _bucket(stamp: Column, unit: str) -> Column:
    return F.date_trunc(unit, stamp).cast("timestamp_ntz")


def _fill(counts: DataFrame, unit: str) -> DataFrame:
    """Adds the empty buckets between the first and the last."""
    step = F.expr(UNITS[unit])
    # The total keeps the bounds on the counted buckets, so the rows are counted once.
    bounds = (counts.agg(F.min("key").alias("lo"), F.max("key").alias("hi"),
                         F.sum("doc_count").alias("total")).filter(F.col("total") > 0))
    if unit in ("minute", "hour"):
        # Days first, so that no row holds more than one day of buckets.
        day_end = F.col("day") + F.expr("INTERVAL 1 DAY") - step
        # The days are dealt out, so that one stray stamp far off makes many small tasks.
        spine = (bounds
                 .select("lo", "hi", F.explode(F.sequence(
                     _bucket(F.col("lo"), "day"), "hi", F.expr(UNITS["day"]))).alias("day"))
                 .repartition("day")
                 .select("lo", "hi", F.explode(F.sequence("day", day_end, step)).alias("bucket"))
                 .filter(F.col("bucket").between(F.col("lo"), F.col("hi"))).select("bucket"))
    else:
        spine = bounds.select(F.explode(F.sequence("lo", "hi", step)).alias("bucket"))
    # Null-safe, so that no filter is inferred on the counts, which would count them again.
    return (spine.join(counts, F.col("bucket").eqNullSafe(F.col("key")), "left")
            .select(F.col("bucket").alias("key"),
                    F.coalesce("doc_count", F.lit(0).cast("bigint")).alias("doc_count")))


def date_histogram(df: DataFrame, unit: str = "day", field: str = TIME_FIELD) -> DataFrame:
    """Counts per calendar bucket, with the empty buckets between the first and the last."""
    return _fill(_count_by(df.filter(_named(field).isNotNull()),
                           _bucket(_named(field), unit)), unit)


def recent(df: DataFrame, as_of: dt.datetime, hours: int = 24, field: str = TIME_FIELD) -> DataFrame:
    """Documents from ``hours`` before ``as_of`` on."""
    return df.filter(_named(field) >= moment(as_of - dt.timedelta(hours=hours)))


def total_hits(df: DataFrame) -> DataFrame:
    """Exact number of documents, as one row."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def recent_count(df: DataFrame, as_of: dt.datetime, hours: int = 24,
                 field: str = TIME_FIELD) -> DataFrame:
    return total_hits(recent(df, as_of, hours, field))


def family_union(frames: Mapping[str, DataFrame], fields: Sequence[str] | None = None) -> DataFrame:
    """All datasets of a family as one frame with a ``dataset`` column.

    An absent field is null. A field whose type differs between datasets becomes
    text. With ``fields`` only these are read.
    """
    types: dict[str, set[str]] = {}
    for frame in frames.values():
        for f in frame.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    wanted = [n for n in types if fields is None or n in fields]
    parts = []
    for name, frame in frames.items():
        columns = [_named(n).cast("string").alias(n) if len(types[n]) > 1 else _named(n)
                   for n in wanted if n in frame.columns]
        parts.append(frame.select(F.lit(name).alias("dataset"), *columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def index_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Documents per dataset, sorted by name; an empty dataset shows 0."""
    parts = [f.agg(F.count(F.lit(1)).alias("doc_count"))
             .select(F.lit(name).alias("dataset"), "doc_count") for name, f in frames.items()]
    return reduce(DataFrame.unionAll, parts).orderBy("dataset")


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Documents per written dataset, sorted by name, from the footers of its Parquet files: no row is read.

    The count is pushed into the scan, which Spark's newer Parquet reader does; the setting that picks the reader is
    put back. A dataset written without rows shows 0.
    """
    listed, pushed = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
    spark.conf.set(pushed, "true")
    before = spark.conf.get(listed)
    spark.conf.set(listed, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        frames = {name: spark.read.parquet(path) for name, path in paths.items()}
    finally:
        spark.conf.set(listed, before)
    # A pushed count over files without row groups is missing, though a count is never taken to be; greatest() skips that.
    return index_counts(frames).withColumn("doc_count", F.greatest("doc_count", F.lit(0).cast("bigint")))


def indexed_listing(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Names of the datasets of a written index, ascending, empty ones too: one listing of its folders, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    folder = F.element_at(F.split("path", "/"), -2)
    return (files.select(folder.alias("folder")).filter(F.col("folder").startswith(prefix)).distinct()
            .select(F.substring("folder", len(prefix) + 1, 1000).alias("dataset")).orderBy("dataset"))


def sorted_listing(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Names of all datasets, ascending, empty ones too; no rows are read."""
    return spark.createDataFrame([(name,) for name in sorted(frames)], "dataset string").orderBy("dataset")


def _matching(df: DataFrame, query: Mapping | None, as_of: dt.datetime) -> DataFrame:
    if query is None:
        return df
    match query:
        case {"range": dict(ranges)} if len(query) == 1 and len(ranges) == 1:
            (field, bound), = ranges.items()
            if isinstance(bound, Mapping) and set(bound) == {"gte"}:
                hours = re.fullmatch(r"now-(\d+)h", str(bound["gte"]))
                if hours:
                    return recent(df, as_of, int(hours[1]), field)
    raise ValueError(f"unknown query {query!r}")


def _aggregate(df: DataFrame, spec: Mapping) -> tuple[DataFrame, DataFrame]:
    """The counts by key, missing keys included, and the buckets made of them."""
    match spec:
        case {"terms": {"field": str(field), **rest}} if set(rest) <= {"size"}:
            counts = _count_by(df, _named(field))
            # Ordered as what they are, then shown as text.
            top = _top(counts, rest.get("size", 10))
            return counts, top.withColumn("key", F.col("key").cast("string"))
        case {"date_histogram": {"field": str(field), "calendar_interval": str(unit), **rest}} \
                if not rest and unit in UNITS:
            counts = _count_by(df, _bucket(_named(field), unit))
            buckets = _fill(counts, unit)
            return counts, buckets.withColumn("key", iso_text(F.col("key")))
    raise ValueError(f"unknown aggregation {spec!r}")


def search(df: DataFrame, request: Mapping, as_of: dt.datetime) -> DataFrame:
    """Answer of one request as ``(aggregation, key, doc_count)`` rows.

    The row with aggregation ``hits`` holds the exact number of matching documents,
    summed from the counts of an aggregation when there is one: the documents are
    read once. A request of another shape raises ``ValueError``.
    """
    unknown = set(request) - {"size", "aggs", "query"}
    if unknown or request.get("size") != 0:
        raise ValueError(f"unknown request {request!r}")
    rows = _matching(df, request.get("query"), as_of)
    answers = {name: _aggregate(rows, spec) for name, spec in (request.get("aggs") or {}).items()}
    if answers:
        counts = next(iter(answers.values()))[0]
        total = F.coalesce(F.sum("doc_count"), F.lit(0).cast("bigint"))
        hits = counts.agg(total.alias("doc_count"))
    else:
        hits = total_hits(rows).withColumnRenamed("total", "doc_count")
    parts = [hits.select(F.lit("hits").alias("aggregation"),
                         F.lit(None).cast("string").alias("key"), "doc_count")]
    parts += [buckets.select(F.lit(name).alias("aggregation"), "key", "doc_count")
              for name, (_, buckets) in answers.items()]
    return reduce(DataFrame.unionAll, parts)


def terms_request(name: str, field: str, size: int = 10) -> dict:
    return {"size": 0, "aggs": {name: {"terms": {"field": field, "size": size}}}}


def histogram_request(name: str, unit: str = "day", field: str = TIME_FIELD) -> dict:
    return {"size": 0, "aggs": {name: {"date_histogram": {"field": field,
                                                          "calendar_interval": unit}}}}


def recent_request(hours: int = 24, field: str = TIME_FIELD) -> dict:
    return {"size": 0, "query": {"range": {field: {"gte": f"now-{hours}h"}}}}


# The three requests of the static report and the names of their results.
STATIC_REQUESTS = {
    "eventos_por_tipo": terms_request("tipos", "tipo"),
    "eventos_por_comuna": terms_request("comunas", "comuna"),
    "eventos_recientes_24h": recent_request(24),
}
