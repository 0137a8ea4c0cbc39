"""End-to-end jobs: batch reports, indexing with static requests, keyed snapshot."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators import search as S
from roadlens.operators.clean import clean_events
from roadlens.operators.dedup import dedup_minute
from roadlens.operators.documents import doc_rename, documents
from roadlens.operators.reports import report_base, reports_from_base
from roadlens.operators.snapshot import completeness, load_snapshot, load_stats, roundtrip_verify
from roadlens.schemas import EVENT_COLUMNS
from roadlens.sinks import files as sinks
from roadlens.sources import files as sources

log = logging.getLogger(__name__)


def with_row_id(events: DataFrame) -> DataFrame:
    """A tie-breaker from the row's content for stores that carry no arrival number."""
    if "row_id" in events.columns:
        return events
    return events.withColumn("row_id", F.xxhash64(*EVENT_COLUMNS))


def batch_reports(events: DataFrame, out: str, single: bool = False) -> dict[str, DataFrame]:
    """Clean, deduplicate and report; every result is written below ``out``.

    The unique events are written once and read back, so the reports never repeat
    the cleaning; the small base count is shared by the seven of them. ``single`` writes
    each report as one file.
    """
    spark = events.sparkSession
    rows = with_row_id(events)
    sinks.replace_output(clean_events(rows), f"{out}/filtered_events")
    filtered = spark.read.parquet(f"{out}/filtered_events")
    sinks.replace_output(dedup_minute(filtered), f"{out}/data_unique")
    unique = spark.read.parquet(f"{out}/data_unique")
    base = report_base(unique).persist()
    try:
        for name, report in reports_from_base(base).items():
            sinks.publish(report, f"{out}/{name}.csv", single)
    finally:
        base.unpersist()
    return {"filtered_events": filtered, "data_unique": unique}


def index_events(events: Mapping[str, DataFrame], root: str,
                 as_of: dt.datetime) -> dict[str, DataFrame]:
    """Types and indexes event datasets; returns the indexed frames by name."""
    typed = {name: documents(doc_rename(frame.drop("row_id")), as_of)
             for name, frame in events.items()}
    paths = sinks.doc_index_all(typed, root)
    spark = next(iter(events.values())).sparkSession
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def index_paths(spark: SparkSession, root: str, prefix: str = sinks.INDEX_PREFIX) -> dict[str, str]:
    """Where each dataset of a written index lies, by dataset; what is there is listed, not read."""
    return {r["dataset"].replace("-", "_"): f"{root}/{prefix}{r['dataset']}" for r in S.indexed_listing(spark, root, prefix).collect()}


def freshness(spark: SparkSession, root: str, expected: list[str]) -> DataFrame:
    """One row: whether the index below ``root`` must be loaded again, since an expected dataset is missing or empty."""
    counts = S.footer_counts(spark, {n: p for n, p in index_paths(spark, root).items() if n in expected})
    return completeness(counts, expected).agg((~F.bool_and("present")).alias("reload"), F.count_if("present").alias("present"))


def needs_reload(indexed: Mapping[str, DataFrame], expected: list[str]) -> bool:
    """True unless every expected dataset is indexed and holds documents."""
    present = {n: f for n, f in indexed.items() if n in expected}
    if not present:
        return True
    return completeness(S.index_counts(present), expected).filter("not present").count() > 0


def static_report(docs: DataFrame, out: str, as_of: dt.datetime,
                  requests: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Runs, saves, reloads and compares each request; returns one row per saved result.

    The saved summary is one row: requests made and the names of the saved results.

    A request that cannot be answered is logged and left out; the others still run. Any other failure ends the report.
    """
    spark = docs.sparkSession
    requests = S.STATIC_REQUESTS if requests is None else requests
    checks = []
    for name, request in requests.items():
        try:
            path = f"{out}/{name}.json"
            # A few rows, which are saved and compared without being computed again.
            answer = S.search(docs, request, as_of).persist()
            try:
                sinks.result_save(answer, path)
                loaded = sources.result_read(spark, path, answer.schema)
                checks.append((name, path, roundtrip_verify(answer, loaded).first().matches))
            finally:
                answer.unpersist()
        except (ValueError, AnalysisException):
            log.exception("request %s cannot be answered", name)
    summary = spark.createDataFrame([(as_of, len(requests), [name for name, _, _ in checks])],
                                    "`timestamp` timestamp_ntz, total_consultas bigint, "
                                    "archivos_generados array<string>")
    sinks.result_save(summary, f"{out}/resumen_consultas.json")
    return spark.createDataFrame(checks, "request string, path string, matches boolean")


def saved_answers(spark: SparkSession, saved: DataFrame) -> DataFrame:
    """The results of a static report as ``(request, aggregation, key, doc_count)``."""
    schema = "aggregation string, key string, doc_count bigint"
    parts = {row.request: sources.result_read(spark, row.path, schema)
             for row in saved.collect()}
    if not parts:
        return spark.createDataFrame([], f"request string, {schema}")
    return S.family_union(parts).withColumnRenamed("dataset", "request")


def publish_snapshot(frames: Mapping[str, DataFrame], out: str) -> DataFrame:
    """Writes the keyed snapshot of all known datasets and returns it."""
    load_snapshot(frames).write.mode("overwrite").partitionBy("namespace").parquet(out)
    return next(iter(frames.values())).sparkSession.read.parquet(out)


def publish_stats(frames: Mapping[str, DataFrame], out: str) -> None:
    """Saves the totals of a snapshot load."""
    sinks.result_save(load_stats(frames), out)
