"""What the physical plans must and must not contain."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from roadlens.operators import access, dedup, ordered, reports
from roadlens.operators import documents as D
from roadlens.operators import search as S
from roadlens.operators.clean import clean_events
from roadlens.operators.snapshot import roundtrip_verify
from roadlens.session import shared_dir
from roadlens.sinks import files as sinks

AS_OF = dt.datetime(2024, 1, 31)


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan")[0]


def exchanges(text):
    return sum(bool(re.search(r"Exchange (?:hash|range|Single)", line))
               for line in text.splitlines() if "ReusedExchange" not in line)


@pytest.fixture(scope="module")
def narrow(tables):
    raw = tables["raw"]
    docs = D.documents(D.doc_rename(tables["unique"].drop("row_id")), AS_OF)
    return {
        "clean": clean_events(raw),
        "docs": docs,
        "json": D.document_json(docs),
        "key": dedup.with_content_key(raw),
    }


def test_row_operators_do_not_shuffle_and_stay_in_codegen(narrow):
    for name, df in narrow.items():
        text = plan(df)
        assert exchanges(text) == 0, name
        assert "Python" not in text and "Arrow" not in text, name
        assert "*(1)" in text, name


def test_no_python_outside_the_state_function(tables):
    raw, unique = tables["raw"], tables["unique"]
    trace = access.draws(raw.sparkSession, 100, 1)
    frames = [dedup.dedup_minute(raw), dedup.change_only(raw), reports.report_base(unique),
              roundtrip_verify(raw, raw), access.trace_intervals(trace),
              access.sampled_ranks(trace, raw), S.terms(unique, "tipo")]
    for df in frames:
        assert not re.search(r"Python|InPandas|InArrow", plan(df))


def test_validity_filter_and_columns_reach_the_scan(tables):
    text = plan(reports.event_counts(clean_events(tables["raw"])))
    scan = re.search(r"FileScan parquet \[(.*?)\]", text)[1]
    assert {c.split("#")[0] for c in scan.split(",")} == {"tipo", "hora", "lat", "lon"}
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text)[1]
    assert "IsNotNull(tipo)" in pushed and "IsNotNull(lon)" in pushed


def test_dedup_cuts_groups_before_its_one_shuffle(tables):
    text = plan(dedup.dedup_minute(tables["filtered"]), run=True)
    assert exchanges(text) == 1
    assert "Partial" in text.split("Exchange hash")[1]


def test_change_only_shuffles_the_events_once(tables):
    text = plan(dedup.change_only(tables["raw"]), run=True)
    assert text.count("FileScan") == 1 and exchanges(text) == 1
    # In pieces: the events once, and a row for each key and piece, summed up before the shuffle.
    text = plan(dedup.change_only(tables["raw"], chunk_rows=300), run=True)
    assert text.count("Window [") == 2 and "partial_max_by" in text


def test_histogram_counts_the_documents_once(tables):
    docs = D.documents(D.doc_rename(tables["unique"].drop("row_id")), AS_OF)
    text = plan(S.date_histogram(docs, "day"), run=True)
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


@pytest.mark.parametrize("request_", [S.terms_request("t", "tipo"), S.histogram_request("h")])
def test_a_request_reads_the_documents_once(tables, request_):
    docs = D.documents(D.doc_rename(tables["unique"].drop("row_id")), AS_OF)
    text = plan(S.search(docs, request_, AS_OF), run=True)
    assert text.count("FileScan") == 1


def test_recency_reaches_the_scan(spark, tables, tmp_path):
    docs = D.documents(D.doc_rename(tables["unique"].drop("row_id")), AS_OF)
    path = sinks.doc_index(docs, str(tmp_path), "data_unique")
    text = plan(S.recent_count(spark.read.parquet(path), AS_OF))
    assert "GreaterThanOrEqual(`@timestamp`" in text
    assert re.search(r"FileScan parquet \[@timestamp#\d+\]", text)


def test_counts_and_keys_aggregate_before_the_shuffle(tables):
    for df in (reports.incidents_by_city(tables["unique"]),
               dedup.upsert_latest(tables["raw"], dedup.CHANGE_KEY, "row_id"),
               access.repeat_access(tables["raw"], "ciudad"),
               roundtrip_verify(tables["raw"], tables["raw"])):
        assert "partial_" in plan(df, run=True)


def test_top_terms_do_not_sort_everything(tables):
    assert "TakeOrderedAndProject" in plan(S.terms(tables["unique"], "tipo"))


def test_global_order_uses_ranges_not_one_partition(spark, tables):
    text = plan(ordered.with_rank(tables["raw"], ["row_id"]))
    for line in text.split("Exchange SinglePartition")[1:]:
        # Only the per-partition counts go through one task.
        assert "HashAggregate" in line.split("\n")[1] or "HashAggregate" in line.split("\n")[2]
    total = plan(ordered.running_total(access.draws(spark, 1000, 1).select(
        "seq", F.col("seq").alias("v")), "seq", "v", "t", chunk_rows=100))
    for line in total.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in "".join(line.split("\n")[1:3])


def test_checkpoints_go_to_the_named_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_hot_rank_is_split_by_the_join(spark):
    """A third of the accesses go to one row; the join spreads them over tasks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        trace = spark.range(0, 200_000, 1, 8).select(
            F.col("id").alias("seq"),
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("rank"))
        ranked = spark.range(1000).select(F.col("id").alias("rank"), F.col("id").alias("row_id"))
        found = access.rank_lookup(trace, ranked)
        text = plan(found, run=True)
        assert "skew=true" in text
        assert found.count() == 200_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_counts_come_from_footers(spark, tables, tmp_path):
    paths = {}
    for name, df in (("b", tables["raw"]), ("a", tables["raw"].filter("false"))):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counts = S.footer_counts(spark, paths)
    text = plan(counts)
    assert text.count("PushedAggregation: [COUNT(*)]") == 2 and "FileScan" not in text
    assert [tuple(r) for r in counts.collect()] == [("a", 0), ("b", tables["raw"].count())]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
