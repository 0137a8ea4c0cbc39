"""Requests, families and the static report."""

import datetime as dt

import pytest

from core_helpers import rows
from roadlens.operators import documents as D
from roadlens.operators import search as S
from roadlens.operators import snapshot
from roadlens.plans import pipeline

AS_OF = dt.datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def docs(tables):
    return D.documents(D.doc_rename(tables["unique"].drop("row_id")), AS_OF).cache()


def test_terms_request(docs):
    got = S.search(docs, S.terms_request("tipos", "tipo", 3), AS_OF).collect()
    assert got[0].aggregation == "hits" and got[0].doc_count == docs.count()
    assert [(r.key, r.doc_count) for r in got[1:]] == [
        tuple(r) for r in S.terms(docs, "tipo", 3).collect()]


def test_range_and_aggregation_together(docs):
    request = {**S.recent_request(48), **{"aggs": S.terms_request("t", "comuna")["aggs"]}}
    got = S.search(docs, request, AS_OF).collect()
    assert got[0].doc_count == S.recent_count(docs, AS_OF, 48).first()[0] > 0
    assert sum(r.doc_count for r in got[1:]) <= got[0].doc_count


@pytest.mark.parametrize("request_", [
    {"size": 10},
    {"size": 0, "sort": []},
    {"size": 0, "aggs": {"a": {"avg": {"field": "x"}}}},
    {"size": 0, "aggs": {"a": {"terms": {"field": "x", "order": {}}}}},
    {"size": 0, "aggs": {"a": {"date_histogram": {"field": "x", "calendar_interval": "eon"}}}},
    {"size": 0, "query": {"match": {"tipo": "JAM"}}},
    {"size": 0, "query": {"range": {"@timestamp": {"gte": "now-1d"}}}},
    {"size": 0, "query": {"range": {"@timestamp": {"lte": "now-1h"}}}},
])
def test_other_shapes_raise(docs, request_):
    with pytest.raises(ValueError):
        S.search(docs, request_, AS_OF)


def test_histogram_counts_all_documents(docs):
    for unit in S.UNITS:
        total = S.date_histogram(docs, unit).groupBy().sum("doc_count").first()[0]
        assert total == docs.count(), unit


def test_family_union_fills_and_reconciles(spark):
    frames = {"a": spark.sql("SELECT 1 AS x, 'k' AS tipo"),
              "b": spark.sql("SELECT 'one' AS x, 2 AS y")}
    got = S.family_union(frames)
    assert got.columns == ["dataset", "x", "tipo", "y"]
    assert rows(got) == sorted([("a", "1", "k", None), ("b", "one", None, 2)], key=repr)
    assert S.family_union(frames, ["tipo"]).columns == ["dataset", "tipo"]


def test_family_terms_ignore_datasets_without_the_field(spark, tables, docs):
    counts = spark.sql("SELECT 'JAM' AS tipo_evento, 5 AS cantidad")
    family = S.family_union({"data_unique": docs, "event_counts": counts}, ["tipo"])
    assert rows(S.terms(family, "tipo")) == rows(S.terms(docs, "tipo"))


def test_counts_listing_and_completeness(spark, docs):
    empty = docs.filter("false")
    frames = {"b": docs, "a": empty}
    assert [tuple(r) for r in S.index_counts(frames).collect()] == [("a", 0), ("b", docs.count())]
    assert [r.dataset for r in S.sorted_listing(docs.sparkSession, frames).collect()] == ["a", "b"]
    check = snapshot.completeness(S.index_counts(frames), ["a", "b", "c"])
    assert {r.dataset: r.present for r in check.collect()} == {"a": False, "b": True, "c": False}
    assert rows(snapshot.is_complete(S.index_counts(frames), ["b"])) == [(True,)]
    assert rows(snapshot.is_complete(S.index_counts(frames), ["a", "b"])) == [(False,)]
    assert pipeline.needs_reload(frames, ["b"]) is False
    assert pipeline.needs_reload(frames, ["b", "c"]) is True
    assert pipeline.needs_reload({}, ["b"]) is True


def test_freshness_and_listing_of_a_written_index(spark, tables, tmp_path):
    frames = {"data_unique": tables["unique"], "filtered_events": tables["filtered"].filter("false")}
    pipeline.index_events(frames, str(tmp_path), AS_OF)
    assert [r.dataset for r in S.indexed_listing(spark, str(tmp_path), "incidents_").collect()] == ["data-unique", "filtered-events"]
    for expected, reload in ((["data_unique"], False), (["data_unique", "filtered_events"], True), (["data_unique", "hours"], True)):
        assert pipeline.freshness(spark, str(tmp_path), expected).first().reload is reload


def test_a_failure_that_is_not_the_request_s_ends_the_report(spark, docs, tmp_path, monkeypatch):
    def lost(*args):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(pipeline.sinks, "result_save", lost)
    with pytest.raises(RuntimeError):
        pipeline.static_report(docs, str(tmp_path), AS_OF)


def test_static_report_survives_a_failing_request(spark, docs, tmp_path):
    requests = {"bad": {"size": 0, "aggs": {"a": {"avg": {}}}}, **S.STATIC_REQUESTS}
    saved = pipeline.static_report(docs, str(tmp_path), AS_OF, requests)
    assert rows(saved.select("request", "matches")) == sorted(
        [(name, True) for name in S.STATIC_REQUESTS], key=repr)
    (summary,) = spark.read.json(f"{tmp_path}/resumen_consultas.json").collect()
    assert summary.total_consultas == 4
    assert summary.archivos_generados == list(S.STATIC_REQUESTS)


def test_index_leaves_the_raw_dataset_out(tables, tmp_path):
    frames = {"no_processing_data": tables["raw"], "data_unique": tables["unique"]}
    indexed = pipeline.index_events(frames, str(tmp_path), AS_OF)
    assert list(indexed) == ["data_unique"]
    assert (tmp_path / "incidents_data-unique").exists()
    assert indexed["data_unique"].count() == tables["unique"].count()


def test_missing_values_count_as_hits_only(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', timestamp_ntz'2025-01-01 05:00:00'), (NULL, NULL), "
                   "(NULL, NULL), (NULL, NULL) AS t(tipo, `@timestamp`)")
    got = S.search(df, S.terms_request("t", "tipo", 1), AS_OF).collect()
    assert [tuple(r) for r in got] == [("hits", None, 4), ("t", "a", 1)]
    got = S.search(df, S.histogram_request("h", "year"), AS_OF).collect()
    assert [tuple(r) for r in got] == [("hits", None, 4), ("h", "2025-01-01T00:00:00", 1)]
    got = S.search(df.filter("tipo IS NULL"), S.histogram_request("h"), AS_OF).collect()
    assert [tuple(r) for r in got] == [("hits", None, 3)]
    got = S.search(df.filter("false"), S.terms_request("t", "tipo"), AS_OF).collect()
    assert [tuple(r) for r in got] == [("hits", None, 0)]


def test_search_orders_numbers_as_numbers(spark):
    df = spark.createDataFrame([(k,) for k in (100, 9, 10)], "n int")
    got = S.search(df, S.terms_request("n", "n", 2), dt.datetime(2024, 1, 1)).filter("aggregation = 'n'")
    assert [r.key for r in got.collect()] == ["9", "10"]


def test_one_stray_stamp_gives_many_small_tasks(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz'1971-01-01 00:00:30'")
    filled = S.date_histogram(df, "minute", "t")
    assert filled.count() == 365 * 1440 + 1 and filled.filter("doc_count > 0").count() == 2
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan


def test_report_without_a_successful_request(spark, docs, tmp_path):
    saved = pipeline.static_report(docs, str(tmp_path), dt.datetime(2024, 1, 1), {"bad": {"size": 1}})
    assert saved.count() == 0 and pipeline.saved_answers(spark, saved).count() == 0
