"""Sources and sinks on folders."""

import csv
import glob

import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from roadlens.operators import documents as D
from roadlens.operators import snapshot
from roadlens.schemas import POSITIONAL, index_schema, snapshot_dataset
from roadlens.sinks import files as sinks
from roadlens.sources import files as sources

AWKWARD = [("JAM", "a,b", 'say "x"', None, " padded ", -33.5, -70.25),
           ("P", None, "Ñuñoa", "línea", "2025-04-18T12:30:05", None, -70.5)]
EVENTS = ("tipo string, subtipo string, ubicacion string, ciudad string, hora string, "
          "lat float, lon float")


def part_files(path):
    return glob.glob(f"{path}/part-*")


def test_csv_export_is_plain_csv(spark, tmp_path):
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(AWKWARD)], "_id string, " + EVENTS)
    sinks.csv_export(df.coalesce(1), str(tmp_path / "out"))
    (part,) = part_files(tmp_path / "out")
    with open(part, newline="", encoding="utf-8") as f:
        got = list(csv.reader(f))
    assert got[0] == ["tipo", "subtipo", "ubicacion", "ciudad", "hora", "lat", "lon"]
    assert got[1:] == [["" if v is None else str(v) for v in r] for r in AWKWARD]


def test_delimited_reads_back(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, EVENTS)
    sinks.store_delimited(df, str(tmp_path / "q"))
    assert rows(sources.load_positional(spark, str(tmp_path / "q"))) == rows(df)


def test_unquoted_form_has_no_quotes(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, EVENTS).coalesce(1)
    sinks.store_delimited(df, str(tmp_path / "u"), quoted=False)
    (part,) = part_files(tmp_path / "u")
    with open(part, encoding="utf-8") as f:
        assert f.read().splitlines()[0] == 'JAM,a,b,say "x",, padded ,-33.5,-70.25'


def test_append_adds_and_replace_removes(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.range(5)
    sinks.store_append(df, path)
    sinks.store_append(df.filter("id < 0"), path)
    sinks.store_append(df, path)
    assert spark.read.parquet(path).count() == 10
    sinks.replace_output(df.limit(2), path)
    assert spark.read.parquet(path).count() == 2


def test_store_scan_limit(spark, tmp_path):
    path = str(tmp_path / "store")
    sinks.store_append(spark.range(50).repartition(4), path)
    assert [r.id for r in sources.store_scan(spark, path, 3, ["id"]).collect()] == [0, 1, 2]
    assert sources.store_scan(spark, path).count() == 10
    assert sources.store_scan(spark, path, 0).count() == 50
    assert sources.store_scan(spark, path, None).count() == 50
    (tmp_path / "empty").mkdir()
    assert sources.store_scan_all(spark, str(tmp_path / "empty"), EVENTS).count() == 0


def test_publish_as_one_file_only_when_asked(spark, tmp_path):
    df = spark.range(100).repartition(4)
    sinks.publish(df, str(tmp_path / "single"), single=True)
    sinks.publish(df, str(tmp_path / "large"))
    assert len(part_files(tmp_path / "single")) == 1
    assert len(part_files(tmp_path / "large")) > 1
    assert spark.read.csv(str(tmp_path / "large")).count() == 100


def test_inventory_lists_csv_only(spark, tmp_path):
    for name in ("a.csv", "b.csv", "c.txt"):
        (tmp_path / name).write_text("x" * (10 if name == "a.csv" else 3))
    got = {r.path.rsplit("/", 1)[1]: r.bytes
           for r in sources.dataset_inventory(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": 10, "b.csv": 3}


def test_generic_types(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,1,1.5,a,2025-01-01,NA\n2,,2,1,2025-01-02,\n3,3,x,2,d,null\n")
    df = sources.load_generic(spark, str(tmp_path / "x.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "string", "string"] + [
        "double"] * 5
    assert rows(df)[0][:6] == (1, 1.0, "1.5", "a", "2025-01-01", None)
    mapping = D.doc_mapping("other", df)
    assert mapping["campo_0"] == "integer" and mapping["campo_1"] == "float"
    assert mapping["campo_3"] == "text" and mapping["@timestamp"] == "date"


def test_named_datasets(spark, tmp_path):
    (tmp_path / "x.csv").write_text("JAM,NA,None,Ñ,2025-01-01T00:00:00,-33.5,bad\nP,,,,,NaN,1\n")
    row, other = sources.load_named(spark, str(tmp_path / "x.csv"), "data_unique.csv").collect()
    assert other.latitud is None and other.longitud == 1.0
    assert row.subtipo is None and row.calle is None and row.latitud == -33.5
    assert row.longitud is None
    (tmp_path / "h.csv").write_text("12,40\n")
    hours = sources.load_named(spark, str(tmp_path / "h.csv"), "distribucion_horaria.csv", "snapshot")
    assert rows(hours) == [("12", 40)]
    assert sources.load_named(spark, str(tmp_path / "h.csv"), "unknown").columns[0] == "campo_0"
    with pytest.raises(ValueError):
        sources.load_named(spark, str(tmp_path / "h.csv"), "unknown", "snapshot")


def test_registry_finds_names():
    assert snapshot_dataset("incidentes_ciudad_tipo.csv").namespace == "incidentes:por_ciudad"
    assert snapshot_dataset("conteo_eventos.csv").namespace == "incidentes:global"
    assert snapshot_dataset("picos_por_hora_tipo.csv").ddl.startswith("hora string, tipo")
    assert snapshot_dataset("notes.csv") is None
    assert index_schema("filtered_events.csv") == index_schema("data_unique.csv")
    assert index_schema("evolucion_por_tipo") is None
    assert sinks.index_name("data_unique.csv", "x_") == "x_data-unique"


def test_snapshot_is_stable_and_keyed_by_content(spark):
    df = spark.createDataFrame([("JAM", 2), ("JAM", 2), ("P", None)], "tipo string, conteo bigint")
    first = rows(snapshot.kv_snapshot(df, "incidentes:global"))
    assert len(first) == 2
    assert first == rows(snapshot.kv_snapshot(df.repartition(3), "incidentes:global"))
    assert sorted(v for _, _, v in first) == ['{"tipo":"JAM","conteo":2}', '{"tipo":"P"}']
    assert all(k.startswith("incidentes:global:") for _, k, _ in first)


def test_roundtrip_sees_lost_doubled_and_changed_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v bigint")
    assert rows(snapshot.roundtrip_verify(df, df.repartition(3))) == [(3, 3, True)]
    assert rows(snapshot.roundtrip_verify(df, df.distinct())) == [(3, 2, False)]
    swapped = spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "k string, v bigint")
    assert rows(snapshot.roundtrip_verify(df, swapped)) == [(3, 3, False)]
    none = df.filter("false")
    assert rows(snapshot.roundtrip_verify(none, none)) == [(0, 0, True)]


def test_export_schema_matches_positional(spark):
    assert [f.split()[0] for f in POSITIONAL.split(", ")] == spark.createDataFrame(
        [], EVENTS).columns


def test_index_is_laid_out_by_time(spark, tmp_path):
    """A third of the documents share one instant and still spread over files."""
    stamp = F.when(F.col("id") % 3 == 0, F.timestamp_seconds(F.lit(0))).otherwise(
        F.timestamp_seconds(F.col("id")))
    docs = spark.range(0, 30_000, 1, 8).select(
        F.lit("JAM").alias("tipo"), stamp.cast("timestamp_ntz").alias("@timestamp"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = sinks.doc_index(docs, str(tmp_path), "data_unique")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("@timestamp").alias("lo"),
                  F.max("@timestamp").alias("hi")).orderBy("lo", "hi").collect())
    assert sum(f.n for f in files) == 30_000
    assert max(f.n for f in files) < 8_000
    assert all(a.hi <= b.lo for a, b in zip(files, files[1:]))


def test_document_json_leaves_out_missing_fields(spark):
    df = spark.sql("SELECT 'JAM' AS tipo, CAST(NULL AS STRING) AS calle, "
                   "timestamp_ntz'2025-04-18 12:30:05' AS fecha")
    assert D.document_json(df).first()[0] == '{"tipo":"JAM","fecha":"2025-04-18T12:30:05"}'


def test_typing_rules(spark):
    df = spark.createDataFrame([("5", "5.0", " 7 ", 5.9, "1e2", "5d", "inf")],
                               "count string, hour string, cantidad string, hora double, "
                               "lat string, lng string, latitude string")
    assert tuple(D.coerced(df).first()) == (5, None, 7, 5, 100.0, None, float("inf"))
    numbers = spark.createDataFrame([(20250418, 1.5, True)], "fecha bigint, otro double, ok boolean")
    assert tuple(D.coerced(numbers).first()) == (None, "1.5", "True")
    assert D.coerced(df.select(F.col("count").alias("a.b"))).columns == ["a.b"]


def test_generic_takes_its_width_from_the_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text('1,2\n1,2,3,4,5,6,7,8,9,10,"a,b",12\n')
    df = sources.load_generic(spark, str(tmp_path / "x.csv"))
    assert df.columns == [f"campo_{i}" for i in range(12)]
    assert rows(df)[1][10:] == ("a,b", 12.0) or rows(df)[0][10:] == ("a,b", 12.0)


def test_distinct_rows_stay_distinct_in_the_snapshot(spark):
    data = [("A|B", "C", None), ("A", "B|C", None), ("A", "B|C", "~"), ("A", "B|C", "~")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    saved = snapshot.kv_snapshot(df, "n").collect()
    assert len(saved) == 3 and len({r.key for r in saved}) == 3


def test_line_breaks_and_their_signs_survive(spark, tmp_path):
    texts = ["Av\n1", "a\r\nb", 'q "x", y\n', "\u240a", "\u241b\u240a\n", "\u241b\u241b", "\n\n\r", "plain", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "street string, n int")
    sinks.store_delimited(df, str(tmp_path / "out"))
    back = sources.load_positional(spark, str(tmp_path / "out"), schema="street string, n int")
    assert rows(back) == rows(df)
    (tmp_path / "foreign.csv").write_text('"Av\n1",7\n')
    foreign = sources.load_positional(spark, str(tmp_path / "foreign.csv"), schema="street string, n int", multi_line=True)
    assert rows(foreign) == [("Av\n1", 7)]


def test_options_reach_unknown_datasets(spark, tmp_path):
    (tmp_path / "x.csv").write_text('name,number\n"a\nb",1\n"c, d",2\n')
    df = sources.load_named(spark, str(tmp_path / "x.csv"), "unknown", header=True, multi_line=True)
    assert [(r.campo_0, r.campo_1) for r in df.orderBy("campo_1").collect()] == [("a\nb", 1), ("c, d", 2)]
    assert dict(df.dtypes)["campo_1"] == "bigint" and len(df.columns) == 10
    (tmp_path / "y.csv").write_text("name,number\na,1\nb,2\n")
    assert rows(sources.load_named(spark, str(tmp_path / "y.csv"), "unknown", header=True).select("campo_0", "campo_1")) == [("a", 1), ("b", 2)]


def mapped(df, name):
    return {r.field: r.type for r in D.content_mapping(name, df).collect()}


def test_the_mapping_follows_the_content(spark):
    schema = "tipo string, fecha string, latitud double, nota string"
    first = spark.createDataFrame([("JAM", "2025-01-01T10:00:00", 1.5, "7"), (None, None, None, "8")], schema)
    common = {"@timestamp": "date", "location": "geo_point"}
    assert mapped(first, "data_unique") == {**common, "tipo": "keyword", "fecha": "date", "latitud": "float", "nota": "integer"}
    other = spark.createDataFrame([("JAM", "no date", 1.5, "two words"), (None, None, None, "8")], schema)
    assert mapped(other, "data_unique") == {**common, "tipo": "keyword", "fecha": "text", "latitud": "float", "nota": "text"}
    assert mapped(first.filter("false"), "other")["nota"] == "float"
    text = D.content_mapping("other", first)._jdf.queryExecution().executedPlan().toString()
    assert text.count("ExistingRDD") == 1  # one pass
