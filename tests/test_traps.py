"""One small case per semantic trap."""

import datetime as dt
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from core_helpers import rows
from roadlens.functions import text, typing
from roadlens.operators import clean, dedup, reports
from roadlens.operators import documents as D
from roadlens.operators import search as S
from roadlens.sources import feed
from roadlens.sources.files import load_positional

EVENT = ("row_id bigint, tipo string, subtipo string, ubicacion string, ciudad string, "
         "hora string, lat double, lon double")
STAMP = "2025-04-18T12:30:05"
AS_OF = dt.datetime(2025, 5, 1)


def events(spark, *data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], EVENT)


def positional(spark, tmp_path, *lines, quoted=True):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return load_positional(spark, str(path), quoted)


def test_quotes_shift_columns_only_in_unquoted_mode(spark, tmp_path):
    line = f'HAZARD_X,s,"Av, 1",Ñuñoa,{STAMP},-33.4,-70.6'
    kept = clean.clean_events(positional(spark, tmp_path, line)).first()
    assert (kept.tipo, kept.ubicacion, kept.ciudad) == ("HAZARD", "Av, 1", "ÑUÑOA")
    shifted = positional(spark, tmp_path, line, quoted=False)
    assert shifted.first().hora == "Ñuñoa"
    assert clean.clean_events(shifted).count() == 0


def test_header_line_and_bad_rows_are_dropped(spark, tmp_path):
    read = positional(spark, tmp_path, "tipo,subtipo,ubicacion,ciudad,hora,lat,lon",
                      f"JAM,,A,,{STAMP},bad,-70.6", "JAM,,A", f"JAM,,A,,{STAMP},-33.4,-70.6")
    assert read.count() == 4
    short = read.filter("tipo = 'JAM' AND hora IS NULL").first()
    assert short.lat is None and short.lon is None
    assert clean.clean_events(read).count() == 1


def test_matches_is_a_full_match(spark):
    df = events(spark, ("JAM", None, "A", None, "x2025-04-18T10:00:00", 1.0, 1.0),
                ("JAM", None, "A", None, STAMP + "\n", 1.0, 1.0),
                ("ROAD_HAZARD", None, "A", None, STAMP, 1.0, 1.0),
                ("HAZARD", None, "A", None, STAMP, 1.0, 1.0))
    assert [r.tipo for r in clean.clean_events(df).orderBy("row_id").collect()] == [
        "ROAD_HAZARD", "HAZARD"]


def test_extract_is_a_find_and_null_without_match(spark):
    df = events(spark, ("JAM", None, "A", "B", "2025-04-18", 1.0, 1.0),
                ("JAM", None, "A", "B", STAMP + ".123000", 1.0, 1.0))
    got = df.select(text.minute_bucket(F.col("hora")), text.event_hour(F.col("hora")),
                    text.event_date(F.col("hora"))).collect()
    assert [tuple(r) for r in got] == [(None, None, "2025-04-18"),
                                       ("2025-04-18T12:30", "12", "2025-04-18")]
    assert rows(reports.daily_evolution(df)) == [("2025-04-18", 2)]
    assert rows(reports.hourly_distribution(df)) == [("12", 1)]


def test_null_city_is_one_group(spark):
    df = events(spark, ("JAM", None, "A", None, STAMP, 1.0, 1.0),
                ("JAM", None, "B", None, STAMP, 1.0, 1.0))
    assert rows(reports.incidents_by_city(df)) == [(None, 2, 2)]
    assert rows(reports.incidents_by_city_type(df)) == [(None, "JAM", 2)]


def test_count_skips_rows_without_type(spark):
    df = events(spark, (None, None, "A", "A", STAMP, 1.0, 1.0))
    assert rows(reports.incidents_by_city(df)) == [("A", 0, 1)]
    assert rows(reports.event_counts(df)) == [(None, 0)]


def test_dedup_key_and_pick(spark):
    df = events(spark, ("JAM", "x", "A", None, "2025-04-18T12:30:59", 1.0, 1.0),
                ("JAM", "y", "A", None, "2025-04-18T12:30:05", 2.0, 1.0),
                ("JAM", "y", "A", None, "2025-04-18T12:31:05", 2.0, 1.0),
                ("JAM", "z", None, None, "2025-04-18T12:30:05", 2.0, 1.0),
                ("JAM", "w", None, None, "2025-04-18T12:30:05", 2.0, 1.0))
    assert [r.row_id for r in dedup.dedup_minute(df).orderBy("row_id").collect()] == [1, 2, 3]


def test_iso_fraction_only_when_not_zero(spark):
    df = spark.createDataFrame([(1000,), (1500,), (None,)], "ms bigint")
    got = [r[0] for r in df.select(text.epoch_iso(F.col("ms"))).collect()]
    assert got == ["1970-01-01T00:00:01", "1970-01-01T00:00:01.500000", "1970-01-01T00:00:00"]


def test_natural_key_prints_none(spark):
    df = spark.createDataFrame([("JAM", -33.5, -70.0, None)], "t string, y double, x double, s string")
    key = text.natural_key(F.col("t"), F.col("y"), F.col("x"), F.col("s"))
    assert df.select(key).first()[0] == "JAM_-33.5_-70.0_None"


def test_float_text_reads_like_python(spark):
    values = [0.0, -33.4, 0.00012, 1.5e-05, 1e-05, -2e-11, 12345678.5, 1e7, 123456789012345.0,
              0.1 + 0.2, 1e16, 1.5e22, -3.25e-300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(text.float_text(F.col("v"))).collect()] == list(map(str, values))


def test_terms_order_ties_and_missing(spark):
    data = [("b",)] * 5 + [("a",)] * 5 + [("c",)] * 3 + [(None,)] * 9
    df = spark.createDataFrame(data, "tipo string")
    assert [tuple(r) for r in S.terms(df, "tipo", 2).collect()] == [("a", 5), ("b", 5)]


def test_histogram_fills_gaps(spark):
    days = [dt.datetime(2025, 4, 1, 5), dt.datetime(2025, 4, 4, 7)]
    df = spark.createDataFrame([(d,) for d in days], "`@timestamp` timestamp_ntz")
    got = S.date_histogram(df, "day").orderBy("key").collect()
    assert [r.doc_count for r in got] == [1, 0, 0, 1]
    assert S.date_histogram(df, "hour").count() == 3 * 24 + 3
    assert S.date_histogram(df.filter("false"), "day").count() == 0


def test_change_only_emits_every_change(spark):
    stamps = ["A", "B", "B", "A", None, None, "A"]
    df = events(spark, *[("JAM", None, "S", "C", h, 1.0, 1.0) for h in stamps])
    kept = dedup.change_only(df).orderBy("row_id").collect()
    assert [(r.row_id, r.hora) for r in kept] == [(0, "A"), (1, "B"), (3, "A"), (4, None), (6, "A")]


def test_document_drops_fields_not_rows(spark):
    schema = "tipo string, fecha string, latitud string, longitud string"
    df = spark.createDataFrame([("JAM", "n/a", "x", "-70.1"), (None, "Hora ", None, None),
                                (None, None, "95", "1"), ("P", "2025-04-18", "-33.5", "-70.0")],
                               schema)
    docs = {r.tipo: r for r in D.documents(df, AS_OF).collect()}
    assert set(docs) == {"JAM", None, "P"}
    assert docs["JAM"].latitud is None and docs["JAM"].fecha is None
    assert docs["JAM"]["@timestamp"] == AS_OF
    assert docs[None].latitud == 95.0 and docs[None].location is None
    assert docs["P"].location == "-33.5,-70.0"
    assert docs["P"]["@timestamp"] == dt.datetime(2025, 4, 18)
    assert rows(D.doc_reject(df)) == [(3, 1)]


def test_missing_arrays_and_fields(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"traffic":[{"type":"JAM","location":{"x":1.0,"y":2.0}}]}\n'
        '{"alerts":[{"type":"P","pubMillis":1500,"location":{"x":1.0,"y":2.0}}],"traffic":[]}\n{}\n')
    payloads = feed.read_feed(spark, str(tmp_path))
    got = {r.tipo: r for r in feed.flatten_feed(payloads).collect()}
    assert len(got) == 2
    assert got["JAM"].hora == "1970-01-01T00:00:00" and got["JAM"].lat == 2.0
    assert got["P"].hora == "1970-01-01T00:00:01.500000"
    assert feed.flatten_feed(payloads, ("alerts",)).count() == 1


def test_indented_payload(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{\n "alerts": [\n {"type": "P", "location": {"x": 1, "y": 2}}\n ]\n}\n')
    payloads = feed.read_feed(spark, str(tmp_path), multi_line=True)
    assert feed.flatten_feed(payloads).first().lon == 1.0


def test_load_time_is_not_shifted_by_the_machine_zone(spark, monkeypatch):
    monkeypatch.setenv("TZ", "America/Santiago")
    time.tzset()
    try:
        aware = dt.datetime(2025, 5, 1, 3, tzinfo=dt.timezone(dt.timedelta(hours=3)))
        df = spark.range(1).select(text.moment(AS_OF).cast("string"), text.moment(aware).cast("string"))
        assert tuple(df.first()) == ("2025-05-01 00:00:00", "2025-05-01 00:00:00")
    finally:
        monkeypatch.undo()
        time.tzset()


def test_small_floats_keep_their_digits(spark):
    df = spark.createDataFrame([(-33.4, -70.6)], "lat float, lon float")
    point, number = df.select(typing.geo_point(F.col("lat"), F.col("lon")), typing.to_float(F.col("lat"), T.FloatType())).first()
    assert point == "-33.4,-70.6" and number == -33.4


def test_offsets_count_in_utc(spark):
    texts = ["2025-04-18T12:30:05+02:00", "2025-04-18T12:30:05Z", "2025-04-18T12:30:05", "2025-04-18", "04/18/2025"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] and r[0].isoformat() for r in df.select(typing.to_date(F.col("t"), T.StringType(), ["MM/dd/yyyy"])).collect()]
    assert got == ["2025-04-18T10:30:05", "2025-04-18T12:30:05", "2025-04-18T12:30:05", "2025-04-18T00:00:00", "2025-04-18T00:00:00"]
