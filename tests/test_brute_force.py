"""The whole batch job against a plain Python rendering of its rules, on messy random rows."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from core_helpers import rows
from roadlens.functions import text
from roadlens.operators import clean, dedup, reports

SCHEMA = ("row_id bigint, tipo string, subtipo string, ubicacion string, ciudad string, "
          "hora string, lat double, lon double")


def messy(seed, n=400):
    draw = random.Random(seed)
    stamps = ["2025-04-18T12:30:05", "2025-04-18T12:30:59.5", "2025-04-18T12:31:00", "2025-04-19",
              "2025-04-19T1", "x2025-04-18T12:30:05", "hora", "", None, "2025-04-19T07:00:01Z"]
    return [(i, draw.choice(["JAM", "HAZARD", "HAZARD_X", "ROAD_HAZARD", "", None]),
             draw.choice(["s", None]), draw.choice(["A", "B", None]),
             draw.choice(["ñuñoa", "Ñuñoa", "maipú", None]), draw.choice(stamps),
             draw.choice([-33.5, -33.5, -33.5, None]), draw.choice([-70.5, -70.5, None]))
            for i in range(n)]


def expected(data):
    kept = {}
    for i, tipo, sub, street, city, hora, lat, lon in data:
        if None in (tipo, hora, lat, lon) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}.*", hora):
            continue
        tipo = "HAZARD" if re.fullmatch("HAZARD.*", tipo) else tipo
        city = city and city.upper()
        minute = re.search(r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}).*", hora)
        key = (tipo, city, minute and minute[1], street)
        row = (i, tipo, sub, street, city, hora, lat, lon)
        if key not in kept or (hora, i) < (kept[key][5], kept[key][0]):
            kept[key] = row
    return list(kept.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clean_dedup_reports(spark, seed):
    data = messy(seed)
    unique = dedup.dedup_minute(clean.clean_events(
        spark.createDataFrame(data, SCHEMA).repartition(5))).cache()
    want = expected(data)
    assert rows(unique) == sorted(want, key=repr)
    assert rows(reports.incidents_by_city_type(unique)) == sorted(
        ((c, t, n) for (c, t), n in Counter((r[4], r[1]) for r in want).items()), key=repr)
    days = Counter(r[5][:10] for r in want if re.fullmatch(r"\d{4}-\d{2}-\d{2}", r[5][:10]))
    assert rows(reports.daily_evolution(unique)) == sorted(days.items(), key=repr)
    hours = (re.search(r".*T(\d{2}):\d{2}:\d{2}", r[5]) for r in want)
    assert rows(reports.hourly_distribution(unique)) == sorted(
        Counter(h[1] for h in hours if h).items(), key=repr)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=50, max_size=200))
def test_float_text_is_the_shortest_form(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [float(r[0]) for r in df.select(text.float_text(F.col("v"))).collect()]
    assert got == values


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="HAZARD\n_x-0123456789T:", max_size=20), min_size=50, max_size=200))
def test_matches_and_finds_agree_with_re(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    c = F.col("v")
    got = df.select(text.full_match(c, text.DATE_PREFIX_PATTERN), text.standardise_type(c),
                    text.minute_bucket(c)).collect()
    for v, row in zip(values, got):
        minute = re.search(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}", v)
        assert tuple(row) == (bool(re.fullmatch(r"\d{4}-\d{2}-\d{2}.*", v)),
                              "HAZARD" if re.fullmatch("HAZARD.*", v) else v,
                              minute and minute[0])
