"""Invariants of the seven reports."""

from pyspark.sql import functions as F

from core_helpers import rows
from roadlens.operators import reports
from roadlens.plans import pipeline
from roadlens.schemas import REPORT_SCHEMAS


def test_columns(tables):
    for name, report in reports.REPORTS.items():
        got = ", ".join(f"{c} {t}" for c, t in report(tables["unique"]).dtypes)
        assert got == REPORT_SCHEMAS[name]


def test_base_gives_the_same_reports(spark, tables):
    # Uncleaned events too: types, stamps and cities may be missing there.
    for name in ("unique", "raw"):
        rolled = reports.reports_from_base(reports.report_base(tables[name]))
        for report, direct in reports.REPORTS.items():
            assert rows(rolled[report]) == rows(direct(tables[name])), report


def test_totals_agree(tables):
    unique = tables["unique"]
    n = unique.count()
    for report in reports.REPORTS.values():
        df = report(unique)
        total = next(c for c in df.columns if c.startswith("total"))
        assert df.agg(F.sum(total)).first()[0] == n


def test_rollups(tables):
    unique = tables["unique"]

    def rolled(report, key, total):
        return rows(report(unique).groupBy(key).agg(F.sum("total").alias(total)))

    assert rolled(reports.incidents_by_city_type, "tipo", "total") == rows(
        reports.event_counts(unique))
    assert rolled(reports.incidents_by_city_type, "ciudad", "total") == rows(
        reports.incidents_by_city(unique).select("ciudad", "total"))
    assert rolled(reports.daily_evolution_by_type, "fecha", "total_incidentes") == rows(
        reports.daily_evolution(unique))
    assert rolled(reports.hourly_peaks_by_type, "hora_dia", "total_incidentes") == rows(
        reports.hourly_distribution(unique))


def test_batch_job_writes_every_report(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    frames = pipeline.batch_reports(tables["raw"], out)
    assert rows(frames["data_unique"]) == rows(tables["unique"])
    for name, ddl in REPORT_SCHEMAS.items():
        saved = spark.read.schema(ddl).csv(f"{out}/{name}.csv")
        assert rows(saved) == rows(reports.REPORTS[name](tables["unique"])), name


def test_batch_job_without_arrival_numbers(tables, tmp_path):
    frames = pipeline.batch_reports(tables["raw"].drop("row_id"), str(tmp_path / "out"))
    assert frames["data_unique"].count() == tables["unique"].count()
