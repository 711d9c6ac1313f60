from datetime import date

import pytest

from helpers import rows
from tripmart.operators import ingest

KEYS = "vehicle_type string, year int, month int"


@pytest.fixture
def types(spark):
    return ingest.service_types(spark)


def test_months_before_the_service_are_left_out(types):
    plan = ingest.candidate_months(types)
    per_type = {}
    for r in plan.collect():
        per_type.setdefault(r.vehicle_type, set()).add((r.year, r.month))
    assert {t: len(m) for t, m in per_type.items()} == {
        "yellow": 24, "green": 18, "fhv": 18, "fhvhv": 11}
    assert (2019, 1) not in per_type["fhvhv"] and (2019, 2) in per_type["fhvhv"]


def test_limit_follows_processing_order(types):
    plan = ingest.candidate_months(types, years=(2019, 2016), months=(1, 2))
    got = [(r.vehicle_type, r.year, r.month) for r in ingest.first_months(plan, 6).orderBy(
        "type_ordinal", "year_ordinal", "month").collect()]
    assert got == [("yellow", 2019, 1), ("yellow", 2019, 2), ("yellow", 2016, 1),
                   ("yellow", 2016, 2), ("green", 2019, 1), ("green", 2019, 2)]
    assert ingest.first_months(plan, None).count() == plan.count()


def test_calendar_spans_years(spark):
    spans = spark.createDataFrame(
        [("a", date(2018, 11, 15), date(2019, 2, 1)), ("b", date(2020, 5, 1), date(2020, 4, 1))],
        "k string, first date, last date")
    assert rows(ingest.month_calendar(spans, "first", "last")) == [
        ("a", 2018, 11), ("a", 2018, 12), ("a", 2019, 1), ("a", 2019, 2)]


def test_whole_history(spark):
    got = rows(ingest.whole_history(spark, date(2010, 3, 31)))
    assert got[0] == (2009, 1) and got[-1] == (2010, 3) and len(got) == 15
    assert ingest.whole_history(spark).count() > 180


@pytest.fixture
def listings(spark):
    def make(*data):
        return spark.createDataFrame(list(data), f"{KEYS}, path string")
    near = make(("yellow", 2019, 1, "near/1"), ("yellow", 2019, 2, "near/2"))
    far = make(("yellow", 2019, 2, "far/2"), ("yellow", 2019, 3, "far/3"))
    plan = spark.createDataFrame([("yellow", 2019, m) for m in range(1, 6)], KEYS)
    manifest = spark.createDataFrame([("yellow", 2019, 5), ("yellow", 2019, 5)], KEYS)
    return plan, near, far, manifest


def test_primary_source_wins(listings):
    plan, near, far, _ = listings
    got = ingest.resolve_sources(plan, near, far).select("month", "path", "origin")
    assert rows(got) == [
        (1, "near/1", "primary"), (2, "near/2", "primary"), (3, "far/3", "fallback"),
        (4, None, None), (5, None, None)]


def test_status_of_each_month(listings):
    plan, near, far, manifest = listings
    pending = ingest.not_yet_ingested(plan, manifest)
    assert pending.count() == 4
    resolved = ingest.resolve_sources(pending, near, far)
    status = ingest.month_status(plan, manifest, resolved)
    assert rows(status.select("month", "status")) == [
        (1, "ingested"), (2, "ingested"), (3, "ingested"), (4, "not_published"), (5, "skipped")]
    assert rows(ingest.status_summary(status)) == [
        ("ingested", 3), ("not_published", 1), ("skipped", 1)]


def test_force_ignores_the_manifest(listings):
    plan, near, far, manifest = listings
    pending = ingest.not_yet_ingested(plan, manifest, force=True)
    assert pending.count() == 5
    resolved = ingest.resolve_sources(pending, near, far)
    status = ingest.month_status(plan, manifest, resolved, force=True)
    assert dict(rows(ingest.status_summary(status))) == {"ingested": 3, "not_published": 2}


def test_inventory_questions(spark):
    manifest = spark.createDataFrame(
        [("yellow", 2009, 1, 5), ("yellow", 2019, 2, 6), ("green", 2016, 1, 7)],
        f"{KEYS}, row_count bigint")
    assert rows(ingest.ingested_types(manifest)) == [("green",), ("yellow",)]
    assert rows(ingest.ingested_periods(manifest)) == [
        ("green", 201601, 201601, 1, 7), ("yellow", 200901, 201902, 2, 11)]
    asked = spark.createDataFrame([("yellow", 2009, 1), ("yellow", 2009, 2)], KEYS)
    assert rows(ingest.already_ingested(asked, manifest)) == [("yellow", 2009, 1)]
