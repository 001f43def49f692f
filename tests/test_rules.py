import datetime as dt

import pytest

from kerbside.functions.clock import with_time_features
from kerbside.operators import rules

START = dt.datetime(2023, 1, 10, 9, 0, 0)


def kept(trips, *changes):
    """For each change, whether validation and cleaning keep the trip."""
    numbered = [{**change, "rate_code": float(i)} for i, change in enumerate(changes)]
    frame = rules.clean(rules.validate_month(trips(*numbered)), as_of_year=2025)
    found = {int(row.rate_code) for row in frame.collect()}
    return [i in found for i in range(len(changes))]


def test_duration_bounds(trips):
    ends = [0, 1, 299 * 60 + 59, 300 * 60, -60]
    changes = [{"dropoff_datetime": START + dt.timedelta(seconds=s)} for s in ends]
    assert kept(trips, *changes) == [False, True, True, False, False]


def test_distance_bounds(trips):
    values = [0.0, 199.99, 200.0, -0.1, None, float("nan")]
    assert kept(trips, *[{"trip_distance": v} for v in values]) == [True, True, False, False, False, False]


def test_fare_bounds(trips):
    values = [0.0, 999.99, 1000.0, -1.0, None]
    changes = [{"fare_amount": v, "taxi_type": "green"} for v in values]
    assert kept(trips, *changes) == [True, True, False, False, False]


def test_type_without_fare_and_distance_passes(trips):
    empty = {"trip_distance": None, "fare_amount": None}
    assert kept(trips, {**empty, "taxi_type": "fhv"}, {**empty, "taxi_type": "fhvhv"}) == [True, False]


@pytest.mark.parametrize(
    "column", ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]
)
def test_required_columns(trips, column):
    assert kept(trips, {column: None}, {column: None, "source_month": None}) == [False, False]


def test_month_of_the_file(trips):
    def trip(moment, month):
        return {
            "pickup_datetime": moment,
            "dropoff_datetime": moment + dt.timedelta(minutes=5),
            "source_month": month,
        }

    jan = dt.date(2023, 1, 1)
    assert kept(
        trips,
        trip(dt.datetime(2023, 1, 1), jan),
        trip(dt.datetime(2023, 1, 31, 23, 59, 59), jan),
        trip(dt.datetime(2023, 2, 1), jan),
        trip(dt.datetime(2022, 12, 31, 23, 59, 59), jan),
        trip(dt.datetime(2022, 12, 31, 23, 59, 59), None),
    ) == [True, True, False, False, True]


def test_year_bounds_of_undated_files(trips):
    def trip(year):
        moment = dt.datetime(year, 6, 1)
        return {
            "pickup_datetime": moment,
            "dropoff_datetime": moment + dt.timedelta(minutes=5),
            "source_month": None,
        }

    assert kept(trips, trip(2018), trip(2019), trip(2025), trip(2026)) == [False, True, True, False]


def test_time_of_day(trips):
    hours = [0, 5, 6, 11, 12, 17, 18, 22, 23]
    frame = with_time_features(trips(*[{"pickup_datetime": dt.datetime(2023, 1, 10, h)} for h in hours]))
    found = {row.pickup_hour: row.time_bucket for row in frame.collect()}
    assert [found[h] for h in hours] == (
        ["night"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 2 + ["night"]
    )


def test_weekend_and_calendar(trips):
    days = [dt.datetime(2023, 1, d, 12) for d in (7, 8, 9)]  # Saturday, Sunday, Monday
    frame = with_time_features(trips(*[{"pickup_datetime": d} for d in days]))
    found = [(r.pickup_dow, r.is_weekend) for r in frame.orderBy("pickup_datetime").collect()]
    assert found == [(7, True), (1, True), (2, False)]


def test_duration_ignores_the_session_time_zone(spark, trips):
    """02:30 does not exist in New York on this day; times without zone are taken as they stand."""
    change = {
        "pickup_datetime": dt.datetime(2023, 3, 12, 1, 50),
        "dropoff_datetime": dt.datetime(2023, 3, 12, 3, 10),
    }
    frame = trips(change)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert with_time_features(frame).first().trip_duration_minutes == 80.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_report_counts_the_first_failing_rule(trips):
    frame = trips(
        {},
        {"pickup_datetime": dt.datetime(2023, 2, 1), "trip_distance": -1.0},
        {"pickup_location_id": None, "fare_amount": -1.0},
        {"source_month": None, "pickup_datetime": dt.datetime(2018, 1, 1)},
        {"dropoff_datetime": START},
        {"trip_distance": 500.0, "fare_amount": 5000.0},
        {"fare_amount": 5000.0},
    )
    row = rules.cleaning_report(frame, as_of_year=2025).first().asDict()
    assert row.pop("taxi_type") == "yellow"
    assert row.pop("rows_in") == 7
    assert set(row.values()) == {1}


def test_report_agrees_with_clean(spark):
    from kerbside import fixtures

    frame = fixtures.trips(spark, "/root/testdata/sf0.001")
    clean = rules.clean(rules.validate_month(frame), as_of_year=2025)
    report = rules.cleaning_report(frame, as_of_year=2025)
    assert {r.taxi_type: r.rows_kept for r in report.collect()} == {
        r.taxi_type: r["count"] for r in clean.groupBy("taxi_type").count().collect()
    }
