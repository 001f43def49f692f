import math
import statistics

import pytest
from pyspark.sql import functions as F

from frames import rows_of
from kerbside import fixtures
from kerbside.operators import aggregates as agg
from kerbside.operators import rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def derived(spark):
    frame = fixtures.trips(spark, SF).persist()
    yield frame
    frame.unpersist()


def close(left, right, digits=9):
    def rounded(frame):
        doubles = [name for name, kind in frame.dtypes if kind == "double"]
        return rows_of(frame.withColumns({n: F.round(n, digits) for n in doubles}))

    return rounded(left) == rounded(right)


@pytest.mark.parametrize("name", list(agg.AGGREGATES))
def test_states_give_what_all_trips_at_once_give(derived, name):
    clean = rules.clean(rules.validate_month(derived), as_of_year=2025)
    aggregate = agg.AGGREGATES[name]
    assert close(aggregate(agg.partials(derived, as_of_year=2025)), aggregate(clean))


def test_averages_are_bit_equal_in_any_partitioning(derived):
    clean = rules.clean(rules.validate_month(derived), as_of_year=2025)
    once = rows_of(agg.daily_stats(clean))
    assert rows_of(agg.daily_stats(clean.repartition(13))) == once
    assert rows_of(agg.daily_stats(agg.partials(derived.repartition(5), as_of_year=2025))) == once


def test_deviations_are_bit_equal_in_any_partitioning(derived):
    clean = rules.clean(rules.validate_month(derived), as_of_year=2025)
    once = rows_of(agg.zone_anomaly_stats(clean))
    assert rows_of(agg.zone_anomaly_stats(clean.repartition(13))) == once
    assert rows_of(agg.zone_anomaly_stats(agg.partials(derived.repartition(5), as_of_year=2025))) == once
    assert rows_of(agg.zone_anomaly_stats(agg.monthly(agg.partials(derived, as_of_year=2025)))) == once


def test_deviation_against_plain_arithmetic(trips):
    fares = {1: [10.0], 2: [5.0, 9.0], 3: [1.25, 2.5, 900.0, 3.75]}
    frame = trips(*[{"pickup_location_id": z, "fare_amount": x} for z, xs in fares.items() for x in xs])
    for source in (rules.clean(frame, as_of_year=2025), agg.partials(frame, as_of_year=2025)):
        found = {r.pickup_location_id: r for r in agg.zone_anomaly_stats(source).collect()}
        assert found[1].stddev_fare_amount is None
        for zone in (2, 3):
            assert math.isclose(found[zone].avg_fare_amount, statistics.mean(fares[zone]))
            assert math.isclose(found[zone].stddev_fare_amount, statistics.stdev(fares[zone]))
        assert found[3].stddev_trip_distance == 0.0


def test_deviation_far_from_zero_keeps_its_digits(trips):
    """A tiny spread around a large mean, over many states."""
    values = [999.0 + i * 1e-6 for i in range(40)]
    frame = trips(*[{"fare_amount": v, "source_file": f"yellow_{i % 8}.parquet"} for i, v in enumerate(values)])
    row = agg.zone_anomaly_stats(agg.partials(frame, as_of_year=2025)).first()
    assert math.isclose(row.stddev_fare_amount, statistics.stdev(values), rel_tol=1e-6)


def test_totals_beyond_the_unit_are_not_lost(trips):
    frame = trips(*[{"total_amount": v} for v in (1e15, -3e9, 2.25, None)])
    for source in (rules.clean(frame, as_of_year=2025), agg.partials(frame, as_of_year=2025)):
        assert agg.zone_hourly(source).first().avg_total == (1e15 - 3e9 + 2.25) / 3


def test_nan_total_makes_the_average_nan(trips):
    frame = rules.clean(trips({"total_amount": float("nan")}, {"total_amount": 1.0}), as_of_year=2025)
    assert math.isnan(agg.zone_hourly(frame).first().avg_total)


def test_absent_measures_are_null(trips):
    bare = {"taxi_type": "fhv", "fare_amount": None, "trip_distance": None, "total_amount": None, "passenger_count": None}
    frame = rules.clean(trips(bare), as_of_year=2025)
    daily = agg.daily_stats(frame).first()
    assert (daily.total_passengers, daily.avg_fare, daily.total_revenue) == (None, None, None)
    hourly = agg.zone_hourly(frame).first()
    assert (hourly.avg_distance, hourly.avg_fare, hourly.avg_total) == (None, None, None)
    assert hourly.avg_duration_minutes == 20.0


def test_accounts_cover_every_row(derived):
    states = agg.partials(derived, as_of_year=2025)
    row = agg.source_accounts(states).agg(F.sum("rows_in").alias("n"), F.sum("rows_kept").alias("k")).first()
    assert row.n == derived.count()
    assert row.k == rules.clean(rules.validate_month(derived), as_of_year=2025).count()


def test_rejected_rows_cannot_break_the_sums(trips):
    frame = trips({}, {"fare_amount": 1e300}, {"trip_distance": float("inf")}, {"fare_amount": float("nan")})
    row = agg.daily_stats(agg.partials(frame, as_of_year=2025)).first()
    assert (row.trip_count, row.total_revenue) == (1, 12.5)


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_shuffles(spark):
    trips = fixtures.trips(spark, SF)
    clean = rules.clean(rules.validate_month(trips), as_of_year=2025)
    for aggregate in agg.AGGREGATES.values():
        assert exchanges(aggregate(clean)) == 1
    states = agg.partials(trips, as_of_year=2025)
    for aggregate in agg.AGGREGATES.values():
        assert exchanges(aggregate(states)) == 2
