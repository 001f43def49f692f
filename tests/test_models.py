import datetime as dt
import math
import statistics

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from frames import rows_of
from kerbside import fixtures
from kerbside.operators import aggregates as agg
from kerbside.operators import rules
from kerbside.plans import ingest, models, serving
from kerbside.plans.metrics import latest_metrics
from kerbside.plans.store import Store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean(spark):
    frame = rules.clean(rules.validate_month(fixtures.trips(spark, SF)), as_of_year=2025).persist()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def hourly(clean):
    return agg.zone_hourly(clean).persist()


def test_split_depends_on_the_row_alone(hourly):
    keys = ["pickup_date", "pickup_hour", "pickup_location_id", "taxi_type"]
    train, test = models.hash_split(hourly, keys)
    again, _ = models.hash_split(hourly.repartition(11), keys)
    assert rows_of(train.select(*keys)) == rows_of(again.select(*keys))
    assert train.count() + test.count() == hourly.count()
    assert 0.75 < train.count() / hourly.count() < 0.85


def test_saved_fare_model_scores_like_the_fitted_one(spark, hourly, tmp_path):
    fitted = models.train_fare(hourly, str(tmp_path / "fare"))
    assert all(math.isfinite(value) for value in fitted.metrics.values())
    assert set(fitted.metrics) == {"training_rows", "test_rows", "rmse", "mae"}
    requests = hourly.select(*models.ZONE_FEATURES, "taxi_type").distinct()
    scored = models.score(fitted.model, requests)
    assert scored.columns == [*models.ZONE_FEATURES, "taxi_type", "prediction"]
    assert rows_of(models.score(PipelineModel.load(str(tmp_path / "fare")), requests)) == rows_of(scored)
    predictions = fitted.model.transform(models.hash_split(models.fare_training_set(hourly), [
        "pickup_date", "pickup_hour", "pickup_location_id", "taxi_type"])[1]).collect()
    errors = [r.prediction - r.avg_fare for r in predictions]
    assert len(errors) == fitted.metrics["test_rows"]
    assert math.isclose(fitted.metrics["mae"], statistics.mean(abs(e) for e in errors))
    assert math.isclose(fitted.metrics["rmse"], math.sqrt(statistics.mean(e * e for e in errors)))


def test_fare_training_bounds(spark, hourly):
    row = hourly.filter("taxi_type = 'green'").limit(1)
    fares = [0.0, 0.01, 199.99, 200.0, None]
    frame = row.drop("avg_fare").crossJoin(spark.createDataFrame([(f,) for f in fares], "avg_fare double"))
    assert sorted(r.avg_fare for r in models.fare_training_set(frame).collect()) == [0.01, 199.99]


def test_weighted_fare_model(hourly):
    assert models.train_fare(hourly, weight_col="trip_count").metrics["rmse"] > 0


def test_training_in_the_store_logs_status(spark, tmp_path, clean):
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(Exception):
        models.train_fare_in_store(store, str(tmp_path / "fare"))
    status = lambda: [r.text for r in latest_metrics(store.log("run_metrics")).collect() if r.metric == "status"]
    assert status() == ["failed"]
    store.write_states(agg.partials(fixtures.trips(spark, SF), as_of_year=2025))
    ingest.refresh_datasets(store, ["yellow", "green"])
    models.train_fare_in_store(store, str(tmp_path / "fare"))
    assert status() == ["ready"]
    bands = {r.metric: r.band for r in latest_metrics(store.log("run_metrics")).collect()}
    assert bands["rmse"] == "red" and bands["training_rows"] is None


def test_tip_model(clean):
    metrics = models.train_tip(clean).metrics
    assert 0 <= metrics["accuracy"] <= 1 and 0 <= metrics["area_under_roc"] <= 1
    assert metrics["test_rows"] > 0


def test_tip_model_in_a_session_that_observed(spark, trips):
    """Fitted, measured and asked for scores after an observation in the same session."""
    observation = Observation()
    assert spark.range(3).observe(observation, F.count(F.lit(1)).alias("n")).count() == 3
    assert observation.get == {"n": 3}
    rows = [{"pickup_location_id": i, "payment_type": 1 + i % 2, "tip_amount": float(i % 2)} for i in range(40)]
    frame = rules.clean(trips(*rows), as_of_year=2025)
    fitted = models.train_tip(frame)
    assert fitted.metrics["test_rows"] > 0 and fitted.metrics["accuracy"] == 1.0
    scored = models.score(fitted.model, models.tip_training_set(frame))
    assert scored.filter("prediction = tipped").count() == 40


def test_clusters_flag_the_farthest(clean):
    flagged = models.cluster_trips(clean, k=3, cut=0.9)
    assert flagged.count() == clean.count()
    assert flagged.filter("cluster IS NULL AND (is_anomaly OR centre_distance IS NOT NULL)").count() == 0
    rows = flagged.filter("cluster IS NOT NULL").select("cluster", "centre_distance", "is_anomaly").collect()
    assert len(rows) == clean.dropna(subset=list(models.CLUSTER_FEATURES)).count()
    assert {r.cluster for r in rows} == {0, 1, 2}
    far = [r.centre_distance for r in rows if r.is_anomaly]
    near = [r.centre_distance for r in rows if not r.is_anomaly]
    assert min(far) > max(near)
    assert 0.08 < len(far) / len(rows) < 0.12


def test_weighted_rows_scale_like_trips(clean):
    """Mean and deviation of distinct rows with weights are those of all trips."""
    trips = clean.withColumns({c: F.floor(F.col(c) / 100).cast("double") for c in models.CLUSTER_FEATURES}).dropna(
        subset=list(models.CLUSTER_FEATURES)
    )
    rows = trips.groupBy(*models.CLUSTER_FEATURES).agg(F.count(F.lit(1)).alias("weight"))
    assert rows.count() < trips.count() / 2
    for name, (mean, deviation) in models.cluster_moments(rows).items():
        plain = trips.agg(F.avg(name), F.stddev(name)).first()
        assert (mean, deviation) == pytest.approx(tuple(plain))


def test_models_beat_a_constant(hourly, clean):
    """The demand model's error is below that of the mean; the tip model guesses better than the larger class."""
    fitted = models.train_demand(hourly)
    train, test = models.hash_split(hourly, models.PRIMARY_KEYS["zone_hourly"])
    mean = train.agg(F.avg("trip_count")).first()[0]
    constant = test.agg(F.sqrt(F.avg(F.pow(F.col("trip_count") - F.lit(mean), F.lit(2))))).first()[0]
    assert fitted.metrics["rmse"] <= constant * 1.02
    rows = models.tip_training_set(clean)
    share = rows.filter(~models.in_training(models.TIP_KEYS)).agg(F.avg("tipped")).first()[0]
    assert models.train_tip(clean).metrics["accuracy"] >= max(share, 1 - share) - 0.05


def test_zscores_against_plain_arithmetic(clean):
    stats = agg.zone_anomaly_stats(clean)
    flagged = models.zscore_flags(clean, stats, 1.5)
    assert flagged.count() == clean.count()
    groups = {}
    rows = clean.select("pickup_location_id", "taxi_type", *models.CLUSTER_FEATURES).collect()
    for r in rows:
        groups.setdefault((r.pickup_location_id, r.taxi_type), []).append(r)
    expected = {}
    for key, members in groups.items():
        hits = set()
        for column in models.CLUSTER_FEATURES:
            values = [r[column] for r in members if r[column] is not None]
            if len(values) > 1 and statistics.stdev(values) > 0:
                mean, spread = statistics.mean(values), statistics.stdev(values)
                hits |= {
                    i for i, r in enumerate(members)
                    if r[column] is not None and abs(r[column] - mean) / spread > 1.5
                }
        expected[key] = (len(members), len(hits))
    found = serving.anomalies_by_zone(flagged).collect()
    assert {(r.pickup_location_id, r.taxi_type): (r.trip_count, r.anomaly_count) for r in found} == expected
    zone = found[0].pickup_location_id
    hits = serving.anomalies_in_zone(flagged, zone)
    assert hits.count() == sum(r.anomaly_count for r in found if r.pickup_location_id == zone)


def test_single_trip_zone_is_never_flagged(trips):
    clean = rules.clean(trips({"fare_amount": 900.0}), as_of_year=2025)
    assert not models.zscore_flags(clean, agg.zone_anomaly_stats(clean)).first().is_anomaly


def test_demand_against_actual(hourly):
    forecast = models.score(models.train_demand(hourly).model, hourly)
    rows = serving.demand_vs_actual(forecast).collect()
    actual = hourly.groupBy("pickup_location_id").agg(F.sum("trip_count").alias("n")).collect()
    assert {r.pickup_location_id: r.actual_trips for r in rows} == {r.pickup_location_id: r.n for r in actual}


def test_zone_stats_filters(hourly):
    everything = serving.zone_stats(hourly).count()
    assert everything == hourly.count()
    some = serving.zone_stats(hourly, [1, 2], dt.date(2023, 1, 5), dt.date(2023, 1, 6), ["fhv"]).collect()
    assert some
    assert all(
        r.pickup_location_id in (1, 2) and r.taxi_type == "fhv" and r.pickup_date.day in (5, 6) for r in some
    )


def test_kpi_weighs_trips(trips):
    frame = trips(
        *[{"fare_amount": 10.0}] * 3,
        {"fare_amount": 50.0, "taxi_type": "green"},
        {"fare_amount": None, "trip_distance": None, "taxi_type": "fhv"},
    )
    row = serving.kpi_daily(agg.partials(frame, as_of_year=2025)).first()
    assert (row.trip_count, row.total_revenue, row.avg_fare) == (5, 80.0, 20.0)


def test_heatmap_ties_and_hotspots(spark, clean):
    buckets = spark.createDataFrame(
        [(5, "night", "fhv", 3), (2, "night", "fhv", 1), (2, "morning", "fhv", 2), (9, "night", "fhv", 1)],
        "pickup_location_id bigint, time_bucket string, taxi_type string, trip_count bigint",
    )
    top = serving.heatmap_topk(buckets, 2).collect()
    assert [(r.pickup_location_id, r.trip_count) for r in top] == [(2, 3), (5, 3)]
    profile = {r.pickup_location_id: r for r in serving.hotspot_profiles(buckets).collect()}
    assert profile[2].morning_share == 2 / 3 and profile[2].evening_share == 0
    spots = serving.hotspots(agg.zone_time_buckets(clean), k=3).collect()
    assert {r.cluster for r in spots} == {0, 1, 2}


def test_a_crash_while_saving_leaves_the_former_model(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    assert models.current_model(store) is None
    store.write_states(agg.partials(fixtures.trips(spark, SF), as_of_year=2025))
    ingest.refresh_datasets(store, ["yellow", "green"])
    first = models.train_fare_in_store(store, str(tmp_path / "fare"))
    train = models.train_fare

    def crash(rows, path):
        train(rows, path)
        raise OSError("after most of it was written")

    monkeypatch.setattr(models, "train_fare", crash)
    with pytest.raises(OSError):
        models.train_fare_in_store(store, str(tmp_path / "fare"))
    assert models.current_model(store).stages[-1].coefficients == first.model.stages[-1].coefficients
    monkeypatch.setattr(models, "train_fare", train)
    models.train_fare_in_store(store, str(tmp_path / "fare"))
    assert [r.version for r in store.log("model_log").orderBy("version").collect()] == [1, 2]
    assert sorted(p.name for p in (tmp_path / "fare").iterdir()) == ["version=1", "version=2"]


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_weighted_quantile_against_repeated_values(spark, share):
    """Within the stated error of the exact value, and exact for few distinct values."""
    pairs = [((i * 7919 % 1009) ** 2 / 37.0, 1 + i % 5) for i in range(800)] + [(None, 3), (5.0, 0)]
    exact = sorted(v for v, w in pairs if v is not None for _ in range(w))
    want = exact[max(0, math.ceil(share * len(exact)) - 1)]
    rows = spark.createDataFrame(pairs, "v double, w bigint")
    got = models.weighted_quantile(rows, "v", "w", share)
    assert want <= got <= want + (exact[-1] - exact[0]) * models.QUANTILE_BINS**-models.QUANTILE_PASSES
    assert models.weighted_quantile(rows.limit(0), "v", "w", share) is None


def test_a_row_of_large_weight_is_one_row(spark):
    rows = spark.createDataFrame([(1.0, 10**9), (2.0, 10**11), (3.0, 1)], "v double, w bigint")
    assert [models.weighted_quantile(rows, "v", "w", share) for share in (0.005, 0.5, 1.0)] == [1.0, 2.0, 3.0]


def test_dense_demand_fills_hours_without_trips(trips):
    rows = [{"pickup_datetime": dt.datetime(2023, 1, day, hour), "dropoff_datetime": dt.datetime(2023, 1, day, hour, 30)} for day, hour in ((5, 7), (5, 7), (7, 23))]
    hourly = agg.zone_hourly(rules.clean(trips(*rows, {"pickup_location_id": 9}), as_of_year=2025))
    found = {(r.pickup_location_id, r.pickup_date.day, r.pickup_hour): r for r in models.dense_demand(hourly).collect()}
    assert len(found) == 3 * 24 + 24
    assert {key: r.trip_count for key, r in found.items() if r.trip_count} == {(7, 5, 7): 2, (7, 7, 23): 1, (9, 10, 9): 1}
    assert (found[7, 6, 0].pickup_dow, found[7, 6, 0].pickup_month, found[7, 6, 0].pickup_year) == (6, 1, 2023)


def test_backtest_looks_at_the_past_only(spark, hourly):
    demand = models.dense_demand(hourly)
    origin = dt.date(2023, 3, 1)
    row = models.backtest_demand(demand, [origin, dt.date(2030, 1, 1)]).orderBy("origin").collect()
    assert row[0].training_rows == demand.filter(F.col("pickup_date") < F.lit(origin)).count()
    assert row[0].test_rows == demand.filter(F.col("pickup_date").between(F.lit(origin), F.lit(dt.date(2023, 3, 7)))).count()
    assert 0 < row[0].rmse < 5 and row[0].naive_rmse > 0
    assert (row[1].test_rows, row[1].rmse, row[1].naive_rmse) == (0, None, None)
    # What comes after the days tested changes nothing.
    past = models.backtest_demand(demand.filter(F.col("pickup_date") <= F.lit(dt.date(2023, 3, 7))), [origin]).first()
    assert past.rmse == pytest.approx(row[0].rmse)


def test_checks_find_coefficients_that_are_not_the_best(hourly):
    training = models.fare_training_set(hourly)
    fitted = models._train_regression(training, "avg_fare", None).model
    train, test = models.hash_split(training, models.PRIMARY_KEYS["zone_hourly"])
    assert all(r.optimal for r in models.regression_checks(train, "avg_fare", fitted).collect())
    assert not all(r.optimal for r in models.regression_checks(test, "avg_fare", fitted).collect())


def test_the_number_of_hotspots_is_that_of_the_best_silhouette(spark):
    counts = {1: (10, 0), 2: (9, 1), 3: (0, 10), 4: (1, 9)}
    rows = [(zone, name, "fhv", n) for zone, pair in counts.items() for name, n in zip(("night", "morning"), pair)]
    schema = "pickup_location_id bigint, time_bucket string, taxi_type string, trip_count bigint"
    buckets = spark.createDataFrame(rows, schema)
    found = {row.k: row for row in serving.hotspot_choices(buckets, (5, 3, 2)).collect()}
    # Squared distances: 0.02 to the twin; 2 and 1.62, or 1.62 and 1.28, to the others.
    plain = statistics.mean((1 - 0.02 / 1.81, 1 - 0.02 / 1.45))
    assert found[2].silhouette == pytest.approx(plain) and found[3].silhouette < plain
    assert found[5].silhouette is None, "four zones are no five clusters"
    assert [k for k, row in found.items() if row.chosen] == [2]
    none = serving.hotspot_choices(buckets.limit(0), (2, 3)).collect()
    assert [(row.silhouette, row.chosen) for row in none] == [(None, False)] * 2
