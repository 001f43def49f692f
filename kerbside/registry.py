"""Every operator as a runnable query over the test tables.

Each query takes a session and the folder of the tables. Trips are derived from
the whole of ``lineitem``; bookkeeping inputs from the trips or from ``events``.
Deviations are rounded to four places, because another engine sums in another order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside import fixtures
from kerbside.functions.clock import with_time_features
from kerbside.operators import aggregates as agg
from kerbside.operators import intake, keyed, rules
from kerbside.operators.unify import normalise, union_trips
from kerbside.plans import ingest, load, metrics, models, serving
from kerbside.plans.store import Store
from kerbside.schema import DATASETS, INGEST_OUTCOMES, PRIMARY_KEYS, TAXI_TYPES, TRIP_SCHEMA
from kerbside.sources import coverage as cov
from kerbside.sources.listing import check_files, raw_inventory
from kerbside.sources.processed import changed
from kerbside.sources.raw import scan_raw
from kerbside.streaming.flags import run_flag_stream
from kerbside.streaming.intake import run_stream
from kerbside.workspace import scratch, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(2023, 12, 31)
JAN, FEB, MAR = (dt.date(2023, month, 1) for month in (1, 2, 3))
SOURCE = ("source_file", "source_month")
CHECKED_ZONES = (3, 17, 42)
ZSCORE_THRESHOLD = 1.5


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- inputs -----------------------------------------------------------------------


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.trips(spark, sf)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return rules.clean(rules.validate_month(_trips(spark, sf)), as_of_year=AS_OF.year)


def _states(spark: SparkSession, sf: str) -> DataFrame:
    return agg.partials(_trips(spark, sf), as_of_year=AS_OF.year)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    """One row per raw source of the trips, as a file listing would give."""
    return (
        _trips(spark, sf)
        .groupBy("taxi_type", F.col("source_file").alias("file_name"), "source_month")
        .agg((F.count(F.lit(1)) * 100).alias("length"))
    )


def _rounded_stats(stats: DataFrame) -> DataFrame:
    names = [c for c in stats.columns if c.startswith("stddev_")]
    return stats.withColumns({name: F.round(name, 4) for name in names})


def _timestamp(text: str):
    return F.lit(text).cast("timestamp")


# -- unify, features, cleaning ---------------------------------------------------------


@query
def trips_unified(spark, sf):
    """Raw columns of each type to the unified schema, then one union."""
    trips = _trips(spark, sf)
    frames = [normalise(fixtures.raw_shape(trips, t), t, keep=SOURCE) for t in TAXI_TYPES]
    return union_trips(frames)


@query
def time_features(spark, sf):
    return with_time_features(_trips(spark, sf)).select(
        "taxi_type", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes", "pickup_hour",
        "pickup_dow", "pickup_month", "pickup_year", "pickup_date", "is_weekend", "time_bucket",
    )


@query
def month_validation(spark, sf):
    """Raw files of which only the month in the name is read."""
    trips = scan_raw(spark, _raw_dir(spark, sf), only_source_month=True)
    return trips.select(*TRIP_SCHEMA.fieldNames(), *SOURCE)


@query
def clean_trips(spark, sf):
    return _clean(spark, sf).drop("source_file")


@query
def cleaning_report(spark, sf):
    return rules.cleaning_report(_trips(spark, sf), as_of_year=AS_OF.year)


# -- aggregates --------------------------------------------------------------------------


@query
def zone_hourly(spark, sf):
    return agg.zone_hourly(_clean(spark, sf))


@query
def daily_stats(spark, sf):
    return agg.daily_stats(_clean(spark, sf))


@query
def zone_time_buckets(spark, sf):
    return agg.zone_time_buckets(_clean(spark, sf))


@query
def zone_anomaly_stats(spark, sf):
    return _rounded_stats(agg.zone_anomaly_stats(_clean(spark, sf)))


@query
def incremental_zone_hourly(spark, sf):
    return agg.zone_hourly(_states(spark, sf))


@query
def incremental_daily_stats(spark, sf):
    return agg.daily_stats(_states(spark, sf))


@query
def incremental_zone_time_buckets(spark, sf):
    return agg.zone_time_buckets(_states(spark, sf))


@query
def incremental_zone_anomaly_stats(spark, sf):
    return _rounded_stats(agg.zone_anomaly_stats(_states(spark, sf)))


@query
def source_accounts(spark, sf):
    return agg.source_accounts(_states(spark, sf))


@query
def stored_zone_anomaly_stats(spark, sf):
    """States written month by month, one month twice, and combined on read."""
    store = Store(spark, scratch(spark, "stored-stats"))
    trips = _trips(spark, sf)
    month = F.col("source_month")
    for part in (month == JAN, month == FEB, month == JAN, month == MAR, month.isNull()):
        store.write_states(agg.partials(trips.filter(part), as_of_year=AS_OF.year))
    return _rounded_stats(agg.zone_anomaly_stats(store.states()))


@query
def stream_file_once(spark, sf):
    """Two runs of the stream over the same raw files; the second finds nothing new."""
    store_dir, checkpoint = scratch(spark, "stream-store"), scratch(spark, "stream-checkpoint")
    raw_dir = _raw_dir(spark, sf)
    for _ in range(2):
        run_stream(spark, raw_dir, store_dir, checkpoint, AS_OF).awaitTermination()
    return Store(spark, store_dir).dataset("daily_stats")


# -- raw files and bookkeeping --------------------------------------------------------------


def _raw_dir(spark: SparkSession, sf: str) -> str:
    raw_dir = scratch(spark, "raw")
    fixtures.write_raw_files(_trips(spark, sf), raw_dir)
    return raw_dir


@query
def raw_scan(spark, sf):
    """Trips written as raw files of all types and months, and scanned back."""
    return scan_raw(spark, _raw_dir(spark, sf)).groupBy("taxi_type", *SOURCE).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.count("trip_distance").alias("distances"),
        F.count("payment_type").alias("payments"),
        F.min("pickup_datetime").alias("first_pickup"),
        F.max("dropoff_datetime").alias("last_dropoff"),
    )


@query
def file_integrity(spark, sf):
    """The table files themselves: names, integrity and row counts from their footers."""
    return check_files(spark, sf).select("file_name", "is_valid", "row_count")


@query
def inventory(spark, sf):
    return raw_inventory(_sources(spark, sf))


@query
def file_coverage(spark, sf):
    kind, month = F.col("taxi_type"), F.col("source_month")
    files = _sources(spark, sf).filter(~((kind == "fhv") & month.eqNullSafe(F.lit(MAR))))
    files = files.withColumn("is_valid", ~((kind == "green") & month.eqNullSafe(F.lit(FEB))))
    return cov.coverage(files, dt.date(2022, 12, 1), dt.date(2023, 7, 15))


@query
def outcome_rollup(spark, sf):
    """Five of the seven outcomes occur; three files needed no attempt."""
    names = F.array(*[F.lit(o) for o in INGEST_OUTCOMES])
    log = _events(spark, sf).select(
        F.element_at(names, (F.col("user_id") % 5 + 1).cast("int")).alias("outcome"),
        F.col("value").alias("seconds"),
    )
    return cov.outcome_rollup(log, already_present=3).withColumn("seconds", F.round("seconds", 4))


def _manifest(sources: DataFrame) -> DataFrame:
    """January is done; fhv of February was done and then reset."""
    month = F.col("source_month")
    done = sources.filter(
        (month == JAN) | ((month == FEB) & (F.col("taxi_type") == "fhv"))
    ).withColumns({"status": F.lit("done"), "committed_at": _timestamp("2023-06-01 00:00:00")})
    reset = done.filter(month == FEB).withColumns(
        {"status": F.lit("reset"), "committed_at": _timestamp("2023-06-02 00:00:00")}
    )
    return done.unionByName(reset).withColumn("stage", F.lit("transform"))


@query
def pending_files(spark, sf):
    sources = _sources(spark, sf)
    return intake.pending(sources, _manifest(sources)).select("taxi_type", "file_name", "length")


@query
def stage_reset(spark, sf):
    """After a reset of the stage every file is pending again."""
    sources = _sources(spark, sf)
    manifest = _manifest(sources)
    after = manifest.unionByName(intake.reset_rows(manifest, "transform"), allowMissingColumns=True)
    return intake.pending(sources, after).select("taxi_type", "file_name", "length")


@query
def changed_partitions(spark, sf):
    """yellow is up to date, green has changed, fhv is new, fhvhv failed last time."""
    times = _trips(spark, sf).groupBy("taxi_type").agg(F.max("pickup_datetime").cast("timestamp").alias("mtime"))
    datasets = F.explode(F.array(*[F.lit(name) for name in DATASETS]))
    partitions = times.withColumn("dataset", datasets)
    kind = F.col("taxi_type")
    log = partitions.filter(kind != "fhv").select(
        "dataset",
        "taxi_type",
        F.when(kind == "green", F.col("mtime") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("mtime")).alias("last_mtime"),
        F.when(kind == "fhvhv", "failed").otherwise("loaded").alias("status"),
        _timestamp("2023-06-01 00:00:00").alias("loaded_at"),
    )
    return changed(partitions, log).select("dataset", "taxi_type")


# -- keyed tables -----------------------------------------------------------------------------


@query
def upsert_daily_stats(spark, sf):
    """January, February and undated trips first; then all but those of January, without the fare column."""
    return keyed.upsert(*_daily_upsert(spark, sf), PRIMARY_KEYS["daily_stats"])


@query
def upsert_small_daily_stats(spark, sf):
    """The same, with the incoming rows stored and looked up in place of a shuffle of the target."""
    target, incoming = _daily_upsert(spark, sf)
    return keyed.upsert_small(target, written(incoming, "incoming"), PRIMARY_KEYS["daily_stats"])


def _daily_upsert(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    trips, month = _clean(spark, sf), F.col("source_month")
    target = agg.daily_stats(trips.filter(month.isNull() | (month <= FEB)))
    return target, agg.daily_stats(trips.filter(month.isNull() | (month >= FEB))).drop("avg_fare")


@query
def dedupe_keep_last(spark, sf):
    return keyed.dedupe_last(_events(spark, sf), ["user_id"], version="ts")


@query
def duplicate_report(spark, sf):
    return keyed.duplicate_count(_events(spark, sf), ["user_id", "event_type"])


@query
def conform_schema(spark, sf):
    events = _events(spark, sf).select(
        F.col("event_id").alias("pickup_location_id"),
        F.col("event_type").alias("taxi_type"),
        F.col("value").alias("trip_count"),
        F.col("props").alias("avg_fare_amount"),
        F.col("user_id").alias("avg_trip_distance"),
    )
    return keyed.conform(events, DATASETS["zone_anomaly_stats"])


@query
def nan_to_null(spark, sf):
    value = F.when(F.col("user_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return keyed.nan_to_null(_events(spark, sf).select("event_id", value.alias("value")))


# -- the whole way --------------------------------------------------------------------------------


@query
def ingest_manifest(spark, sf):
    """Raw files through the batch ingest; what the manifest says of them."""
    store_dir = scratch(spark, "store")
    raw_dir = _raw_dir(spark, sf)
    ingest.run(spark, raw_dir, store_dir, AS_OF)
    return Store(spark, store_dir).log("manifest").select(
        "stage", "file_name", "taxi_type", "source_month", "status", "rows_in", "rows_kept"
    )


@query
def ingest_metrics(spark, sf):
    """Raw files through the batch ingest; the metrics it logs, but for times."""
    store_dir = scratch(spark, "store")
    ingest.run(spark, _raw_dir(spark, sf), store_dir, AS_OF)
    return _latest_without_times(Store(spark, store_dir))


def _latest_without_times(store: Store) -> DataFrame:
    latest = metrics.latest_metrics(store.log("run_metrics"))
    return latest.filter(~F.col("metric").rlike("seconds$|timestamp$")).select("job", "metric", "labels", "value", "text")


@query
def load_metrics(spark, sf):
    """Stored trips through a load; the metrics it logs, but for times."""
    store = Store(spark, scratch(spark, "store"))
    store.write_states(_states(spark, sf))
    ingest.refresh_datasets(store, TAXI_TYPES)
    load.load(spark, store.root)
    return _latest_without_times(store)


@query
def late_parts(spark, sf):
    """Sources that get more after they were processed: a part file, and a file of the same name elsewhere."""
    store_dir, raw_dir = scratch(spark, "store"), scratch(spark, "raw")
    third = F.minute("pickup_datetime") % 3
    for number, folder in enumerate((raw_dir, raw_dir, f"{raw_dir}/more")):
        fixtures.write_raw_files(_trips(spark, sf).filter(third == number), folder)
        if number != 1:
            ingest.run(spark, raw_dir, store_dir, AS_OF)
    return Store(spark, store_dir).dataset("daily_stats")


@query
def reprocessed_daily_stats(spark, sf):
    """Sources that lose every other day after they were processed and served."""
    store_dir, raw_dir = scratch(spark, "store"), scratch(spark, "raw")
    even = F.dayofmonth("pickup_datetime") % 2 == 0
    for trips in (_trips(spark, sf), _trips(spark, sf).filter(even)):
        fixtures.write_raw_files(trips, raw_dir, replace=True)
        ingest.run(spark, raw_dir, store_dir, AS_OF)
        load.load(spark, store_dir, only=[("daily_stats", t) for t in TAXI_TYPES])
    return Store(spark, store_dir).serving("daily_stats")


@query
def merged_daily_stats(spark, sf):
    """Sources that lose odd days and afternoons after they were served; upserted, so that lost days stay."""
    store_dir, raw_dir = scratch(spark, "store"), scratch(spark, "raw")
    left = (F.dayofmonth("pickup_datetime") % 2 == 0) & (F.hour("pickup_datetime") < 12)
    for trips in (_trips(spark, sf), _trips(spark, sf).filter(left)):
        fixtures.write_raw_files(trips, raw_dir, replace=True)
        ingest.run(spark, raw_dir, store_dir, AS_OF)
        load.load(spark, store_dir, only=[("daily_stats", t) for t in TAXI_TYPES], merge=True)
    return Store(spark, store_dir).serving("daily_stats")


@query
def served_daily_stats(spark, sf):
    """Raw files through ingest and load into the keyed serving table."""
    store_dir = scratch(spark, "store")
    ingest.run(spark, _raw_dir(spark, sf), store_dir, AS_OF)
    load.load(spark, store_dir, only=[("daily_stats", t) for t in TAXI_TYPES])
    return Store(spark, store_dir).serving("daily_stats")


# -- models ------------------------------------------------------------------------------------------


@query
def fare_training_set(spark, sf):
    return models.fare_training_set(agg.zone_hourly(_clean(spark, sf)))


@query
def fare_model_metrics(spark, sf):
    hourly = agg.zone_hourly(_clean(spark, sf))
    return models.train_fare(hourly).metrics_frame(spark)


def _split_report(rows: DataFrame, keys, label: str) -> DataFrame:
    part = F.when(models.in_training(keys), "train").otherwise("test").alias("part")
    return rows.groupBy(part).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col(label).cast("double")), 3).alias("label_sum")
    )


@query
def fare_split(spark, sf):
    """What the fare model learns from and is tested on."""
    return _split_report(
        models.fare_training_set(agg.zone_hourly(_clean(spark, sf))), PRIMARY_KEYS["zone_hourly"], "avg_fare"
    )


@query
def demand_split(spark, sf):
    """What the demand model learns from and is tested on."""
    return _split_report(_demand(spark, sf), PRIMARY_KEYS["zone_hourly"], "trip_count")


def _demand(spark: SparkSession, sf: str) -> DataFrame:
    return models.dense_demand(agg.zone_hourly(_clean(spark, sf)))


@query
def demand_grid(spark, sf):
    """Hours with and without trips, per day of each zone and type."""
    return _demand(spark, sf).groupBy("pickup_location_id", "taxi_type", "pickup_date").agg(
        F.count(F.lit(1)).alias("hours"),
        F.count_if(F.col("trip_count") == 0).alias("empty_hours"),
        F.sum("trip_count").alias("trip_count"),
    )


BACKTEST_ORIGINS = (dt.date(2023, 2, 10), dt.date(2023, 3, 1), dt.date(2023, 3, 20))


@query
def demand_backtest_baseline(spark, sf):
    """What each origin is fitted and tested on, and the forecast of the week before."""
    found = models.backtest_baseline(_demand(spark, sf), BACKTEST_ORIGINS)
    return found.withColumn("naive_rmse", F.round("naive_rmse", 6))


@query
def demand_backtest(spark, sf):
    """The demand model from several origins on."""
    return models.backtest_demand(_demand(spark, sf), BACKTEST_ORIGINS)


@query
def fare_model_checks(spark, sf):
    """The fare model's scaling, and that no other coefficients are better, on what it was fitted on."""
    hourly = written(agg.zone_hourly(_clean(spark, sf)), "hourly")
    training, _ = models.hash_split(models.fare_training_set(hourly), PRIMARY_KEYS["zone_hourly"])
    return _rounded_checks(models.regression_checks(training, "avg_fare", models.train_fare(hourly).model))


@query
def demand_model_checks(spark, sf):
    """The same of the demand model."""
    hourly = written(agg.zone_hourly(_clean(spark, sf)), "hourly")
    training, _ = models.hash_split(models.dense_demand(hourly), PRIMARY_KEYS["zone_hourly"])
    return _rounded_checks(models.regression_checks(training, "trip_count", models.train_demand(hourly).model))


def _rounded_checks(found: DataFrame) -> DataFrame:
    return found.withColumns({name: F.round(name, 6) for name in ("mean", "deviation")})


@query
def cluster_checks(spark, sf):
    """Trips in clusters; none of them is nearer to another centre."""
    fitted = models.train_clusters(_clean(spark, sf))
    placed = fitted.model.transform(_clean(spark, sf).dropna(subset=list(models.CLUSTER_FEATURES)))
    return models.cluster_checks(placed, models.vector_to_array("features"), fitted.model.stages[-1].clusterCenters())


@query
def tip_split(spark, sf):
    """What the tip model learns from and is tested on."""
    return _split_report(models.tip_training_set(_clean(spark, sf)), models.TIP_KEYS, "tipped")


@query
def cluster_input(spark, sf):
    """Trips that are clustered, and the scaling of their features."""
    trips = _clean(spark, sf).dropna(subset=list(models.CLUSTER_FEATURES))
    rows = trips.groupBy(*models.CLUSTER_FEATURES).agg(F.count(F.lit(1)).alias("weight"))
    found = models.cluster_moments(rows)
    total = rows.agg(F.sum("weight")).first()[0]
    named = [(name, total, round(mean, 6), round(deviation, 6)) for name, (mean, deviation) in found.items()]
    return spark.createDataFrame(named, "feature string, rows bigint, mean double, deviation double")


@query
def model_status(spark, sf):
    """The fare model trained on the stored hourly table; what the log says, but for errors and times."""
    store = Store(spark, scratch(spark, "store"))
    store.write_states(_states(spark, sf))
    ingest.refresh_datasets(store, TAXI_TYPES)
    models.train_fare_in_store(store, scratch(spark, "model-fare"))
    return _latest_without_times(store).filter(F.col("metric").isin("status", "training_rows", "test_rows"))


@query
def fare_scores(spark, sf):
    """The saved and reloaded fare model, asked for each zone and hour of all types."""
    from pyspark.ml import PipelineModel

    hourly = agg.zone_hourly(_clean(spark, sf))
    path = scratch(spark, "model-fare")
    models.train_fare(hourly, path)
    requests = hourly.select(*models.ZONE_FEATURES, "taxi_type").distinct()
    return models.score(PipelineModel.load(path), requests)


@query
def demand_forecast(spark, sf):
    hourly = agg.zone_hourly(_clean(spark, sf))
    return models.train_demand(hourly).metrics_frame(spark)


@query
def demand_vs_actual(spark, sf):
    hourly = written(agg.zone_hourly(_clean(spark, sf)), "hourly")
    forecast = models.score(models.train_demand(hourly).model, models.dense_demand(hourly))
    return serving.demand_vs_actual(forecast)


@query
def demand_actuals(spark, sf):
    """Trips and hours per zone, as compared with the forecast."""
    return demand_vs_actual(spark, sf).select("pickup_location_id", "actual_trips", "hours")


@query
def tip_training_set(spark, sf):
    columns = ["fare_amount", *models.ZONE_FEATURES, "payment_type", "taxi_type", "tipped"]
    return models.tip_training_set(_clean(spark, sf)).select(*columns)


@query
def tip_classifier(spark, sf):
    return models.train_tip(_clean(spark, sf)).metrics_frame(spark)


@query
def trip_clusters(spark, sf):
    flagged = models.cluster_trips(_clean(spark, sf))
    return flagged.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("trip_count"), F.count_if("is_anomaly").alias("anomaly_count")
    )


@query
def zscore_anomalies(spark, sf):
    return serving.anomalies_by_zone(_flagged(spark, sf))


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    trips = _clean(spark, sf)
    stats = written(agg.zone_anomaly_stats(trips), "zone-stats")
    return models.zscore_flags(trips, stats, ZSCORE_THRESHOLD)


@query
def zscore_drilldown(spark, sf):
    flagged = _flagged(spark, sf)
    return serving.anomalies_in_zone(flagged, CHECKED_ZONES[0]).select(
        *TRIP_SCHEMA.fieldNames(), *[F.round(c, 4).alias(c) for c in flagged.columns if c.startswith("z_")]
    )


def _flagged_store(spark: SparkSession, sf: str) -> Store:
    """Raw files through ingest, and their trips flagged by two runs of the stream."""
    store, checkpoint = Store(spark, scratch(spark, "store")), scratch(spark, "flag-checkpoint")
    ingest.run(spark, _raw_dir(spark, sf), store.root, AS_OF)
    for _ in range(2):
        run_flag_stream(spark, store.root, checkpoint, AS_OF, ZSCORE_THRESHOLD).awaitTermination()
    return store


@query
def stored_anomalies(spark, sf):
    """Stored flagged trips per zone and type."""
    flagged = _flagged_store(spark, sf).flagged()
    return flagged.groupBy("pickup_location_id", "taxi_type").agg(F.count(F.lit(1)).alias("anomaly_count"))


@query
def stored_drilldown(spark, sf):
    """Stored flagged trips of some types, a month and a zone."""
    flagged = _flagged_store(spark, sf).flagged(["yellow", "fhvhv"], [FEB])
    flagged = flagged.filter(F.col("pickup_location_id") == CHECKED_ZONES[0])
    return flagged.select(
        *TRIP_SCHEMA.fieldNames(), *[F.round(c, 4).alias(c) for c in flagged.columns if c.startswith("z_")]
    )


# -- serving ---------------------------------------------------------------------------------------------


@query
def zone_stats_lookup(spark, sf):
    hourly = agg.zone_hourly(_clean(spark, sf))
    return serving.zone_stats(
        hourly, CHECKED_ZONES, dt.date(2023, 1, 10), dt.date(2023, 2, 20), ["yellow", "green"]
    )


@query
def kpi_daily(spark, sf):
    return serving.kpi_daily(_states(spark, sf))


@query
def zone_heatmap(spark, sf):
    return serving.heatmap_topk(agg.zone_time_buckets(_clean(spark, sf)))


@query
def zone_heatmap_topk(spark, sf):
    return serving.heatmap_topk(agg.zone_time_buckets(_clean(spark, sf)), k=10)


@query
def hotspot_profiles(spark, sf):
    return serving.hotspot_profiles(agg.zone_time_buckets(_clean(spark, sf)))


@query
def hotspot_clusters(spark, sf):
    return serving.hotspots(agg.zone_time_buckets(_clean(spark, sf)))


@query
def hotspot_checks(spark, sf):
    """Zones in hotspot clusters; none of them is nearer to another centre."""
    profiles = written(serving.hotspot_profiles(agg.zone_time_buckets(_clean(spark, sf))), "hotspots")
    fitted = serving.fit_hotspots(profiles)
    centres = fitted.stages[-1].clusterCenters()
    return models.cluster_checks(fitted.transform(profiles), models.vector_to_array("features"), centres)


@query
def hotspot_choice(spark, sf):
    """Numbers of hotspot clusters by their silhouette."""
    return serving.hotspot_choices(agg.zone_time_buckets(_clean(spark, sf)))


@query
def latest_metrics(spark, sf):
    names = F.array(F.lit("rmse"), F.lit("mae"), F.lit("training_rows"))
    log = _events(spark, sf).select(
        F.col("event_type").alias("job"),
        F.element_at(names, (F.col("user_id") % 3 + 1).cast("int")).alias("metric"),
        F.create_map(F.lit("shard"), (F.col("user_id") % 4).cast("string")).alias("labels"),
        F.col("value"),
        F.lit(None).cast("string").alias("text"),
        F.col("ts"),
    )
    return metrics.latest_metrics(log).select("job", "metric", "labels", "ts", "value", "band")
