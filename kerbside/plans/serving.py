"""The queries that dashboards and clients ask."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.moments import TRIPS, mean, total
from kerbside.operators.aggregates import combine
from kerbside.schema import NIGHT, SPLIT_SEED, TIME_BUCKETS
from kerbside.workspace import written

BUCKETS = (*TIME_BUCKETS, NIGHT)


def zone_stats(
    zone_hourly: DataFrame,
    zones: Sequence[int] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Hourly rows of some zones, days (``start`` to ``end``, inclusive) and types."""
    rows = zone_hourly
    if types is not None:
        rows = rows.filter(F.col("taxi_type").isin(*types))
    if start is not None:
        rows = rows.filter(F.col("pickup_date") >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("pickup_date") <= F.lit(end))
    if zones is not None:
        rows = rows.filter(F.col("pickup_location_id").isin(*zones))
    return rows


def kpi_daily(states: DataFrame) -> DataFrame:
    """Trips, revenue and average fare per day over all types.

    The average is that over trips with a fare, from the states: an average of the
    types' averages would weigh small types too much.
    """
    return combine(states, ["pickup_date"]).select(
        "pickup_date",
        F.col(TRIPS).alias("trip_count"),
        total("fare").alias("total_revenue"),
        mean("fare").alias("avg_fare"),
    )


def heatmap_topk(zone_time_buckets: DataFrame, k: int | None = None) -> DataFrame:
    """Trips per pickup zone; with ``k``, the k busiest (lower zone first on a tie)."""
    zones = zone_time_buckets.groupBy("pickup_location_id").agg(F.sum("trip_count").alias("trip_count"))
    if k is None:
        return zones
    return zones.orderBy(F.desc("trip_count"), "pickup_location_id").limit(k)


def anomalies_by_zone(flagged: DataFrame) -> DataFrame:
    """Trips and flagged trips per zone and type."""
    return flagged.groupBy("pickup_location_id", "taxi_type").agg(
        F.count(F.lit(1)).alias("trip_count"), F.count_if("is_anomaly").alias("anomaly_count")
    )


def anomalies_in_zone(flagged: DataFrame, zone: int) -> DataFrame:
    """The flagged trips of one zone."""
    return flagged.filter((F.col("pickup_location_id") == zone) & F.col("is_anomaly"))


def demand_vs_actual(forecast: DataFrame) -> DataFrame:
    """Predicted and actual trips per zone, of hourly rows with both."""
    return forecast.groupBy("pickup_location_id").agg(
        F.sum("trip_count").alias("actual_trips"),
        F.sum("prediction").alias("predicted_trips"),
        F.count(F.lit(1)).alias("hours"),
    )


def hotspot_profiles(zone_time_buckets: DataFrame) -> DataFrame:
    """Trips per zone and the share of each time of day in them."""
    counts = (
        zone_time_buckets.groupBy("pickup_location_id")
        .pivot("time_bucket", list(BUCKETS))
        .agg(F.sum("trip_count"))
        .fillna(0, list(BUCKETS))
    )
    trips = sum((F.col(bucket) for bucket in BUCKETS[1:]), F.col(BUCKETS[0]))
    shares = [(F.col(bucket) / F.col("trip_count")).alias(f"{bucket}_share") for bucket in BUCKETS]
    return counts.withColumn("trip_count", trips).select("pickup_location_id", "trip_count", *shares)


def hotspots(zone_time_buckets: DataFrame, k: int = 4, seed: int = SPLIT_SEED) -> DataFrame:
    """Zones clustered by their profile over the day."""
    # One row per zone, for the fit and for its use.
    profiles = written(hotspot_profiles(zone_time_buckets), "hotspots")
    return fit_hotspots(profiles, k, seed).transform(profiles).drop("features")


def fit_hotspots(profiles: DataFrame, k: int = 4, seed: int = SPLIT_SEED) -> PipelineModel:
    """Clusters of ``hotspot_profiles``."""
    inputs = [f"{bucket}_share" for bucket in BUCKETS]
    stages = [
        VectorAssembler(inputCols=inputs, outputCol="features"),
        KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed),
    ]
    return Pipeline(stages=stages).fit(profiles)


def hotspot_choices(
    zone_time_buckets: DataFrame, candidates: Sequence[int] = range(2, 9), seed: int = SPLIT_SEED
) -> DataFrame:
    """Candidate numbers of hotspot clusters with their silhouette (squared distances); the
    best is chosen, of equal ones the smallest.

    Numbers that the zones cannot fill, because too few of them differ, have no silhouette;
    where none has one, none is chosen.
    """
    profiles = written(hotspot_profiles(zone_time_buckets), "hotspots")
    inputs = [f"{bucket}_share" for bucket in BUCKETS]
    different = profiles.select(*inputs).distinct().count()
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette")
    scores: list[tuple[int, float | None]] = []
    for k in sorted(set(candidates)):
        placed = fit_hotspots(profiles, k, seed).transform(profiles) if 2 <= k <= different else None
        filled = placed is not None and placed.select("cluster").distinct().count() > 1
        scores.append((k, evaluator.evaluate(placed) if filled else None))
    best = max((score for _, score in scores if score is not None), default=None)
    chosen = next((k for k, score in scores if score is not None and score == best), None)
    rows = [(k, score, k == chosen) for k, score in scores]
    return profiles.sparkSession.createDataFrame(rows, "k int, silhouette double, chosen boolean")
