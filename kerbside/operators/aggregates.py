"""The four aggregates, from clean trips or from stored states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.clock import calendar_columns, time_bucket, with_time_features
from kerbside.functions.moments import (
    TRIPS,
    deviation,
    is_state,
    mean,
    merge,
    summarise,
    total,
)
from kerbside.operators.rules import rejected_by
from kerbside.schema import DATASETS, MIN_YEAR

SOURCE_KEYS = ["taxi_type", "source_file", "source_month"]
FINE_KEYS = ["pickup_date", "pickup_hour", "pickup_location_id"]


def partials(trips: DataFrame, min_year: int = MIN_YEAR, as_of_year: int | None = None) -> DataFrame:
    """States per source, date, hour and zone, and the row accounting per source.

    This is the only shuffle over trips: all four aggregates roll up from it. A
    rejected trip joins the group of its source and rule (date, hour and zone
    NULL), so that what was dropped, and why, is stored with what was kept.
    """
    judged = with_time_features(trips).withColumn("rejected_by", rejected_by(min_year, as_of_year))
    kept = F.col("rejected_by").isNull()
    keyed = judged.withColumns({key: F.when(kept, F.col(key)) for key in FINE_KEYS})
    return summarise(keyed, [*source_keys(trips), "rejected_by", *FINE_KEYS], counted=kept)


def source_keys(frame: DataFrame) -> list[str]:
    """What tells sources apart: their name and, where files lie in folders, the folder."""
    return [*SOURCE_KEYS, *(["folder_id"] if "folder_id" in frame.columns else [])]


def monthly(states: DataFrame) -> DataFrame:
    """States per month, zone and hour of day: what the aggregates without a date roll up from."""
    month = F.date_format("pickup_date", "yyyy-MM")
    keys = ["taxi_type", "month", "pickup_location_id", "pickup_hour"]
    return combine(states.withColumn("month", month), keys, spread=True)


def kept(states: DataFrame) -> DataFrame:
    """The states of kept trips."""
    return states.filter(F.col("rejected_by").isNull()) if "rejected_by" in states.columns else states


def combine(states: DataFrame, keys: list[str], spread: bool = False) -> DataFrame:
    """States of kept trips by ``keys``: equal to building them from all trips at once."""
    return merge(kept(states), keys, spread)


def _rollup(df: DataFrame, keys: list[str], spread: bool = False) -> DataFrame:
    return combine(df, keys, spread) if is_state(df) else summarise(df, keys)


def zone_hourly(df: DataFrame) -> DataFrame:
    """Trips and averages per date, hour, zone and type."""
    rolled = _rollup(df, ["pickup_date", "pickup_hour", "pickup_location_id", "taxi_type"])
    return rolled.withColumns(calendar_columns(F.col("pickup_date"))).select(
        *_key_columns("zone_hourly"),
        F.col(TRIPS).alias("trip_count"),
        mean("duration").alias("avg_duration_minutes"),
        mean("distance").alias("avg_distance"),
        mean("fare").alias("avg_fare"),
        mean("total").alias("avg_total"),
    )


def daily_stats(df: DataFrame) -> DataFrame:
    """Daily totals per type; revenue is the sum of fares."""
    return _rollup(df, ["pickup_date", "taxi_type"]).select(
        *_key_columns("daily_stats"),
        F.col(TRIPS).alias("trip_count"),
        mean("duration").alias("avg_duration_minutes"),
        F.rint(total("passengers")).try_cast("bigint").alias("total_passengers"),
        mean("fare").alias("avg_fare"),
        total("fare").alias("total_revenue"),
    )


def zone_time_buckets(df: DataFrame) -> DataFrame:
    """Trips per zone, time of day and type."""
    if is_state(df):
        df = df.withColumn("time_bucket", time_bucket(F.col("pickup_hour")))
    rolled = _rollup(df, ["pickup_location_id", "time_bucket", "taxi_type"])
    return rolled.select(*_key_columns("zone_time_buckets"), F.col(TRIPS).alias("trip_count"))


def zone_anomaly_stats(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of fare, duration and distance per zone and type."""
    columns = {
        "fare_amount": "fare",
        "trip_duration_minutes": "duration",
        "trip_distance": "distance",
    }
    moments = [
        value.alias(f"{kind}_{column}")
        for column, name in columns.items()
        for kind, value in (("avg", mean(name)), ("stddev", deviation(name)))
    ]
    rolled = _rollup(df, ["pickup_location_id", "taxi_type"], spread=True)
    return rolled.select(*_key_columns("zone_anomaly_stats"), F.col(TRIPS).alias("trip_count"), *moments)


def _key_columns(dataset: str) -> list[str]:
    names = DATASETS[dataset].fieldNames()
    return names[: names.index("trip_count")]


AGGREGATES = {
    "zone_hourly": zone_hourly,
    "daily_stats": daily_stats,
    "zone_time_buckets": zone_time_buckets,
    "zone_anomaly_stats": zone_anomaly_stats,
}


def source_accounts(states: DataFrame) -> DataFrame:
    """Rows read and rows kept per source, from the stored states."""
    return states.groupBy(*source_keys(states)).agg(
        F.sum(TRIPS).alias("rows_in"),
        F.coalesce(F.sum(F.when(F.col("rejected_by").isNull(), F.col(TRIPS))), F.lit(0)).alias("rows_kept"),
    )
