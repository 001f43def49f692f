"""Time features of a trip, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.schema import NIGHT, TIME_BUCKETS, WEEKEND_DAYS


def duration_minutes() -> Column:
    """Minutes between pickup and dropoff, from whole seconds.

    ``unix_timestamp`` reads a timestamp without time zone as it stands, so the
    result does not depend on the session time zone.
    """
    seconds = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    return seconds / F.lit(60.0)


def time_bucket(hour: Column) -> Column:
    """Time of day of an hour 0-23."""
    named = [F.when(hour.between(first, last), bucket) for bucket, (first, last) in TIME_BUCKETS.items()]
    return F.coalesce(*named, F.lit(NIGHT))


def calendar_columns(date: Column) -> dict[str, Column]:
    """The columns of the hourly table that follow from the pickup date."""
    return {
        "pickup_year": F.year(date),
        "pickup_month": F.month(date),
        "pickup_dow": F.dayofweek(date),
    }


def with_time_features(trips: DataFrame) -> DataFrame:
    """Add duration, date parts, weekend flag and time of day."""
    pickup = F.col("pickup_datetime")
    hour = F.hour(pickup)
    return trips.withColumns(
        {
            "trip_duration_minutes": duration_minutes(),
            "pickup_hour": hour,
            "pickup_date": F.to_date(pickup),
            "is_weekend": F.dayofweek(pickup).isin(*WEEKEND_DAYS),
            "time_bucket": time_bucket(hour),
            **calendar_columns(pickup),
        }
    )
