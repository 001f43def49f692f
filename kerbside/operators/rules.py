"""Validation and cleaning rules, their application and their accounting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.clock import with_time_features
from kerbside.schema import (
    MAX_DISTANCE,
    MAX_DURATION_MINUTES,
    MAX_FARE,
    METERED_TYPES,
    MIN_YEAR,
)

RULE_NAMES = ("month", "required", "year", "duration", "distance", "fare")


def _year_start(year: int) -> Column:
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def in_source_month() -> Column:
    """Pickup lies in the month that the source's name carries; true if it carries none.

    The month is compared as a half-open range; a missing pickup time is in no month.
    """
    month, pickup = F.col("source_month"), F.col("pickup_datetime")
    start, end = (day.cast("timestamp_ntz") for day in (month, F.add_months(month, 1)))
    return month.isNull() | F.coalesce((pickup >= start) & (pickup < end), F.lit(False))


def month_range(month: dt.date) -> Column:
    """Pickup lies in the given month; the bounds are constants, so that they reach the files."""
    after = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    pickup = F.col("pickup_datetime")
    start, end = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in (month, after))
    return (pickup >= start) & (pickup < end)


def _required() -> Column:
    return (
        F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & F.col("pickup_location_id").isNotNull()
        & F.col("dropoff_location_id").isNotNull()
    )


def _in_years(min_year: int, as_of_year: int | None) -> Column:
    last = as_of_year if as_of_year is not None else dt.date.today().year
    pickup = F.col("pickup_datetime")
    return (pickup >= _year_start(min_year)) & (pickup < _year_start(last + 1))


def _duration_in_range() -> Column:
    minutes = F.col("trip_duration_minutes")
    return (minutes > 0) & (minutes < MAX_DURATION_MINUTES)


def _metered_in_range(column: str, upper: float) -> Column:
    """Range rule for types that carry the column; there a NULL fails, elsewhere all pass."""
    value = F.col(column)
    return ~F.col("taxi_type").isin(*METERED_TYPES) | ((value >= 0) & (value < upper))


def cleaning_rules(min_year: int = MIN_YEAR, as_of_year: int | None = None) -> dict[str, Column]:
    """The row rules after month validation, in order, for frames with time features."""
    return {
        "required": _required(),
        "year": _in_years(min_year, as_of_year),
        "duration": _duration_in_range(),
        "distance": _metered_in_range("trip_distance", MAX_DISTANCE),
        "fare": _metered_in_range("fare_amount", MAX_FARE),
    }


def validate_month(trips: DataFrame) -> DataFrame:
    """Keep trips whose pickup lies in their source's month."""
    return trips.filter(in_source_month())


def clean(trips: DataFrame, min_year: int = MIN_YEAR, as_of_year: int | None = None) -> DataFrame:
    """Apply the cleaning rules and add the time features.

    The rules on raw columns are plain comparisons with constants; Catalyst
    moves them below the features and into the Parquet scan.
    """
    featured = with_time_features(trips)
    for rule in cleaning_rules(min_year, as_of_year).values():
        featured = featured.filter(rule)
    return featured


def rejected_by(min_year: int = MIN_YEAR, as_of_year: int | None = None) -> Column:
    """Name of the first rule that a trip fails; NULL if it passes all."""
    rules = {"month": in_source_month(), **cleaning_rules(min_year, as_of_year)}
    return F.coalesce(*[F.when(~F.coalesce(rules[name], F.lit(False)), name) for name in RULE_NAMES])


def cleaning_report(
    trips: DataFrame, min_year: int = MIN_YEAR, as_of_year: int | None = None
) -> DataFrame:
    """Rows in, rows rejected by each rule and rows kept, per taxi type, in one pass."""
    judged = with_time_features(trips).select(
        "taxi_type", rejected_by(min_year, as_of_year).alias("rejected_by")
    )
    verdict = F.col("rejected_by")
    return judged.groupBy("taxi_type").agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(verdict == name).alias(f"rejected_{name}") for name in RULE_NAMES],
        F.count_if(verdict.isNull()).alias("rows_kept"),
    )
