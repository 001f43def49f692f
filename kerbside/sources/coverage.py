"""Which months are there, and how the last ingest went."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.schema import INGEST_OUTCOMES, PUBLICATION_LAG_MONTHS, TAXI_TYPES


def coverage(
    files: DataFrame, start: dt.date, as_of: dt.date, types: Sequence[str] = TAXI_TYPES
) -> DataFrame:
    """Each expected (type, month) as PRESENT, CORRUPT or MISSING.

    Months run from ``start`` to the last month published by ``as_of``.
    """
    first = F.trunc(F.lit(start), "MM")
    last = F.add_months(F.trunc(F.lit(as_of), "MM"), -PUBLICATION_LAG_MONTHS)
    months = F.sequence(first, F.greatest(first, last), F.expr("INTERVAL 1 MONTH"))
    grid = (
        files.sparkSession.range(1)
        .select(F.explode(months).alias("month"))
        .filter(F.col("month") <= last)
        .select(F.explode(F.array(*map(F.lit, types))).alias("taxi_type"), "month")
    )
    found = (
        files.filter(F.col("source_month").isNotNull())
        .groupBy("taxi_type", "source_month")
        .agg(F.bool_and("is_valid").alias("is_valid"))
        .withColumnRenamed("source_month", "month")
    )
    status = (
        F.when(F.col("is_valid").isNull(), "MISSING").when(F.col("is_valid"), "PRESENT").otherwise("CORRUPT")
    )
    return grid.join(found, ["taxi_type", "month"], "left").select(
        "taxi_type", "month", _file_name().alias("file_name"), status.alias("status")
    )


def _file_name():
    month = F.date_format("month", "yyyy-MM")
    return F.concat("taxi_type", F.lit("_tripdata_"), month, F.lit(".parquet"))


def outcome_rollup(log: DataFrame, already_present: int = 0) -> DataFrame:
    """Files and seconds per ingest outcome; an outcome that did not occur counts 0.

    ``already_present`` is the number of files that needed no attempt at all.
    """
    spark = log.sparkSession
    domain = [(o, already_present if o == "ALREADY_EXISTS" else 0, 0.0) for o in INGEST_OUTCOMES]
    attempts = log.filter(F.col("outcome").isin(*INGEST_OUTCOMES)).select(
        "outcome", F.lit(1).cast("bigint").alias("files"), "seconds"
    )
    base = spark.createDataFrame(domain, "outcome string, files bigint, seconds double")
    return attempts.union(base).groupBy("outcome").agg(
        F.sum("files").alias("files"), F.sum("seconds").alias("seconds")
    )
