"""Trips derived from the ``lineitem`` table, for the registered queries and the tests.

Integer arithmetic makes keys and times, so that every engine derives the same
trips: all four types, three file months and undated files, pickups in the wrong
month or before 2019, durations at and beyond the bounds, missing zones and
distances, distances and fares out of range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schema import RAW_COLUMNS, TAXI_TYPES

_TRIPS_SQL = """
WITH base AS (
  SELECT *,
    1672531200 + (l_orderkey % 90) * 86400 AS day_s,
    (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 131) % 86400
      - CASE WHEN l_partkey % 97 = 0 THEN 40 * 86400
             WHEN l_partkey % 211 = 0 THEN 2200 * 86400 ELSE 0 END AS off_s,
    (l_partkey * 37 + l_orderkey * 11) % 19000 - 300 AS dur_s,
    CASE WHEN l_orderkey % 50 = 0 THEN 'undated'
         WHEN l_orderkey % 90 < 31 THEN '2023-01'
         WHEN l_orderkey % 90 < 59 THEN '2023-02' ELSE '2023-03' END AS file_month
  FROM {lineitem}),
timed AS (
  SELECT *, {pickup} AS pickup_datetime, {dropoff} AS dropoff_datetime,
    CASE l_partkey % 4 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' WHEN 2 THEN 'fhv' ELSE 'fhvhv' END AS taxi_type
  FROM base)
SELECT
  taxi_type,
  taxi_type || '_tripdata_' || file_month || '.parquet' AS source_file,
  CASE file_month WHEN '2023-01' THEN DATE '2023-01-01' WHEN '2023-02' THEN DATE '2023-02-01'
                  WHEN '2023-03' THEN DATE '2023-03-01' END AS source_month,
  pickup_datetime,
  dropoff_datetime,
  NULLIF(l_suppkey % 60, 59) AS pickup_location_id,
  NULLIF((l_suppkey * 7 + l_linenumber) % 60, 58) AS dropoff_location_id,
  CASE WHEN l_partkey % 4 < 2 THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count,
  CASE WHEN l_partkey % 4 <> 2 AND l_linenumber <> 7 THEN l_quantity * CAST(4.1 AS DOUBLE) END AS trip_distance,
  CASE WHEN l_partkey % 4 <> 2 THEN l_extendedprice / CAST(100 AS DOUBLE) END AS fare_amount,
  CASE WHEN l_partkey % 4 <> 2 THEN l_extendedprice / CAST(100 AS DOUBLE) * l_discount END AS tip_amount,
  CASE WHEN l_partkey % 4 <> 2
       THEN l_extendedprice / CAST(100 AS DOUBLE) * (CAST(1 AS DOUBLE) + l_discount) END AS total_amount,
  CASE WHEN l_partkey % 4 < 2 THEN l_orderkey % 5 + 1 END AS payment_type,
  CASE WHEN l_partkey % 4 < 2 THEN CAST(l_orderkey % 6 + 1 AS DOUBLE) END AS rate_code
FROM timed
"""


def _spark_time(seconds: str) -> str:
    return f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + INTERVAL '1' SECOND * ({seconds})"


def _duckdb_time(seconds: str) -> str:
    return f"make_timestamp(({seconds}) * 1000000)"


def _trips_sql(lineitem: str, time) -> str:
    return _TRIPS_SQL.format(
        lineitem=lineitem,
        pickup=time("day_s + off_s"),
        dropoff=time("day_s + off_s + dur_s"),
    )


def trips_sql_duckdb() -> str:
    """The adapter as DuckDB SQL over the registered ``lineitem`` view."""
    return _trips_sql("lineitem", _duckdb_time)


def trips_from(lineitem: DataFrame) -> DataFrame:
    """Unified trips with ``source_month`` and ``source_file``, before any cleaning.

    The observation counts the derived rows. It also keeps the optimizer from
    copying the arithmetic above into each later filter, which makes generated
    code too long for the JVM to compile. Trips read from files do not need it.
    """
    trips = lineitem.sparkSession.sql(_trips_sql("{lineitem}", _spark_time), lineitem=lineitem)
    return trips.observe("derived_trips", F.count(F.lit(1)).alias("rows"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from(lineitem(spark, sf_dir))


def raw_shape(unified: DataFrame, taxi_type: str) -> DataFrame:
    """Trips of one type under the raw column names of that type."""
    return unified.filter(F.col("taxi_type") == taxi_type).select(
        *[F.col(column).alias(source) for column, source in RAW_COLUMNS[taxi_type].items()],
        "source_file",
        "source_month",
    )


def write_raw_files(unified: DataFrame, raw_dir: str, replace: bool = False) -> None:
    """Write trips as raw sources, one directory of part files per type and month.

    ``replace`` writes the folder anew; else more part files are added to it.
    """
    for number, taxi_type in enumerate(TAXI_TYPES):
        raw = raw_shape(unified, taxi_type).drop("source_month")
        mode = "overwrite" if replace and number == 0 else "append"
        raw.hint("rebalance", "source_file").write.mode(mode).partitionBy("source_file").parquet(raw_dir)
