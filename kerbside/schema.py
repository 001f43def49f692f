"""The data model: trip schema, output tables, bookkeeping tables and the fixed values of the rules."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They decide which rows survive and how results are labelled,
# so they are stated here once and nowhere else.
# ---------------------------------------------------------------------------

TAXI_TYPES = ("yellow", "green", "fhv", "fhvhv")

# Unified column -> raw column, per taxi type.
RAW_COLUMNS = {
    "yellow": {
        "pickup_datetime": "tpep_pickup_datetime",
        "dropoff_datetime": "tpep_dropoff_datetime",
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
        "passenger_count": "passenger_count",
        "trip_distance": "trip_distance",
        "fare_amount": "fare_amount",
        "tip_amount": "tip_amount",
        "total_amount": "total_amount",
        "payment_type": "payment_type",
        "rate_code": "RatecodeID",
    },
    "green": {
        "pickup_datetime": "lpep_pickup_datetime",
        "dropoff_datetime": "lpep_dropoff_datetime",
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
        "passenger_count": "passenger_count",
        "trip_distance": "trip_distance",
        "fare_amount": "fare_amount",
        "tip_amount": "tip_amount",
        "total_amount": "total_amount",
        "payment_type": "payment_type",
        "rate_code": "RatecodeID",
    },
    "fhv": {
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "dropOff_datetime",
        "pickup_location_id": "PUlocationID",
        "dropoff_location_id": "DOlocationID",
    },
    "fhvhv": {
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "dropoff_datetime",
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
        "trip_distance": "trip_miles",
        "fare_amount": "base_passenger_fare",
        "tip_amount": "tips",
        "total_amount": "driver_pay",
    },
}

# File names: {taxi_type}_tripdata_{YYYY}-{MM}.parquet. The longest type comes
# first in the pattern, so that fhvhv files are not taken for fhv files.
TYPE_PATTERN = r"^(fhvhv|fhv|yellow|green)"
MONTH_PATTERN = r"_(\d{4})-(\d{2})\.parquet$"
PARQUET_MAGIC = b"PAR1"

# Cleaning bounds.
MIN_YEAR = 2019
MAX_DURATION_MINUTES = 300  # exclusive, as is the lower bound 0
MAX_DISTANCE = 200  # exclusive; the lower bound 0 is inclusive
MAX_FARE = 1000  # exclusive; the lower bound 0 is inclusive

# Types whose trips carry a distance and a fare (range rules apply, NULL fails).
METERED_TYPES = ("yellow", "green", "fhvhv")

# First and last hour of each time of day; all other hours are night.
TIME_BUCKETS = {"morning": (6, 11), "afternoon": (12, 17), "evening": (18, 22)}
NIGHT = "night"
WEEKEND_DAYS = (1, 7)  # Sunday and Saturday in the 1 = Sunday numbering

# A month is expected to be published this many months later.
PUBLICATION_LAG_MONTHS = 3

INGEST_OUTCOMES = (
    "ALREADY_EXISTS",
    "DOWNLOADED",
    "NOT_FOUND",
    "ACCESS_DENIED",
    "UNAVAILABLE",
    "CHECK_FAILED",
    "DOWNLOAD_FAILED",
)

# Fare model.
FARE_TYPES = ("yellow", "green")
MAX_LABEL_FARE = 200  # exclusive, as is the lower bound 0
REGRESSION = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.5}
TRAIN_SHARE = 0.8
SPLIT_SEED = 42

# Upper ends of the green and the orange band of a model metric.
METRIC_BANDS = {"rmse": (5.0, 10.0), "mae": (3.0, 7.0)}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------


_LONG, _INT, _DOUBLE, _STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_DATE, _TIME, _INSTANT = T.DateType(), T.TimestampNTZType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRIP_SCHEMA = _struct(
    pickup_datetime=_TIME,
    dropoff_datetime=_TIME,
    pickup_location_id=_LONG,
    dropoff_location_id=_LONG,
    passenger_count=_DOUBLE,
    trip_distance=_DOUBLE,
    fare_amount=_DOUBLE,
    tip_amount=_DOUBLE,
    total_amount=_DOUBLE,
    payment_type=_LONG,
    rate_code=_DOUBLE,
    taxi_type=_STRING,
)

# What is held against the statistics of its zone.
SCORED = ("fare_amount", "trip_duration_minutes", "trip_distance")

DATASETS = {
    "zone_hourly": _struct(
        pickup_year=_INT,
        pickup_month=_INT,
        pickup_date=_DATE,
        pickup_dow=_INT,
        pickup_hour=_INT,
        pickup_location_id=_LONG,
        taxi_type=_STRING,
        trip_count=_LONG,
        avg_duration_minutes=_DOUBLE,
        avg_distance=_DOUBLE,
        avg_fare=_DOUBLE,
        avg_total=_DOUBLE,
    ),
    "daily_stats": _struct(
        pickup_date=_DATE,
        taxi_type=_STRING,
        trip_count=_LONG,
        avg_duration_minutes=_DOUBLE,
        total_passengers=_LONG,
        avg_fare=_DOUBLE,
        total_revenue=_DOUBLE,
    ),
    "zone_time_buckets": _struct(
        pickup_location_id=_LONG,
        time_bucket=_STRING,
        taxi_type=_STRING,
        trip_count=_LONG,
    ),
    "zone_anomaly_stats": _struct(
        pickup_location_id=_LONG,
        taxi_type=_STRING,
        trip_count=_LONG,
        avg_fare_amount=_DOUBLE,
        stddev_fare_amount=_DOUBLE,
        avg_trip_duration_minutes=_DOUBLE,
        stddev_trip_duration_minutes=_DOUBLE,
        avg_trip_distance=_DOUBLE,
        stddev_trip_distance=_DOUBLE,
    ),
}

PRIMARY_KEYS = {
    "zone_hourly": ("pickup_date", "pickup_hour", "pickup_location_id", "taxi_type"),
    "daily_stats": ("pickup_date", "taxi_type"),
    "zone_time_buckets": ("pickup_location_id", "time_bucket", "taxi_type"),
    "zone_anomaly_stats": ("pickup_location_id", "taxi_type"),
}

# Bookkeeping tables are append-only logs; the newest row of a key is in force.
MANIFEST = _struct(
    stage=_STRING,
    file_name=_STRING,
    taxi_type=_STRING,
    source_month=_DATE,
    length=_LONG,
    status=_STRING,
    rows_in=_LONG,
    rows_kept=_LONG,
    committed_at=_INSTANT,
    source_folder=_STRING,
    parts=_LONG,
    newest=_INSTANT,
)
LOAD_LOG = _struct(
    dataset=_STRING,
    taxi_type=_STRING,
    last_mtime=_INSTANT,
    rows=_LONG,
    status=_STRING,
    loaded_at=_INSTANT,
)
SERVING_LOG = _struct(dataset=_STRING, taxi_type=_STRING, version=_LONG, rows=_LONG, committed_at=_INSTANT)
MODEL_LOG = _struct(job=_STRING, version=_LONG, path=_STRING, committed_at=_INSTANT)
RUN_METRICS = _struct(
    job=_STRING,
    metric=_STRING,
    labels=T.MapType(_STRING, _STRING),
    value=_DOUBLE,
    text=_STRING,
    ts=_INSTANT,
)
