from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kerbside.schema import TRIP_SCHEMA  # noqa: E402
from kerbside.workspace import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


BASE = {
    "pickup_datetime": dt.datetime(2023, 1, 10, 9, 0, 0),
    "dropoff_datetime": dt.datetime(2023, 1, 10, 9, 20, 0),
    "pickup_location_id": 7,
    "dropoff_location_id": 8,
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "fare_amount": 12.5,
    "tip_amount": 1.0,
    "total_amount": 15.0,
    "payment_type": 1,
    "rate_code": 1.0,
    "taxi_type": "yellow",
    "source_file": "yellow_tripdata_2023-01.parquet",
    "source_month": dt.date(2023, 1, 1),
}


@pytest.fixture(scope="session")
def trips(spark):
    """Builds a frame of unified trips from changes to one plain trip."""

    def build(*changes: dict):
        fields = [f"{f.name} {f.dataType.simpleString()}" for f in TRIP_SCHEMA.fields]
        schema = ", ".join([*fields, "source_file string", "source_month date"])
        rows = [tuple({**BASE, **change}[name] for name in BASE) for change in changes]
        return spark.createDataFrame(rows, schema)

    return build
