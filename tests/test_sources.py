import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frames import rows_of
from kerbside.functions import names
from kerbside.sources.coverage import coverage, outcome_rollup
from kerbside.sources.listing import check_files, raw_inventory
from kerbside.sources.processed import changed
from kerbside.sources.raw import scan_raw

T0 = dt.datetime(2023, 1, 5, 10)


def yellow_table(zone_type=pa.int64(), **changes):
    columns = {
        "tpep_pickup_datetime": pa.array([T0, T0]),
        "tpep_dropoff_datetime": pa.array([T0 + dt.timedelta(minutes=9)] * 2),
        "PULocationID": pa.array([1, 2]).cast(zone_type),
        "DOLocationID": pa.array([3, 4]),
        "passenger_count": pa.array([1.0, None]),
        "trip_distance": pa.array([1.5, 2.5]),
        "fare_amount": pa.array([10.0, 20.0]),
        "tip_amount": pa.array([0.0, 2.0]),
        "total_amount": pa.array([11.0, 23.0]),
        "payment_type": pa.array([1, 2]),
        "RatecodeID": pa.array([1.0, 1.0]),
        "extra_column": pa.array(["a", "b"]),
        **changes,
    }
    return pa.table({name: column for name, column in columns.items() if column is not None})


def test_names(spark):
    cases = {
        "/raw/fhvhv_tripdata_2023-01.parquet": ("fhvhv", dt.date(2023, 1, 1)),
        "/raw/fhv_tripdata_2023-01.parquet": ("fhv", dt.date(2023, 1, 1)),
        "/raw/yellow_tripdata_2024-12.parquet/part-0.snappy.parquet": ("yellow", dt.date(2024, 12, 1)),
        "/raw/source_file=green_tripdata_2024-12.parquet/part-0.parquet": ("green", dt.date(2024, 12, 1)),
        "/raw/green_extra.parquet": ("green", None),
        "/raw/notes.parquet": (None, None),
        "/raw/yellow_tripdata_2023-13.parquet": ("yellow", names.NO_SUCH_MONTH),
    }
    frame = spark.createDataFrame([(path,) for path in cases], "path string")
    name = names.source_file(F.col("path"))
    found = frame.select("path", names.taxi_type(name).alias("t"), names.source_month(name).alias("m"))
    assert {r.path: (r.t, r.m) for r in found.collect()} == cases


def test_integrity_and_inventory(spark, tmp_path):
    pq.write_table(yellow_table(), tmp_path / "yellow_tripdata_2023-01.parquet")
    (tmp_path / "yellow_tripdata_2023-02.parquet").write_bytes(b"PAR")
    (tmp_path / "green_tripdata_2023-01.parquet").write_bytes(b"PAR1" + bytes(40))
    (tmp_path / "green_tripdata_2023-02.parquet").write_bytes(b"PAR1" + bytes(40) + b"PAR1")
    pq.write_table(yellow_table(), tmp_path / "notes.parquet")
    files = check_files(spark, str(tmp_path))
    found = {r.file_name: (r.is_valid, r.row_count) for r in files.collect()}
    assert found == {
        "yellow_tripdata_2023-01.parquet": (True, 2),
        "yellow_tripdata_2023-02.parquet": (False, None),
        "green_tripdata_2023-01.parquet": (False, None),
        "green_tripdata_2023-02.parquet": (False, None),
        "notes.parquet": (True, 2),
    }
    inventory = {r.taxi_type: (r.files, r.bytes) for r in raw_inventory(files).collect()}
    size = (tmp_path / "yellow_tripdata_2023-01.parquet").stat().st_size
    assert inventory == {"yellow": (2, size + 3), "green": (2, 44 + 48), "ALL": (4, size + 3 + 44 + 48)}


def test_scan_reconciles_layouts(spark, tmp_path):
    """Whole against fractional zones, other casing, a missing column, a file per layout."""
    pq.write_table(yellow_table(), tmp_path / "yellow_tripdata_2023-01.parquet")
    pq.write_table(yellow_table(pa.float64()), tmp_path / "yellow_tripdata_2023-02.parquet")
    pq.write_table(
        yellow_table(PULocationID=None, pulocationid=pa.array([1, 2]), passenger_count=None),
        tmp_path / "yellow odd+name%20_2023-03.parquet",
    )
    pq.write_table(yellow_table(pa.int32()), tmp_path / "yellow_undated.parquet")
    pq.write_table(yellow_table(), tmp_path / "notes.parquet")
    (tmp_path / "yellow_tripdata_2023-04.parquet").write_bytes(b"broken")
    trips = scan_raw(spark, str(tmp_path))
    assert dict(trips.dtypes)["pickup_location_id"] == "bigint"
    found = {
        (r.source_file, r.source_month): (r.n, r.zones, r.passengers)
        for r in trips.groupBy("source_file", "source_month")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("pickup_location_id").alias("zones"),
            F.count("passenger_count").alias("passengers"),
        )
        .collect()
    }
    assert found == {
        ("yellow_tripdata_2023-01.parquet", dt.date(2023, 1, 1)): (2, 3, 1),
        ("yellow_tripdata_2023-02.parquet", dt.date(2023, 2, 1)): (2, 3, 1),
        ("yellow odd+name%20_2023-03.parquet", dt.date(2023, 3, 1)): (2, 3, 0),
        ("yellow_undated.parquet", None): (2, 3, 1),
    }


def test_scan_reads_mapped_columns_only_and_pushes_filters(spark, tmp_path):
    from kerbside.operators.rules import clean

    pq.write_table(yellow_table(), tmp_path / "yellow_tripdata_2023-01.parquet")
    frame = clean(scan_raw(spark, str(tmp_path)), as_of_year=2025).groupBy("pickup_location_id").count()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "extra_column" not in scan and "tip_amount" not in scan
    for pushed in ("IsNotNull(PULocationID)", "LessThan(fare_amount,1000.0)", "GreaterThanOrEqual(trip_distance,0.0)"):
        assert pushed in plan
    assert "Batched: true" in plan


def test_empty_folder(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert scan_raw(spark, str(tmp_path / "raw")).count() == 0


def test_coverage(spark):
    files = spark.createDataFrame(
        [
            ("yellow", dt.date(2023, 1, 1), True),
            ("yellow", dt.date(2023, 2, 1), True),
            ("yellow", dt.date(2023, 2, 1), False),
            ("green", None, True),
        ],
        "taxi_type string, source_month date, is_valid boolean",
    )
    found = coverage(files, dt.date(2023, 1, 15), dt.date(2023, 6, 30), ["yellow", "green"])
    assert {(r.taxi_type, r.month.month): r.status for r in found.collect()} == {
        ("yellow", 1): "PRESENT",
        ("yellow", 2): "CORRUPT",
        ("yellow", 3): "MISSING",
        ("green", 1): "MISSING",
        ("green", 2): "MISSING",
        ("green", 3): "MISSING",
    }
    assert coverage(files, dt.date(2023, 6, 1), dt.date(2023, 6, 30)).count() == 0


def test_outcomes(spark):
    log = spark.createDataFrame(
        [("DOWNLOADED", 1.5), ("DOWNLOADED", 2.0), ("NOT_FOUND", 0.5)], "outcome string, seconds double"
    )
    found = {r.outcome: (r.files, r.seconds) for r in outcome_rollup(log, 4).collect()}
    assert len(found) == 7
    assert found["DOWNLOADED"] == (2, 3.5)
    assert found["NOT_FOUND"] == (1, 0.5)
    assert found["ALREADY_EXISTS"] == (4, 0.0)
    assert found["UNAVAILABLE"] == (0, 0.0)


@pytest.mark.parametrize(
    "log, expected",
    [
        ([], True),
        ([("loaded", 10, 1)], False),
        ([("loaded", 9, 1)], True),
        ([("loaded", 10, 1), ("reset", None, 2)], True),
        ([("failed", None, 1), ("loaded", 10, 2)], False),
    ],
)
def test_changed(spark, log, expected):
    def at(minute):
        return None if minute is None else dt.datetime(2024, 1, 1, 0, minute)

    parts = spark.createDataFrame([("d", "yellow", at(10))], "dataset string, taxi_type string, mtime timestamp")
    rows = [("d", "yellow", at(mtime), status, at(when)) for status, mtime, when in log]
    schema = "dataset string, taxi_type string, last_mtime timestamp, status string, loaded_at timestamp"
    assert bool(rows_of(changed(parts, spark.createDataFrame(rows, schema)))) == expected


@pytest.mark.parametrize("root", ["raw", "part-of/raw"])
def test_scan_of_folders_and_files(spark, tmp_path, root):
    """Sources as folders of part files next to single files, also below a folder named like a part."""
    raw = tmp_path / root
    folder = raw / "yellow_tripdata_2023-01.parquet"
    folder.mkdir(parents=True)
    for number in range(3):
        pq.write_table(yellow_table(), folder / f"part-{number}.parquet")
    pq.write_table(yellow_table(pa.float64()), folder / "part-3.parquet")
    pq.write_table(yellow_table(), raw / "yellow_tripdata_2023-02.parquet")
    hive = raw / "part-hive" / "source_file=yellow_tripdata_2023-03.parquet"
    hive.mkdir(parents=True)
    pq.write_table(yellow_table(), hive / "part-0.parquet")
    found = scan_raw(spark, str(raw)).groupBy("source_file", "source_month").count().collect()
    assert {(r.source_file, r.source_month.month): r["count"] for r in found} == {
        ("yellow_tripdata_2023-01.parquet", 1): 8,
        ("yellow_tripdata_2023-02.parquet", 2): 2,
        ("yellow_tripdata_2023-03.parquet", 3): 2,
    }
