"""Stored flagged trips: once each, replaced with their source, read by partition and zone."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbside import fixtures
from kerbside.plans import flags, ingest
from kerbside.plans.store import Store
from kerbside.streaming.flags import run_flag_stream

AS_OF = dt.date(2023, 12, 31)
JAN, FEB = dt.date(2023, 1, 1), dt.date(2023, 2, 1)


def in_month(month: int, zone: int, *fares: float) -> list[dict]:
    start = dt.datetime(2023, month, 10, 9)
    return [
        {
            "pickup_datetime": start,
            "dropoff_datetime": start + dt.timedelta(minutes=20),
            "pickup_location_id": zone,
            "fare_amount": fare,
            "source_file": f"yellow_tripdata_2023-{month:02}.parquet",
            "source_month": dt.date(2023, month, 1),
        }
        for fare in fares
    ]


@pytest.fixture()
def raw(spark, trips, tmp_path):
    """One trip in thirteen is dear, in either of two zones: its z-score is 12 / sqrt(13)."""
    rows = in_month(1, 9, 90.0, *[10.0] * 12) + in_month(1, 5, 80.0, *[10.0] * 12) + in_month(2, 7, *[10.0] * 6)
    fixtures.write_raw_files(trips(*rows), str(tmp_path / "raw"))
    return str(tmp_path / "raw")


def stored(store: Store) -> list[tuple]:
    return sorted((row.pickup_location_id, row.fare_amount, round(row.z_fare_amount, 6)) for row in store.flagged().collect())


def test_flags_once_replaced_and_pruned(spark, trips, raw, tmp_path):
    store, checkpoint = Store(spark, str(tmp_path / "store")), str(tmp_path / "checkpoint")
    assert flags.flag(spark, raw, store.root, AS_OF).count() == 0, "nothing is ingested"
    ingest.run(spark, raw, store.root, AS_OF)
    for _ in range(2):
        run_flag_stream(spark, store.root, checkpoint, AS_OF).awaitTermination()
    z = round(12 / 13**0.5, 6)
    assert stored(store) == [(5, 80.0, z), (9, 90.0, z)]
    log = store.log("manifest").filter("stage = 'flag'").collect()
    assert sorted((row.file_name[-10:-8], row.status, row.rows_in, row.rows_kept) for row in log) == [
        ("01", "done", 26, 2), ("02", "done", 6, 0),
    ]
    assert flags.flag(spark, raw, store.root, AS_OF).count() == 0, "all sources are flagged"

    # Rows lie by zone, and only the folders that are asked for are read.
    for path in Path(store.root, "flagged").rglob("*.parquet"):
        zones = [zone for zone in pq.read_table(path)["pickup_location_id"].to_pylist() if zone is not None]
        assert zones == sorted(zones)
    drill = store.flagged(["yellow"], [JAN]).filter("pickup_location_id = 9")
    assert drill.count() == 1 and store.flagged(["yellow"], [FEB]).count() == 0
    plan = drill._jdf.queryExecution().executedPlan().toString()
    wanted = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "taxi_type" in wanted and "month" in wanted
    assert "EqualTo(pickup_location_id,9)" in plan[plan.index("PushedFilters"):]

    # A source that has changed replaces what was flagged of it, also by nothing.
    fixtures.write_raw_files(trips(*in_month(1, 9, *[10.0] * 13), *in_month(2, 7, *[10.0] * 6)), raw, replace=True)
    ingest.run(spark, raw, store.root, AS_OF)
    run_flag_stream(spark, store.root, checkpoint, AS_OF).awaitTermination()
    assert stored(store) == []


def test_crash_before_the_manifest_is_repaired(spark, raw, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    ingest.run(spark, raw, store.root, AS_OF)
    append = Store.append

    def fail(self, name, rows):
        if name == "manifest":
            raise RuntimeError("crash")
        append(self, name, rows)

    monkeypatch.setattr(Store, "append", fail)
    with pytest.raises(RuntimeError):
        flags.flag(spark, raw, store.root, AS_OF)
    monkeypatch.undo()
    assert flags.flag(spark, raw, store.root, AS_OF).agg(F.sum("rows_kept")).first()[0] == 2
    assert len(stored(store)) == 2
