"""Sources that change after they were processed, and sums of very long histories."""

import datetime as dt
import decimal

import pyarrow.fs as pafs
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbside.functions.moments import merge, state_columns, total
from kerbside.operators.intake import pending
from kerbside.operators.rules import clean
from kerbside.plans.store import Store
from kerbside.sources.listing import arrow_uri, check_files, list_files, with_source
from kerbside.sources.raw import scan_raw
from kerbside.streaming.intake import run_stream
from test_sources import yellow_table

AS_OF = dt.date(2025, 6, 1)
NAME = "yellow_tripdata_2023-01.parquet"


def parts(folder, *numbers):
    folder.mkdir(parents=True, exist_ok=True)
    for number in numbers:
        pq.write_table(yellow_table(), folder / f"part-{number}.parquet")


def test_a_source_is_pending_as_a_whole_when_it_changes(spark, tmp_path):
    parts(tmp_path / NAME, 0, 1)
    files = with_source(list_files(spark, str(tmp_path)))
    now = files.groupBy("source_folder", "file_name").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("length").alias("length"), F.max("mtime").alias("newest")
    )
    manifest = now.withColumns(
        {"stage": F.lit("transform"), "status": F.lit("done"), "committed_at": F.current_timestamp()}
    )
    rows = spark.createDataFrame(manifest.collect(), manifest.schema)
    assert pending(files, rows).count() == 0
    parts(tmp_path / NAME, 2)
    pq.write_table(yellow_table(), tmp_path / "yellow_tripdata_2023-02.parquet")
    parts(tmp_path / "more" / NAME, 0)
    todo = pending(with_source(list_files(spark, str(tmp_path))), rows)
    assert todo.count() == 5 and set(todo.columns) == set(files.columns)


def test_one_file_a_batch_and_two_streams(spark, tmp_path):
    """Sources of several parts end as done; a second stream adds to the first."""
    store = Store(spark, str(tmp_path / "store"))
    for number, raw in enumerate(("one", "two")):
        parts(tmp_path / raw / NAME, 0, 1)
        run_stream(
            spark, str(tmp_path / raw), store.root, str(tmp_path / f"check{number}"), AS_OF, files_per_batch=1
        ).awaitTermination()
    manifest = store.log("manifest").collect()
    assert {(row.status, row.rows_in) for row in manifest} == {("done", 4)}
    assert store.dataset("daily_stats").agg(F.sum("trip_count")).first()[0] == 8


def test_sums_of_long_histories_do_not_overflow(spark):
    """States whose units fill 64 bits each."""
    zeros = {name: F.lit(0).cast(kind) for name, kind in state_columns()}
    full = {"trips": F.lit(9_000_000), "total_cnt": F.lit(9_000_000), "total_units": F.lit(decimal.Decimal(9 * 10**18))}
    states = spark.range(1000).withColumn("zone", F.lit(1)).withColumns(zeros).withColumns(full)
    assert merge(states, ["zone"]).select(total("total")).first()[0] == pytest.approx(9e15)


def test_names_of_file_systems():
    assert arrow_uri("s3a://bucket/raw/x.parquet") == "s3://bucket/raw/x.parquet"
    assert arrow_uri("abfss://box@account.dfs.core.windows.net/x") == "abfss://box@account.dfs.core.windows.net/x"
    assert arrow_uri("/plain/path") == "/plain/path"
    system, inner = pafs.FileSystem.from_uri(arrow_uri("s3n://bucket/x?region=eu-west-1"))
    assert type(system).__name__ == "S3FileSystem" and inner == "bucket/x"


def test_a_file_out_of_reach_is_not_corrupt(spark, tmp_path):
    from kerbside.sources.listing import probe_files

    parts(tmp_path, 0)
    listing = list_files(spark, str(tmp_path)).withColumn("path", F.lit("nosuch://box/x.parquet"))
    with pytest.raises(Exception, match="nosuch|scheme|Unrecognized"):
        probe_files(listing).collect()


def test_month_bounds_reach_the_files(spark, tmp_path):
    pq.write_table(yellow_table(), tmp_path / NAME)
    frame = clean(scan_raw(spark, str(tmp_path), only_source_month=True), as_of_year=2025)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2023-01-01T00:00)" in plan
    assert "LessThan(tpep_pickup_datetime,2023-02-01T00:00)" in plan
    assert check_files(spark, str(tmp_path)).first().source_folder.endswith("/")
