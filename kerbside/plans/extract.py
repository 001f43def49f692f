"""The books of the extract stage: what to fetch, and how fetching went."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.plans.store import Store
from kerbside.schema import TAXI_TYPES
from kerbside.sources.coverage import coverage, outcome_rollup
from kerbside.sources.listing import check_files, list_files, raw_inventory, with_source

JOB = "extract"


def fetch_list(
    store: Store, raw_dir: str, start: dt.date, as_of: dt.date, types: Sequence[str] = TAXI_TYPES
) -> DataFrame:
    """The (type, month) files to fetch: those missing, and those present but corrupt."""
    expected = coverage(check_files(store.spark, raw_dir), start, as_of, types)
    return expected.filter(F.col("status") != "PRESENT")


def record_extract(store: Store, raw_dir: str, outcomes: DataFrame, already_present: int = 0) -> None:
    """Append the metrics of a fetch: files and seconds per outcome and in all,
    files and bytes on disk per type, bytes per source, and the time of the run.

    ``outcomes`` has one row per attempt (url, file_name, outcome, seconds).
    """
    attempts = outcome_rollup(outcomes, already_present)
    on_disk = raw_inventory(with_source(list_files(store.spark, raw_dir)))
    rows = _metric(attempts, "files", "outcome").unionByName(_metric(attempts, "seconds", "outcome"))
    rows = rows.unionByName(_metric(on_disk, "files_on_disk", "taxi_type", "files"))
    rows = rows.unionByName(_metric(on_disk, "bytes_on_disk", "taxi_type", "bytes"))
    whole = outcomes.agg(F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds")).withColumns(
        {"last_run_timestamp": F.unix_timestamp().cast("double"), "none": F.lit(None).cast("string")}
    )
    for metric in ("total_seconds", "last_run_timestamp"):
        rows = rows.unionByName(_metric(whole, metric, "none").withColumn("labels", F.lit(None).cast("map<string,string>")))
    sizes = with_source(list_files(store.spark, raw_dir)).filter("taxi_type IS NOT NULL")
    sizes = sizes.groupBy("file_name").agg(F.sum("length").alias("file_bytes"))
    store.append("run_metrics", rows.unionByName(_metric(sizes, "file_bytes", "file_name")))


def _metric(rows: DataFrame, metric: str, label: str, column: str | None = None) -> DataFrame:
    return rows.select(
        F.lit(JOB).alias("job"),
        F.lit(metric).alias("metric"),
        F.create_map(F.lit(label), F.col(label)).alias("labels"),
        F.col(column or metric).cast("double").alias("value"),
        F.current_timestamp().alias("ts"),
    )
