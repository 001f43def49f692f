"""Trips flagged by their z-scores, stored per source for drill-down."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.intake import pending
from kerbside.operators.rules import clean, validate_month
from kerbside.plans.ingest import manifest_entries, manifest_frame, split_sources
from kerbside.plans.metrics import metric_rows
from kerbside.plans.models import zscore_flags
from kerbside.plans.store import Store
from kerbside.schema import MIN_YEAR
from kerbside.sources.listing import list_files, probe_files, with_source
from kerbside.sources.raw import scan_sources, source_rows

JOB = "flag"
THRESHOLD = 3.0


def flag(
    spark: SparkSession,
    raw_dir: str,
    store_dir: str,
    as_of: dt.date | None = None,
    threshold: float = THRESHOLD,
    min_year: int = MIN_YEAR,
) -> DataFrame:
    """Flag the trips of all raw sources that are ingested and not flagged yet."""
    return flag_listed(Store(spark, store_dir), list_files(spark, raw_dir), as_of, threshold, min_year)


def flag_listed(
    store: Store,
    listing: DataFrame,
    as_of: dt.date | None = None,
    threshold: float = THRESHOLD,
    min_year: int = MIN_YEAR,
) -> DataFrame:
    """Flag the trips of the sources of a listing; returns the manifest rows of this run.

    Only sources that the ingest has read whole, as they are now, are flagged: the stored
    statistics know their trips, and nothing in them is damaged. Others stay pending here.
    Trips are held against the statistics of this moment; a reset of the stage ``flag``
    makes all sources pending again. The manifest row comes last, and a source replaces
    its partition, so that a crash is repaired by the next run.
    """
    started, spark = time.time(), store.spark
    named, manifest = with_source(listing), store.log("manifest")
    unread = pending(named, manifest).select("path")
    todo = pending(named, manifest, JOB).join(unread, "path", "left_anti")
    files = with_source(probe_files(todo.select(*listing.columns)))
    usable, unusable = split_sources(source_rows(files).collect())
    accounts: dict[tuple, tuple[int, int]] = {}
    if usable:
        trips = validate_month(scan_sources(spark, usable, files))
        trips = clean(trips, min_year, as_of.year if as_of else None)
        flagged = zscore_flags(trips, store.dataset("zone_anomaly_stats"), threshold).filter("is_anomaly")
        sources = spark.createDataFrame(
            sorted({(row.taxi_type, row.file_name, row.source_month, row.source_folder) for row in usable}, key=str),
            "taxi_type string, source_file string, source_month date, source_folder string",
        )
        found = store.write_flagged(flagged, sources)
        for row in usable:
            key = (row.source_folder, row.file_name)
            rows_in = accounts.get(key, (0, 0))[0] + row.row_count
            accounts[key] = (rows_in, found.get(key, 0))
    entries = manifest_entries(usable, unusable, accounts, JOB)
    if entries:
        store.append("manifest", manifest_frame(spark, entries))
    metrics = [
        ("rows_flagged", {}, sum(kept for _, kept in accounts.values()), None),
        ("duration_seconds", {}, time.time() - started, None),
        ("last_run_timestamp", {}, time.time(), None),
    ]
    store.append("run_metrics", metric_rows(spark, JOB, metrics))
    return manifest_frame(spark, entries)
