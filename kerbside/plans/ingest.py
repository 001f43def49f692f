"""From raw files to the four aggregate datasets, incrementally."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.moments import TRIPS
from kerbside.operators.aggregates import AGGREGATES, monthly, partials, source_accounts
from kerbside.operators.intake import SETTLED, pending, reset_rows
from kerbside.operators.joins import lookup_join
from kerbside.plans.metrics import metric_rows
from kerbside.plans.store import Store, dated
from kerbside.schema import MIN_YEAR
from kerbside.sources.listing import list_files, probe_files, with_source
from kerbside.sources.raw import folder_id, scan_sources, source_rows

JOB = "transform"
OBSERVED_SOURCES = 100


def run(
    spark: SparkSession,
    raw_dir: str,
    store_dir: str,
    as_of: dt.date | None = None,
    force: bool = False,
    min_year: int = MIN_YEAR,
) -> DataFrame:
    """Process all pending raw files and refresh the datasets they touch.

    Returns the manifest rows of this run. ``force`` makes every file pending first.
    """
    store = Store(spark, store_dir)
    if force:
        store.append("manifest", reset_rows(store.log("manifest"), JOB))
    return ingest_listed(store, list_files(spark, raw_dir), as_of, min_year)


def ingest_listed(
    store: Store, listing: DataFrame, as_of: dt.date | None = None, min_year: int = MIN_YEAR
) -> DataFrame:
    """Process the files of a listing that are pending.

    Only pending files are opened for the integrity check.
    """
    todo = pending(with_source(listing), store.log("manifest")).select(*listing.columns)
    files = with_source(probe_files(todo))
    return ingest(store, source_rows(files).collect(), files, as_of, min_year)


def ingest(
    store: Store, sources: Sequence[Row], files: DataFrame, as_of: dt.date | None, min_year: int = MIN_YEAR
) -> DataFrame:
    """Process sources, given as ``source_rows`` of probed files: states, then datasets,
    then the manifest.

    The manifest row comes last. A crash anywhere before leaves the sources pending,
    and the next run replaces whatever this one wrote. Only source-level facts (one
    row per source and layout) pass through the driver.
    """
    started = time.time()
    spark = store.spark
    usable, unusable = split_sources(sources)
    if not sources:
        store.append("run_metrics", metric_rows(spark, JOB, [("idle", {}, 1, None), _last_run()]))
        return store.log("manifest").limit(0)

    accounts: dict[tuple, tuple[int, int]] = {}
    seconds: dict[str, float] = {}
    if usable:
        named = spark.createDataFrame(
            sorted({(row.taxi_type, row.file_name, row.source_month, row.source_folder) for row in usable}, key=str),
            "taxi_type string, source_file string, source_month date, source_folder string",
        ).select("taxi_type", "source_file", "source_month", "source_folder", folder_id().alias("folder_id"))
        states = partials(scan_sources(spark, usable, files, skip_damage=True), min_year, as_of.year if as_of else None)
        accounts = _write_and_count(store, states, named)
        # All types go through each job together, and share its time.
        months = _months_of(usable)
        refresh_datasets(store, sorted(months), months)
        seconds = {taxi_type: (time.time() - started) / len(months) for taxi_type in months}

    entries = manifest_entries(usable, unusable, accounts)
    store.append("manifest", manifest_frame(spark, entries))
    store.append("run_metrics", metric_rows(spark, JOB, _run_metrics(entries, time.time() - started, seconds)))
    return manifest_frame(spark, entries)


def _months_of(sources: Sequence[Row]) -> dict[str, list[dt.date] | None]:
    """Per taxi type the months whose trips its sources can hold; None for all: an undated one may hold any."""
    found: dict[str, set] = {}
    for row in sources:
        found.setdefault(row.taxi_type, set()).add(row.source_month)
    return {taxi_type: None if None in months else sorted(months) for taxi_type, months in found.items()}


def refresh_datasets(
    store: Store, types: Sequence[str], months: Mapping[str, Sequence[dt.date] | None] | None = None
) -> None:
    """Roll the given months of taxi types up from their states (all months by default).

    All types go through each write together. Dated datasets and the monthly states are
    replaced month by month; the datasets without a date follow from the monthly states.
    """
    months = {t: (months or {}).get(t) for t in types}
    schema = "taxi_type string, month string"
    whole = [t for t in types if months[t] is None]
    named = {t: [f"{month:%Y-%m}" for month in months[t]] for t in types if months[t] is not None}
    day = F.date_format("pickup_date", "yyyy-MM")
    states = store.states().filter(F.col("taxi_type").isin(*types))
    wanted = F.col("taxi_type").isin(*whole)
    for taxi_type, names in named.items():
        # Only the sources of these months and the undated ones can hold trips of them.
        source = F.col("source_month").isNull() | F.col("source_month").isin(*months[taxi_type])
        wanted = wanted | ((F.col("taxi_type") == taxi_type) & source & day.isin(*names))
    touched = [(taxi_type, name) for taxi_type, names in named.items() for name in names]
    if whole:
        # A row per type and month: kept, since the plans below would read the states for it again.
        present = states.filter(F.col("taxi_type").isin(*whole)).select("taxi_type", day.alias("month"))
        touched += present.filter("month IS NOT NULL").union(store.months(whole)).distinct().collect()
    states = states.filter(wanted)
    touched = store.spark.createDataFrame(touched, schema)
    store.write_monthly(monthly(states), touched)
    rolled = store.monthly().filter(F.col("taxi_type").isin(*types))
    every = store.spark.createDataFrame([(t, None) for t in types], schema)
    for name, aggregate in AGGREGATES.items():
        store.write_dataset(name, aggregate(states if dated(name) else rolled), touched if dated(name) else every)


def _write_and_count(store: Store, states: DataFrame, named: DataFrame) -> dict[tuple, tuple[int, int]]:
    """Write the states; rows read and kept of each source, counted as they are written.

    So many sources that an observation of each would slow the write are counted in what
    was written instead: a row per source comes to the driver either way.
    """
    sources = named.drop("source_folder")
    known = named.select("taxi_type", "source_folder", "source_file", "folder_id").collect()
    if len(known) > OBSERVED_SOURCES:
        store.write_states(states, sources)
        written = store.states().filter(F.col("taxi_type").isin(*{row.taxi_type for row in known}))
        rows = source_accounts(written.select("source_file", "source_month", "folder_id", "taxi_type", "rejected_by", TRIPS))
        lookup = named.select("source_file", "folder_id", "source_folder")
        found = lookup_join(rows, lookup, ["source_file", "folder_id"], lookup_rows=len(known))
        return {(row.source_folder, row.source_file): (row.rows_in, row.rows_kept) for row in found.collect()}
    counts = []
    for number, row in enumerate(known):
        own = (F.col("source_file") == row.source_file) & (F.col("folder_id") == row.folder_id)
        counts.append(F.sum(F.when(own, F.col(TRIPS))).alias(f"in_{number}"))
        counts.append(F.sum(F.when(own & F.col("rejected_by").isNull(), F.col(TRIPS))).alias(f"kept_{number}"))
    observation = Observation()
    store.write_states(states, sources, observation, counts)
    got = observation.get
    return {
        (row.source_folder, row.source_file): (got[f"in_{number}"] or 0, got[f"kept_{number}"] or 0)
        for number, row in enumerate(known)
    }


def split_sources(sources: Sequence[Row]) -> tuple[list[Row], list[Row]]:
    """Rows of sound sources, and those of sources that are of no known type or have a damaged file."""
    broken = {(row.source_folder, row.file_name) for row in sources if row.layout is None}
    sound = [row for row in sources if (row.source_folder, row.file_name) not in broken]
    return sound, [row for row in sources if (row.source_folder, row.file_name) in broken]


def manifest_entries(
    usable: Sequence[Row], unusable: Sequence[Row], accounts: dict[tuple, tuple[int, int]], job: str = JOB
) -> list[tuple]:
    """One entry per source.

    ``done`` means that every row promised by the footers was read; a source that
    lost rows to damage inside a file is ``partial`` and stays pending, as does a
    ``corrupt`` one. A name that tells no taxi type is ``skipped``.
    """
    by_source: dict[tuple, list[Row]] = {}
    for row in (*usable, *unusable):
        by_source.setdefault((row.source_folder, row.file_name), []).append(row)
    entries = []
    for (folder, name), rows in sorted(by_source.items(), key=lambda item: (item[0][1], item[0][0])):
        counts = (None, None)
        if rows[0].taxi_type is None:
            status = "skipped"
        elif any(row.layout is None for row in rows):
            status = "corrupt"
        else:
            counts = accounts[folder, name]
            status = "done" if counts[0] == sum(row.row_count for row in rows) else "partial"
        length, parts = sum(row.length for row in rows), sum(row.parts for row in rows)
        newest = max(row.newest for row in rows)
        entries.append(
            (job, name, rows[0].taxi_type, rows[0].source_month, length, status, *counts, folder, parts, newest)
        )
    return entries


def manifest_frame(spark: SparkSession, entries: list[tuple]) -> DataFrame:
    schema = (
        "stage string, file_name string, taxi_type string, source_month date, "
        "length bigint, status string, rows_in bigint, rows_kept bigint, source_folder string, parts bigint, "
        "newest timestamp"
    )
    return spark.createDataFrame(entries, schema).withColumn("committed_at", F.current_timestamp())


def _last_run() -> tuple:
    return ("last_run_timestamp", {}, time.time(), None)


def _run_metrics(entries: list[tuple], seconds: float, by_type: dict[str, float]) -> list[tuple]:
    totals: dict[str, dict[str, float]] = {}
    for _, _, taxi_type, _, _, status, rows_in, rows_kept, *_ in entries:
        if status == "skipped":
            continue
        total = totals.setdefault(
            taxi_type, {"files_processed": 0, "files_corrupt": 0, "rows_before": 0, "rows_after": 0}
        )
        total["files_processed" if status == "done" else "files_corrupt"] += 1
        total["rows_before"] += rows_in or 0
        total["rows_after"] += rows_kept or 0
    metrics = [
        (name, {"taxi_type": taxi_type}, value, None)
        for taxi_type, total in sorted(totals.items())
        for name, value in total.items()
    ]
    metrics += [("duration_seconds", {"taxi_type": t}, value, None) for t, value in sorted(by_type.items())]
    failed = any(entry[5] not in SETTLED for entry in entries)
    metrics += [("duration_seconds", {}, seconds, None), _last_run()]
    metrics.append(("status", {}, None, "incomplete" if failed else "success"))
    if not failed:
        metrics.append(("last_success_timestamp", {}, time.time(), None))
    return metrics
