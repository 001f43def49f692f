"""From aggregate datasets to keyed serving tables."""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.intake import reset_rows
from kerbside.operators.keyed import conform, dedupe_last, nan_to_null, upsert_small
from kerbside.plans.metrics import metric_rows
from kerbside.plans.store import Store
from kerbside.schema import DATASETS, PRIMARY_KEYS
from kerbside.sources.listing import list_files
from kerbside.sources.processed import changed, partition_times
from kerbside.workspace import temporary, written

JOB = "load"
_log = logging.getLogger(__name__)


def changed_partitions(store: Store) -> DataFrame:
    """Dataset partitions that the serving tables do not reflect yet."""
    listing = list_files(store.spark, f"{store.root}/datasets")
    return changed(partition_times(listing), store.log("load_log"))


def load(
    spark: SparkSession,
    store_dir: str,
    only: Sequence[tuple[str, str]] | None = None,
    force: bool = False,
    merge: bool = False,
) -> DataFrame:
    """Bring changed dataset partitions into the serving tables.

    ``only`` restricts to some (dataset, taxi_type) pairs; ``force`` loads pairs
    that have not changed, too. Served rows are those of the datasets; with ``merge``
    rows that are gone from a dataset stay, and only its files that are newer than the
    last load are read and upserted by key. Returns the load log rows of this run.
    """
    store = Store(spark, store_dir)
    if force:
        reset_load(store)
    started = time.time()
    pairs: dict[str, dict[str, object]] = {}
    since: dict[tuple[str, str], object] = {}
    # At most one row per dataset and taxi type. The times are taken before the
    # data is read: what is written meanwhile counts as changed next time.
    for row in changed_partitions(store).collect():
        if row.dataset in DATASETS and (only is None or (row.dataset, row.taxi_type) in only):
            pairs.setdefault(row.dataset, {})[row.taxi_type] = row.mtime
            since[row.dataset, row.taxi_type] = row.last_mtime

    entries, seconds = [], {}
    for dataset, times in sorted(pairs.items()):
        began = time.time()
        entries += _load_dataset(store, dataset, times, since if merge else None)
        # The types of a dataset load in one job, and share its time.
        seconds |= {(dataset, taxi_type): (time.time() - began) / len(times) for taxi_type in times}
    log = _log_frame(spark, entries)
    if entries:
        store.append("load_log", log)
    store.append("run_metrics", metric_rows(spark, JOB, _run_metrics(entries, time.time() - started, seconds)))
    return log


def reset_load(store: Store) -> None:
    """Make every dataset partition count as never loaded."""
    pairs = store.log("load_log").select("dataset", "taxi_type").distinct()
    store.append(
        "load_log", pairs.withColumns({"status": F.lit("reset"), "loaded_at": F.current_timestamp()})
    )


def reset(store: Store, stage: str | None = None) -> None:
    """Make a stage (``transform`` or ``load``), or everything, start afresh."""
    if stage != "load":
        store.append("manifest", reset_rows(store.log("manifest"), stage))
    if stage in (None, "load"):
        reset_load(store)


def _load_dataset(
    store: Store, dataset: str, times: dict[str, object], since: dict[tuple[str, str], object] | None = None
) -> list[tuple]:
    """Load all types in one job; if that fails, one by one, so that a bad partition
    holds up no other."""
    attempts = [list(times)] if len(times) == 1 else [list(times), *[[t] for t in times]]
    entries: dict[str, tuple] = {}
    for types in attempts:
        try:
            if since is None:
                rows = _upsert_types(store, dataset, types)
            else:
                rows = _merge_types(store, dataset, {t: since[dataset, t] for t in types})
        except Exception as error:
            _log.warning("loading %s %s failed: %s", dataset, types, error)
            if len(types) == 1:
                entries[types[0]] = (dataset, types[0], None, None, "failed")
            continue
        for taxi_type in types:
            entries[taxi_type] = (dataset, taxi_type, times[taxi_type], rows.get(taxi_type, 0), "loaded")
        if len(entries) == len(times) and len(types) > 1:
            break
    return list(entries.values())


def _upsert_types(store: Store, dataset: str, types: list[str]) -> dict[str, int]:
    """A dataset holds all rows of a type, so that they replace those served: keys that are
    gone from it are gone from the table."""
    rows = store.dataset(dataset).filter(F.col("taxi_type").isin(*types))
    return store.replace_serving(dataset, _incoming(dataset, rows), types)


def _merge_types(store: Store, dataset: str, since: dict[str, object]) -> dict[str, int]:
    """Upsert what files newer than ``since`` (by type; None: all) hold into the rows served."""
    rows, types = store.dataset(dataset), list(since)
    wanted = F.lit(False)
    for taxi_type, last in since.items():
        own = F.col("taxi_type") == taxi_type
        wanted = wanted | (own if last is None else own & (F.col("_metadata.file_modification_time") > F.lit(last)))
    with temporary(store.spark):
        changed_rows = written(_incoming(dataset, rows.filter(wanted)), "incoming")
        served = store.serving(dataset).filter(F.col("taxi_type").isin(*types))
        return store.replace_serving(dataset, upsert_small(served, changed_rows, PRIMARY_KEYS[dataset]), types)


def _incoming(dataset: str, rows: DataFrame) -> DataFrame:
    """Datasets that this library wrote are unique by key; of copies that others added,
    the row of the newest file counts."""
    versioned = rows.withColumn("_written", F.col("_metadata.file_modification_time"))
    newest = dedupe_last(versioned, PRIMARY_KEYS[dataset], "_written")
    return nan_to_null(conform(newest, DATASETS[dataset]))


def _log_frame(spark: SparkSession, entries: list[tuple]) -> DataFrame:
    schema = "dataset string, taxi_type string, last_mtime timestamp, rows bigint, status string"
    return spark.createDataFrame(entries, schema).withColumn("loaded_at", F.current_timestamp())


def _run_metrics(entries: list[tuple], seconds: float, by_pair: dict[tuple, float]) -> list[tuple]:
    metrics = [
        ("rows_loaded", {"dataset": dataset, "taxi_type": taxi_type}, rows, None)
        for dataset, taxi_type, _, rows, status in entries
        if status == "loaded"
    ]
    metrics += [
        ("duration_seconds", {"dataset": dataset, "taxi_type": taxi_type}, value, None)
        for (dataset, taxi_type), value in sorted(by_pair.items())
    ]
    failures = sum(1 for entry in entries if entry[4] == "failed")
    metrics += [("failures", {}, failures, None), ("duration_seconds", {}, seconds, None)]
    metrics.append(("last_run_timestamp", {}, time.time(), None))
    metrics.append(("status", {}, None, "incomplete" if failures else "success" if entries else "idle"))
    if not failures:
        metrics.append(("last_success_timestamp", {}, time.time(), None))
    return metrics
