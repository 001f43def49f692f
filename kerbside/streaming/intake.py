"""Process each raw file once, as an incremental stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kerbside.plans.ingest import ingest_listed
from kerbside.plans.store import Store
from kerbside.sources.listing import list_files, select_listing, with_source

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def run_stream(
    spark: SparkSession,
    raw_dir: str,
    store_dir: str,
    checkpoint: str,
    as_of: dt.date | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Ingest all raw files not seen before, then stop.

    The stream carries files, not rows: months of different types and layouts
    cannot share one streaming schema. Each micro-batch lists the sources of its
    files anew and whole, and hands them to the batch ingest, so that a source whose
    files fall in several batches is complete after each. Its writes and manifest rows
    replace what an interrupted batch left, and several streams may feed one store,
    one after the other.
    """
    listing = select_listing(
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .load(raw_dir)
    )

    def ingest_batch(batch: DataFrame, _: int) -> None:
        # At most one row per file of the batch.
        rows = with_source(batch).select("source_folder", "file_name").distinct().collect()
        if rows:
            sources = list_files(batch.sparkSession, *sorted(row.source_folder + row.file_name for row in rows))
            ingest_listed(Store(batch.sparkSession, store_dir), sources, as_of)

    return (
        listing.writeStream.foreachBatch(ingest_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
