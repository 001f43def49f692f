"""Flag the trips of each source once, as soon as the ingest has logged it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.plans.flags import THRESHOLD, flag_listed
from kerbside.plans.store import Store
from kerbside.schema import MANIFEST
from kerbside.sources.listing import list_files

_HISTORY = "36500d"


def run_flag_stream(
    spark: SparkSession,
    store_dir: str,
    checkpoint: str,
    as_of: dt.date | None = None,
    threshold: float = THRESHOLD,
    entries_per_batch: int = 1000,
) -> StreamingQuery:
    """Flag the trips of all sources ingested since the last run, then stop.

    The stream follows the manifest, which is only appended to: a source enters it when
    its states and the statistics have been written, and again when it has changed. Each
    micro-batch joins the trips of its sources with the statistics stored by then.
    """
    store = Store(spark, store_dir)
    store.append("manifest", store.log("manifest").limit(0))  # a stream needs a folder to follow
    entries = (
        spark.readStream.schema(MANIFEST)
        # An entry may be of any age when the stream starts or comes back.
        .option("maxFileAge", _HISTORY)
        .option("maxFilesPerTrigger", str(entries_per_batch))
        .parquet(f"{store.root}/log/manifest")
        .filter((F.col("stage") == "transform") & (F.col("status") == "done"))
        .select("source_folder", "file_name")
    )

    def flag_batch(batch: DataFrame, _: int) -> None:
        # At most one row per source of the batch.
        rows = batch.distinct().collect()
        if rows:
            paths = sorted(row.source_folder + row.file_name for row in rows)
            own = Store(batch.sparkSession, store_dir)
            flag_listed(own, list_files(batch.sparkSession, *paths), as_of, threshold)

    return (
        entries.writeStream.foreachBatch(flag_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
