"""Exact duplicates by a stream with disk-backed state (native: DataFrame operations only).

The stream reads the files of a table. Its state, kept by RocksDB and never expired,
holds for each digest of a normalised text the row that stays: its length, its id and
where its content lies (file and row). Rows that hit a digest seen elsewhere are
compared with that content byte for byte.

Defined cases: a null text counts as empty; empty texts are one group. Of equal texts
the one with the most code points stays, then the smallest id (null last), then the
first place in the table, so that one row of repeated ones stays. No rows give no rows.
Only the named columns are carried, under their own names; others are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE_CLASS, stored, text_of
from kerbside.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join, size_within
from kerbside.workspace import scratch, settled, temporary

FILES_PER_BATCH = 64
# A stream passes over files older than this against the newest one seen: by default a week.
_ANY_AGE = "100000000d"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Else each of many small stores reserves several megabytes of disk.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE_CLASS}+", "")


def _place() -> Column:
    """Best row first: longest, then smallest id, then first place."""
    return F.struct(
        (-F.char_length(text_of())).alias("minus_length"),
        F.col("doc_id").isNull().alias("without_id"),
        F.col("doc_id").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def _digest() -> Column:
    return F.sha2(normalised(text_of()), 256)


def update_state(spark: SparkSession, path: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Take the files of ``path`` that the state at ``checkpoint`` has not seen, and end."""
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        # A pattern that only this path matches: a stream takes a file as well as a folder by it.
        rows = (
            spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", str(files_per_batch))
            .option("maxFileAge", _ANY_AGE)
            .parquet(f"{path[:-1]}[{path[-1]}]")
        )
        seen = rows.select(_digest().alias("digest"), _place().alias("place")).groupBy("digest")
        query = (
            seen.agg(F.min("place").alias("keep"), F.count(F.lit(1)).alias("copies"))
            .writeStream.outputMode("update")
            .format("noop")
            .trigger(availableNow=True)
            .option("checkpointLocation", checkpoint)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state holds: digest, keep (the place that stays), copies."""
    held = spark.read.format("statestore").load(checkpoint)
    return held.select(
        F.col("key.digest").alias("digest"), F.col("value.min").alias("keep"), F.col("value.count").alias("copies")
    )


def dedupe(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = ("doc_id",),
    checkpoint: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Every row of the Parquet table at ``path`` with keep_id, group_size, kept, text_sha256.

    ``checkpoint`` carries the state on to later calls with more files in the table.
    """

    def repeated_digests() -> DataFrame:
        at = checkpoint or scratch(spark, "dedup-state")
        update_state(spark, path, at, files_per_batch)
        return state(spark, at).filter("copies > 1")

    # Only digests of several rows are looked up: by a broadcast if they are few and short,
    # which is measured, else by a join that spreads hot ones.
    repeated = settled(spark, "dedup-digests", repeated_digests)
    n = size_within(repeated, BROADCAST_ROWS, BROADCAST_BYTES)
    n = BROADCAST_ROWS + 1 if n is None else n
    rows = spark.read.parquet(path).select(
        F.struct(*columns).alias("row"), text_of().alias("text"), _place().alias("place"), _digest().alias("digest")
    )
    anew = _true_groups(rows, repeated, n)
    verdict = lookup_join(rows, repeated, ["digest"], "left", lookup_rows=n)
    verdict = verdict.withColumn("keep", F.coalesce("keep", "place")).withColumn("copies", F.coalesce("copies", F.lit(1)))
    if anew is not None:
        verdict = verdict.withColumn("content", normalised(F.col("text"))).join(anew, ["digest", "content"], "left")
        verdict = verdict.withColumn("keep", F.coalesce("true_keep", "keep"))
        verdict = verdict.withColumn("copies", F.coalesce("true_copies", "copies"))
    return verdict.select(
        "row.*",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("copies").cast("bigint").alias("group_size"),
        (F.col("place") == F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _true_groups(rows: DataFrame, repeated: DataFrame, n: int) -> DataFrame | None:
    """Rows that hit a digest are compared with the content that stays; where texts differ under
    one digest, their groups go by the content itself. None if there is no such digest."""
    spark = rows.sparkSession
    path = scratch(spark, "dedup-anew")
    with temporary(spark):
        found = lookup_join(rows, repeated, ["digest"], lookup_rows=n)
        hits = stored(found.select("digest", "place", "keep", normalised(F.col("text")).alias("content")), "dedup-hits")
        keepers = hits.filter(F.col("place") == F.col("keep")).select("digest", F.col("content").alias("kept_content"))
        wrong = hits.join(keepers, "digest").filter(F.col("content") != F.col("kept_content")).select("digest")
        wrong = stored(wrong, "dedup-collisions")
        if wrong.isEmpty():
            return None
        anew = hits.join(wrong.distinct(), "digest").groupBy("digest", "content")
        anew = anew.agg(F.min("place").alias("true_keep"), F.count(F.lit(1)).alias("true_copies"))
        anew.write.parquet(path)
    return spark.read.schema(anew.schema).parquet(path)
