"""Read aggregate datasets and find their changed partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.workspace import exists


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table of a declared schema; empty if nothing has been written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def partition_times(files: DataFrame) -> DataFrame:
    """Newest modification time per dataset and taxi type, from a listing of data files.

    A data file lies in ``{dataset}/taxi_type={type}/``, below a month or not; no file is opened.
    """
    pattern = r"([^/]+)/taxi_type=([^/]+)/(?:month=[^/]+/)?[^/]+$"
    return (
        files.select(
            F.regexp_extract("path", pattern, 1).alias("dataset"),
            F.regexp_extract("path", pattern, 2).alias("taxi_type"),
            "mtime",
        )
        .filter(F.col("taxi_type") != "")
        .groupBy("dataset", "taxi_type")
        .agg(F.max("mtime").alias("mtime"))
    )


def changed(partitions: DataFrame, load_log: DataFrame) -> DataFrame:
    """Partitions never loaded, or modified since their last successful load (``last_mtime``)."""
    return (
        partitions.join(loaded(load_log), ["dataset", "taxi_type"], "left")
        .filter(F.col("last_mtime").isNull() | (F.col("mtime") > F.col("last_mtime")))
        .select("dataset", "taxi_type", "mtime", "last_mtime")
    )


def loaded(load_log: DataFrame) -> DataFrame:
    """Partitions whose last load went well, with the change it has seen last."""
    return (
        load_log.groupBy("dataset", "taxi_type")
        .agg(F.max_by(F.struct("last_mtime", "status"), "loaded_at").alias("last"))
        .filter(F.col("last.status") == "loaded")
        .select("dataset", "taxi_type", F.col("last.last_mtime").alias("last_mtime"))
    )
