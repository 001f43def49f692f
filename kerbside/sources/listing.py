"""Raw file listing, integrity check and inventory."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.names import source_file, source_folder, source_month, taxi_type
from kerbside.schema import PARQUET_MAGIC

_PROBE_SCHEMA = (
    "path string, uri string, length bigint, mtime timestamp, is_valid boolean, "
    "row_count bigint, columns array<struct<name: string, type: string>>"
)


# The names that Arrow has for file systems of Spark.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def list_files(spark: SparkSession, *roots: str) -> DataFrame:
    """Path, URI, length and modification time of all Parquet files below the roots."""
    return select_listing(
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(list(roots))
    )


def arrow_uri(path: str) -> str:
    """The path as Arrow calls it."""
    scheme, found, rest = path.partition("://")
    return f"{_SCHEMES.get(scheme, scheme)}{found}{rest}" if found else path


def select_listing(files: DataFrame) -> DataFrame:
    """The listing columns of a binary-file source.

    Its content column is never selected, so no file is read. The URI is the
    form of the path that rows read from the file carry in their metadata.
    """
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("uri"),
        "length",
        F.col("modificationTime").alias("mtime"),
    )


def probe_files(listing: DataFrame) -> DataFrame:
    """Add to each listed file its integrity, row count and column types.

    Tasks read the first and last bytes and the footer of each file, wherever it
    lies: a plain path, or any file system that Arrow knows. A file is valid if
    both ends carry the format's magic bytes and the footer can be parsed. A file
    that cannot be reached says nothing about its integrity: that is an error.
    """
    magic = PARQUET_MAGIC

    def probe(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def look(path: str) -> tuple:
            if path.startswith("file:"):
                system, inner = pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
            else:
                system, inner = pafs.FileSystem.from_uri(arrow_uri(path))
            with system.open_input_file(inner) as handle:
                size = handle.size()
                if size < 2 * len(magic) + 4:
                    return False, None, None
                head, tail = handle.read_at(len(magic), 0), handle.read_at(len(magic) + 4, size - len(magic) - 4)
                length = int.from_bytes(tail[:4], "little")
                if head != magic or tail[4:] != magic or length > size - 2 * len(magic) - 4:
                    return False, None, None
                footer = handle.read_at(length, size - len(tail) - length)
            try:
                parquet = pq.ParquetFile(pa.BufferReader(magic + footer + tail))
                columns = [{"name": f.name, "type": str(f.type)} for f in parquet.schema_arrow]
            except (pa.ArrowException, OSError):  # all bytes are here: the footer itself is damaged
                return False, None, None
            return True, parquet.metadata.num_rows, columns

        for batch in batches:
            seen = [look(path) for path in batch["path"]]
            batch["is_valid"] = [row[0] for row in seen]
            batch["row_count"] = pd.array([row[1] for row in seen], dtype="Int64")
            batch["columns"] = [row[2] for row in seen]
            yield batch

    return listing.mapInPandas(probe, _PROBE_SCHEMA)


def with_source(files: DataFrame) -> DataFrame:
    """Add source name and folder, taxi type and month, as the path tells them."""
    path = F.col("path")
    named = files.withColumns({"file_name": source_file(path), "source_folder": source_folder(path)})
    name = F.col("file_name")
    return named.withColumns({"taxi_type": taxi_type(name), "source_month": source_month(name)})


def check_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """All raw files with their source, integrity, row count and column types."""
    return with_source(probe_files(list_files(spark, raw_dir)))


def raw_inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per taxi type and, under the type ``ALL``, in total."""
    typed = files.filter(F.col("taxi_type").isNotNull())
    return typed.rollup("taxi_type").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).withColumn("taxi_type", F.coalesce("taxi_type", F.lit("ALL")))
