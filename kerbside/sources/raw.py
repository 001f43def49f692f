"""Scan raw trip files into unified trips."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.joins import lookup_join
from kerbside.operators.rules import month_range
from kerbside.operators.unify import normalise, union_trips
from kerbside.schema import RAW_COLUMNS, TRIP_SCHEMA
from kerbside.sources.listing import check_files

_PART = "/part-"  # starts the name of a part file in a source's folder
SOURCE_ID = ("source_folder", "file_name")


def scan_raw(spark: SparkSession, raw_dir: str, only_source_month: bool = False) -> DataFrame:
    """Unified trips of all valid raw files, with ``source_file``, ``source_month`` and ``folder_id``.

    Files that are damaged beyond their footers fail the scan. ``only_source_month``
    leaves out trips outside the month of their source, and reads that month only:
    its bounds reach the files as constants.
    """
    files = check_files(spark, raw_dir)
    return scan_sources(spark, source_rows(files).collect(), files, only_source_month)


def source_rows(files: DataFrame) -> DataFrame:
    """One row per source and layout of probed files.

    A layout is the names and types of the columns that are used; files that are
    invalid or of unknown type have none.
    """
    return _with_layout(files).groupBy("taxi_type", *SOURCE_ID, "source_month", "layout").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("length").alias("length"),
        F.max("mtime").alias("newest"),
        F.sum("row_count").alias("row_count"),
        F.min_by(F.struct("path", "uri"), "path").alias("sample"),
    )


def _with_layout(files: DataFrame) -> DataFrame:
    def layout(kind: str) -> Column:
        used = [source.lower() for source in RAW_COLUMNS[kind].values()]
        columns = F.filter("columns", lambda c: F.lower(c["name"]).isin(used))
        return F.when(F.col("is_valid") & (F.col("taxi_type") == kind), F.to_json(F.array_sort(columns)))

    return files.withColumn("layout", F.coalesce(*map(layout, RAW_COLUMNS)))


def scan_sources(
    spark: SparkSession,
    sources: Sequence[Row],
    files: DataFrame,
    only_source_month: bool = False,
    skip_damage: bool = False,
) -> DataFrame:
    """Unified trips of sources, given as ``source_rows`` of ``files``.

    Files of one type whose used columns agree in name and type form one scan; each
    scan casts to the unified schema before the union. So months of differing
    physical types never meet in one reader, the reader stays vectorised, and the
    number of scans grows with the layouts seen, not with the files. The driver
    holds one row per source and layout; paths of single files only for sources
    that mix layouts.

    What a name says is worked out once per source, not per row: rows look it up
    by the URI of their source. With ``skip_damage`` unreadable parts of files are
    left out: for callers that compare row counts with the footers.
    """
    layouts = Counter((row.source_folder, row.file_name) for row in sources)
    sources = [row for row in sources if row.layout is not None]
    mixed = [row for row in sources if layouts[row.source_folder, row.file_name] > 1]
    # A source with a damaged part is not read as one path, either.
    single = _paths(spark, files, mixed) if mixed else {}
    groups: dict[tuple, list[Row]] = {}
    for row in sources:
        month = (row.source_month,) if only_source_month else ()
        depth = 1 + _source_path(row.sample.uri).count(_PART)
        groups.setdefault((row.taxi_type, row.layout, depth, month), []).append(row)
    scans = [
        _scan_group(spark, kind, group, depth, single, month, skip_damage)
        for (kind, _, depth, month), group in sorted(groups.items(), key=lambda item: str(item[0]))
    ]
    return union_trips(scans) if scans else _no_trips(spark)


def _paths(spark: SparkSession, files: DataFrame, sources: list[Row]) -> dict[tuple, list[str]]:
    keys = spark.createDataFrame(
        sorted({(row.source_folder, row.file_name) for row in sources}), "source_folder string, file_name string"
    )
    rows = _with_layout(files).join(F.broadcast(keys), list(SOURCE_ID)).filter("layout IS NOT NULL")
    found: dict[tuple, list[str]] = {}
    for row in rows.select(*SOURCE_ID, "layout", "path").collect():
        found.setdefault((row.source_folder, row.file_name, row.layout), []).append(row.path)
    return found


def _source_path(path: str) -> str:
    """The folder of a part file; any other path as it is."""
    folder, found, name = path.rpartition(_PART)
    return folder if found and "/" not in name else path


def _scan_group(
    spark: SparkSession,
    taxi_type: str,
    sources: list[Row],
    depth: int,
    single: dict[tuple, list[str]],
    month: tuple,
    skip_damage: bool,
) -> DataFrame:
    used = {source.lower() for source in RAW_COLUMNS[taxi_type].values()}
    # One footer read per layout gives the physical types of the whole group.
    footer = spark.read.parquet(sources[0].sample.path).schema
    schema = type(footer)([field for field in footer.fields if field.name.lower() in used])
    paths = []
    for row in sources:
        paths += single.get((row.source_folder, row.file_name, row.layout), [row.source_folder + row.file_name])
    raw = (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", str(skip_damage).lower())
        .option("pathGlobFilter", "*.parquet")
        .parquet(*sorted(paths))
        .select("*", F.substring_index(F.col("_metadata.file_path"), _PART, depth).alias("uri"))
    )
    named = [(_source_path(row.sample.uri), row.file_name, row.source_month, row.source_folder) for row in sources]
    lookup = spark.createDataFrame(
        sorted(named, key=str), "uri string, source_file string, source_month date, source_folder string"
    )
    lookup = lookup.select("uri", "source_file", "source_month", folder_id().alias("folder_id"))
    trips = normalise(raw, taxi_type, keep=("uri",))
    if month and month[0] is not None:
        trips = trips.filter(month_range(month[0]))
    return lookup_join(trips, lookup, ["uri"], lookup_rows=len(named)).drop("uri")


def folder_id() -> Column:
    """A short name for the folder of a source, as part of the key of its states."""
    return F.lower(F.hex(F.xxhash64("source_folder")))


def _no_trips(spark: SparkSession) -> DataFrame:
    empty = spark.createDataFrame([], TRIP_SCHEMA)
    kinds = {"source_file": "string", "source_month": "date", "folder_id": "string"}
    return empty.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()})
