"""The table store: incremental states, datasets, serving tables and their logs.

Layout below the root folder::

    states/taxi_type=…/source_file=…/folder_id=…/     partial states, one partition per raw source
    monthly/taxi_type=…/month=…/                      states per month, zone and hour
    datasets/{name}/taxi_type=…/month=…/              the four aggregates (month=all if undated)
    flagged/taxi_type=…/month=…/source_file=…/folder_id=…/   flagged trips, one partition per raw source
    serving/{name}/version=…/taxi_type=…/             keyed serving tables, a version per load
    log/{manifest,load_log,serving_log,model_log,run_metrics}/

A raw source owns its state partition, so that processing it again replaces it. A
partition that has lost all rows holds a marker, so that it is replaced as well.
Logs are only ever appended to. One driver writes at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.moments import TRIPS, UNITS, state_columns
from kerbside.operators.keyed import conform
from kerbside.schema import DATASETS, LOAD_LOG, MANIFEST, MODEL_LOG, RUN_METRICS, SCORED, SERVING_LOG, TRIP_SCHEMA
from kerbside.sources.processed import read_or_empty
from kerbside.sources.raw import folder_id
from kerbside.workspace import remove

ALL_MONTHS = "all"
_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), UNITS: T.DecimalType(38, 0)}
_MEASURES = [T.StructField(name, _TYPES[kind]) for name, kind in state_columns()]
STATE_SCHEMA = T.StructType(
    [
        T.StructField("source_month", T.DateType()),
        T.StructField("rejected_by", T.StringType()),
        T.StructField("pickup_date", T.DateType()),
        T.StructField("pickup_hour", T.IntegerType()),
        T.StructField("pickup_location_id", T.LongType()),
        *_MEASURES,
        T.StructField("taxi_type", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("folder_id", T.StringType()),
    ]
)
MONTHLY_SCHEMA = T.StructType(
    [
        T.StructField("pickup_location_id", T.LongType()),
        T.StructField("pickup_hour", T.IntegerType()),
        *_MEASURES,
        T.StructField("taxi_type", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)
FLAGGED_SCHEMA = T.StructType(
    [
        *[field for field in TRIP_SCHEMA.fields if field.name != "taxi_type"],
        *[T.StructField(f"z_{name}", T.DoubleType()) for name in SCORED],
        *[T.StructField(name, T.StringType()) for name in ("taxi_type", "month", "source_file", "folder_id")],
    ]
)
LOGS = {
    "manifest": MANIFEST,
    "load_log": LOAD_LOG,
    "serving_log": SERVING_LOG,
    "model_log": MODEL_LOG,
    "run_metrics": RUN_METRICS,
}


class Store:
    """Reads and writes the tables of one store folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- partial states ----------------------------------------------------

    def states(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/states", STATE_SCHEMA)

    def write_states(
        self,
        partials: DataFrame,
        sources: DataFrame | None = None,
        observation: Observation | None = None,
        observed: Sequence[Column] = (),
    ) -> None:
        """Replace the state partitions of the sources in ``partials``.

        ``sources`` (taxi_type, source_file, source_month) adds one empty accounting
        row each, so that a source without any rows replaces its partition as well.
        ``observation`` gets the ``observed`` aggregates of the rows as they are written.
        """
        rows = partials
        if sources is not None:
            zeros = {name: F.lit(0).cast(kind) for name, kind in state_columns()}
            markers = sources.withColumns({"rejected_by": F.lit("marker"), **zeros})
            rows = rows.unionByName(markers, allowMissingColumns=True)
        self._overwrite_partitions(
            conform(rows, STATE_SCHEMA),
            f"{self.root}/states",
            "taxi_type",
            "source_file",
            "folder_id",
            observation=observation,
            observed=observed,
        )

    def monthly(self) -> DataFrame:
        table = read_or_empty(self.spark, f"{self.root}/monthly", MONTHLY_SCHEMA)
        return table.filter(F.col(TRIPS).isNotNull())

    def write_monthly(self, rows: DataFrame, partitions: DataFrame) -> None:
        """Replace the given (taxi_type, month) partitions of the monthly states."""
        self._replace(conform(rows, MONTHLY_SCHEMA), "monthly", partitions)

    # -- aggregate datasets --------------------------------------------------

    def dataset(self, name: str) -> DataFrame:
        return self._dataset_partitions(name).filter("trip_count IS NOT NULL").drop("month")

    def _dataset_partitions(self, name: str) -> DataFrame:
        schema = T.StructType([*_last(DATASETS[name], "taxi_type").fields, T.StructField("month", T.StringType())])
        return read_or_empty(self.spark, f"{self.root}/datasets/{name}", schema)

    def months(self, types: Sequence[str]) -> DataFrame:
        """The (taxi_type, month) partitions of the monthly states, by their folders alone."""
        table = read_or_empty(self.spark, f"{self.root}/monthly", MONTHLY_SCHEMA)
        return table.filter(F.col("taxi_type").isin(*types)).select("taxi_type", "month").distinct()

    def write_dataset(self, name: str, rows: DataFrame, partitions: DataFrame) -> None:
        """Replace the given (taxi_type, month) partitions of a dataset by ``rows``."""
        month = F.date_format("pickup_date", "yyyy-MM") if dated(name) else F.lit(ALL_MONTHS)
        if not dated(name):
            partitions = partitions.select("taxi_type", F.lit(ALL_MONTHS).alias("month")).distinct()
        self._replace(rows.withColumn("month", month), f"datasets/{name}", partitions)

    def _replace(self, rows: DataFrame, folder: str, partitions: DataFrame) -> None:
        """A marker row, without values, makes sure that each partition is written."""
        both = rows.unionByName(partitions.select("taxi_type", "month"), allowMissingColumns=True)
        self._overwrite_partitions(both, f"{self.root}/{folder}", "taxi_type", "month")

    def _overwrite_partitions(
        self,
        rows: DataFrame,
        path: str,
        *columns: str,
        observation: Observation | None = None,
        observed: Sequence[Column] = (),
        order: Sequence[str] = (),
    ) -> None:
        # REBALANCE gathers the rows of a partition in few tasks, hence few files,
        # but lets adaptive execution split a partition that is too large for one.
        rows = rows.hint("rebalance", *columns)
        if observation is not None:
            # Observed behind the exchange, in the tasks that write: those count once
            # each, whatever is run again. A stage before it may count twice.
            rows = rows.observe(observation, *observed)
        if order:
            rows = rows.sortWithinPartitions(*columns, *order)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*columns)
            .parquet(path)
        )

    # -- flagged trips ---------------------------------------------------------

    def flagged(self, types: Sequence[str] | None = None, months: Sequence[dt.date] | None = None) -> DataFrame:
        """Stored flagged trips with their z-scores.

        Types and months of pickup (any day of them) are looked for in their folders only;
        sources without a month in their name may hold any.
        """
        rows = read_or_empty(self.spark, f"{self.root}/flagged", FLAGGED_SCHEMA)
        if types is not None:
            rows = rows.filter(F.col("taxi_type").isin(*types))
        if months is not None:
            names = [f"{month:%Y-%m}" for month in months]
            rows = rows.filter(F.col("month").isin(*names, ALL_MONTHS))
            rows = rows.filter(F.date_format("pickup_datetime", "yyyy-MM").isin(*names))
        # A partition without flagged trips holds a marker, which has no pickup.
        rows = rows.filter(F.col("pickup_datetime").isNotNull())
        return rows.select(*TRIP_SCHEMA.fieldNames(), *[f"z_{name}" for name in SCORED])

    def write_flagged(self, rows: DataFrame, sources: DataFrame) -> dict[tuple, int]:
        """Replace the flagged trips of ``sources`` (taxi_type, source_file, source_month,
        source_folder); trips flagged by (source_folder, source_file).

        Rows of a file lie in the order of their zone: a question about a zone skips the
        row groups of others.
        """
        month = F.coalesce(F.date_format("source_month", "yyyy-MM"), F.lit(ALL_MONTHS)).alias("month")
        named = sources.select("*", folder_id().alias("folder_id"))
        markers = named.select("taxi_type", "source_file", "folder_id", month)
        both = rows.select("*", month).unionByName(markers, allowMissingColumns=True)
        path, columns = f"{self.root}/flagged", ("taxi_type", "month", "source_file", "folder_id")
        self._overwrite_partitions(conform(both, FLAGGED_SCHEMA), path, *columns, order=["pickup_location_id"])
        written = read_or_empty(self.spark, path, FLAGGED_SCHEMA).join(F.broadcast(markers), list(columns), "left_semi")
        found = written.filter(F.col("pickup_datetime").isNotNull()).groupBy("source_file", "folder_id").count()
        # One row per source, on both sides.
        counts = {(row.source_file, row.folder_id): row["count"] for row in found.collect()}
        return {
            (row.source_folder, row.source_file): counts.get((row.source_file, row.folder_id), 0)
            for row in named.collect()
        }

    # -- serving tables ------------------------------------------------------

    def serving(self, name: str) -> DataFrame:
        """The committed rows of a serving table: of each taxi type its current version."""
        paths = [
            f"{self._serving_path(name, row.version)}/taxi_type={row.taxi_type}"
            for row in self._current(name)
            if row["rows"]
        ]
        if not paths:
            return self.spark.createDataFrame([], DATASETS[name])
        schema = T.StructType([*_last(DATASETS[name], "taxi_type").fields, T.StructField("version", T.LongType())])
        table = self.spark.read.schema(schema).option("basePath", f"{self.root}/serving/{name}").parquet(*paths)
        return table.select(*DATASETS[name].fieldNames())

    def replace_serving(self, name: str, rows: DataFrame, types: Sequence[str]) -> dict[str, int]:
        """Write a new version of the given types and commit it with a log row each.

        Other types are not touched. A crash before the log rows leaves the versions in
        force as they are. What was superseded before this load is removed after it; the
        version superseded by it stays for those who still read it. Returns rows by type.
        """
        current = self._current(name)
        version = 1 + max((row.version for row in current), default=0)
        path = self._serving_path(name, version)
        rows.write.mode("overwrite").partitionBy("taxi_type").parquet(path)
        # Counted in the footers of what was written: the rows are computed once.
        written = read_or_empty(self.spark, path, _last(DATASETS[name], "taxi_type"))
        found = {t: 0 for t in types} | {row.taxi_type: row["count"] for row in written.groupBy("taxi_type").count().collect()}
        entries = [(name, t, version, found[t]) for t in types]
        schema = "dataset string, taxi_type string, version bigint, rows bigint"
        log = self.spark.createDataFrame(entries, schema)
        self.append("serving_log", log.withColumn("committed_at", F.current_timestamp()))
        self._remove_versions(name, {row.version for row in current} | {version})
        return found

    def _remove_versions(self, name: str, keep: set[int]) -> None:
        """Remove committed versions other than these."""
        known = self.log("serving_log").filter(F.col("dataset") == name).select("version").distinct()
        for row in known.filter(~F.col("version").isin(*keep)).collect():
            remove(self.spark, self._serving_path(name, row.version))

    def _serving_path(self, name: str, version: int) -> str:
        return f"{self.root}/serving/{name}/version={version}"

    def _current(self, name: str) -> list[Row]:
        """The newest version of each taxi type."""
        log = self.log("serving_log").filter(F.col("dataset") == name)
        newest = log.groupBy("taxi_type").agg(F.max(F.struct("version", "rows")).alias("newest"))
        return newest.select("taxi_type", "newest.*").collect()

    # -- logs ----------------------------------------------------------------

    def log(self, name: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/log/{name}", LOGS[name])

    def append(self, name: str, rows: DataFrame) -> None:
        """Append rows to a log; a log grows by a few rows per run, in one file."""
        conform(rows, LOGS[name]).coalesce(1).write.mode("append").parquet(f"{self.root}/log/{name}")


def dated(name: str) -> bool:
    """Whether the rows of a dataset carry a date."""
    return "pickup_date" in DATASETS[name].fieldNames()


def _last(schema: T.StructType, column: str) -> T.StructType:
    """The schema with its partition column at the end, where Spark reads it."""
    fields = [f for f in schema.fields if f.name != column]
    return T.StructType([*fields, schema[column]])
