"""Run metrics as rows of a log table, and the latest value of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schema import METRIC_BANDS

Metric = tuple[str, dict, float | None, str | None]


def metric_rows(spark: SparkSession, job: str, metrics: list[Metric]) -> DataFrame:
    """Rows (job, metric, labels, value, text, ts) of one run."""
    rows = [
        (job, name, {k: str(v) for k, v in labels.items()}, None if value is None else float(value), text)
        for name, labels, value, text in metrics
    ]
    schema = "job string, metric string, labels map<string,string>, value double, text string"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.current_timestamp())


def latest_metrics(run_metrics: DataFrame) -> DataFrame:
    """Newest value per job, metric and labels, with its band where bands are defined.

    Each group keeps one running maximum, so the history may be of any length.
    """
    entries = F.map_entries(F.coalesce("labels", F.create_map().cast("map<string,string>")))
    labelled = run_metrics.withColumn("labels", F.to_json(F.map_from_entries(F.array_sort(entries))))
    newest = labelled.groupBy("job", "metric", "labels").agg(
        F.max(F.struct("ts", "value", "text")).alias("newest")
    )
    return newest.select(
        "job",
        "metric",
        "labels",
        F.col("newest.ts").alias("ts"),
        F.col("newest.value").alias("value"),
        F.col("newest.text").alias("text"),
        _band(F.col("newest.value")).alias("band"),
    )


def _band(value: Column) -> Column:
    return F.coalesce(
        *[
            F.when(
                (F.col("metric") == metric) & value.isNotNull(),
                F.when(value < green, "green").when(value < orange, "orange").otherwise("red"),
            )
            for metric, (green, orange) in METRIC_BANDS.items()
        ]
    )
