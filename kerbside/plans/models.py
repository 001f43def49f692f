"""Fare, demand and tip models, trip clusters and z-score flags."""

from __future__ import annotations

import datetime as dt
import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kerbside.functions.clock import calendar_columns
from kerbside.operators.joins import lookup_join
from kerbside.plans.metrics import metric_rows
from kerbside.plans.store import Store
from kerbside.schema import (
    DATASETS,
    FARE_TYPES,
    MAX_LABEL_FARE,
    PRIMARY_KEYS,
    REGRESSION,
    SCORED,
    SPLIT_SEED,
    TRAIN_SHARE,
)
from kerbside.workspace import scratch, temporary

# Columns that pipeline stages add on their way to a prediction.
_WORKING_COLUMNS = (
    "taxi_type_idx", "payment_idx", "payment_kind", "features_raw", "features", "rawPrediction", "probability",
)
ZONE_FEATURES = ("pickup_location_id", "pickup_hour", "pickup_dow", "pickup_month")
FARE_JOB = "model_fare"
REGRESSION_FEATURES = (*ZONE_FEATURES, "taxi_type_idx")
# By how much of the label's deviation the gradient of a fit may differ from that of the best one.
CHECK_TOLERANCE = 1e-3
TIP_KEYS = ("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "taxi_type")
CLUSTER_FEATURES = SCORED
QUANTILE_BINS = 1000
QUANTILE_PASSES = 3


@dataclass
class Fitted:
    """A fitted pipeline and what the test part says about it."""

    model: PipelineModel
    metrics: dict[str, float]

    def metrics_frame(self, spark) -> DataFrame:
        rows = [(name, float(value)) for name, value in self.metrics.items()]
        return spark.createDataFrame(rows, "metric string, value double")


def hash_split(
    df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test part by a hash of the row's keys.

    A row's part depends on the row alone: not on partitioning, task order or a
    retried task, so repeated runs train on the same rows.
    """
    first = in_training(keys, share, seed)
    return df.filter(first), df.filter(~first)


def in_training(keys: Sequence[str], share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> Column:
    """Whether a row is for training: the leading 32 bits of the MD5 of its keys, written as text."""
    text = F.concat_ws("|", *[F.col(key).cast("string") for key in keys], F.lit(str(seed)))
    slot = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    return slot < round(share * 10_000)


# -- regressions on the hourly table ------------------------------------------


def fare_training_set(zone_hourly: DataFrame, types: Sequence[str] = FARE_TYPES) -> DataFrame:
    """Hourly rows of the fare types with a plausible average fare."""
    fare = F.col("avg_fare")
    return zone_hourly.filter(
        F.col("taxi_type").isin(*types) & fare.isNotNull() & (fare > 0) & (fare < MAX_LABEL_FARE)
    )


def train_fare(zone_hourly: DataFrame, model_path: str | None = None, weight_col: str | None = None) -> Fitted:
    """Elastic-net regression of the average fare; saved to ``model_path`` if given."""
    return _train_regression(fare_training_set(zone_hourly), "avg_fare", model_path, weight_col)


def dense_demand(zone_hourly: DataFrame) -> DataFrame:
    """Trips of every hour of each zone and type, from its first day to its last; 0 where there were none.

    Every zone and type makes its own days and hours, and one join brings the trips in.
    """
    zone = ["pickup_location_id", "taxi_type"]
    days = zone_hourly.groupBy(*zone).agg(F.min("pickup_date").alias("first"), F.max("pickup_date").alias("last"))
    days = days.select(*zone, F.explode(F.sequence("first", "last")).alias("pickup_date"))
    hours = days.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("pickup_hour"))
    keys = PRIMARY_KEYS["zone_hourly"]
    joined = hours.join(zone_hourly.select(*keys, "trip_count"), list(keys), "left")
    dated = joined.withColumns(calendar_columns(F.col("pickup_date")))
    names = DATASETS["zone_hourly"].fieldNames()
    return dated.select(*names[: names.index("trip_count")], F.coalesce("trip_count", F.lit(0)).alias("trip_count"))


def train_demand(zone_hourly: DataFrame, model_path: str | None = None) -> Fitted:
    """Elastic-net regression of the trip count per zone and hour, empty hours included."""
    return _train_regression(dense_demand(zone_hourly), "trip_count", model_path)


def backtest_baseline(demand: DataFrame, origins: Sequence[dt.date], days: int = 7) -> DataFrame:
    """Per origin: rows before it, rows of the ``days`` from it on, those of them with a row a week
    before, and the error of the naive forecast that repeats it. ``demand`` is dense."""
    keys = list(PRIMARY_KEYS["zone_hourly"])
    rows = demand.select(*keys, "trip_count")
    before = rows.withColumnRenamed("trip_count", "naive").withColumn("pickup_date", F.date_add("pickup_date", 7))
    # Row counts before each origin need no join; an origin is a constant of the plan.
    both = rows.join(before, keys, "left")
    parts = []
    for origin in origins:
        tested = F.col("pickup_date").between(F.lit(origin), F.lit(origin + dt.timedelta(days - 1)))
        error = F.when(tested, F.pow(F.col("trip_count") - F.col("naive"), F.lit(2)))
        parts.append(
            F.struct(
                F.lit(origin).alias("origin"),
                F.count_if(F.col("pickup_date") < F.lit(origin)).alias("training_rows"),
                F.count_if(tested).alias("test_rows"),
                F.count(error).alias("naive_rows"),
                F.sqrt(F.avg(error)).alias("naive_rmse"),
            )
        )
    return both.agg(F.array(*parts).alias("origins")).select(F.inline("origins"))


def backtest_demand(demand: DataFrame, origins: Sequence[dt.date], days: int = 7) -> DataFrame:
    """Rolling-origin evaluation of the demand model: fitted on all rows before each origin, tested on
    the ``days`` from it on, beside the naive forecast. One row per origin."""
    spark = demand.sparkSession
    demand = demand.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        baseline = backtest_baseline(demand, origins, days).collect()
        rows = []
        for row in baseline:
            errors: dict[str, float] = {}
            if row.training_rows and row.test_rows:
                end = row.origin + dt.timedelta(days)
                tested = demand.filter((F.col("pickup_date") >= F.lit(row.origin)) & (F.col("pickup_date") < F.lit(end)))
                model = Pipeline(stages=_regression_stages("trip_count")).fit(demand.filter(F.col("pickup_date") < F.lit(row.origin)))
                errors = _regression_error(model.transform(tested), "trip_count")
            rows.append((*row, errors.get("rmse"), errors.get("mae")))
    finally:
        demand.unpersist()
    schema = "origin date, training_rows bigint, test_rows bigint, naive_rows bigint, naive_rmse double, rmse double, mae double"
    return spark.createDataFrame(rows, schema)


def _regression_stages(label: str, weight_col: str | None = None) -> list:
    settings = dict(REGRESSION, **({"weightCol": weight_col} if weight_col else {}))
    return [
        StringIndexer(inputCol="taxi_type", outputCol="taxi_type_idx", handleInvalid="keep"),
        *_scaled(REGRESSION_FEATURES),
        LinearRegression(featuresCol="features", labelCol=label, **settings),
    ]


def regression_checks(rows: DataFrame, label: str, model: PipelineModel) -> DataFrame:
    """Whether a fitted regression is the best one, per feature, of the rows it was fitted on.

    For each feature: its mean and deviation in the rows, as the scaler has them, and how far the
    fit is from the optimum: the part of the gradient that the penalty does not hold. One aggregate.
    """
    fit = model.stages[-1]
    scaled = model.transform(rows).select(
        vector_to_array("features_raw").alias("raw"), vector_to_array("features").alias("x"),
        (F.col(label) - F.col("prediction")).alias("residual"), F.col(label).cast("double").alias("y"),
    )
    names = REGRESSION_FEATURES
    at = [F.element_at("x", i + 1) * F.col("residual") for i in range(len(names))]
    raw = [F.element_at("raw", i + 1) for i in range(len(names))]
    found = scaled.agg(
        F.count(F.lit(1)), F.stddev_samp("y"), F.avg("residual"), *[F.avg(x) for x in at],
        *[F.avg(x) for x in raw], *[F.stddev_samp(x) for x in raw],
    ).first()
    n, spread, offset, values = found[0], found[1], found[2], found[3:]
    k, mix, strength = len(names), fit.getElasticNetParam(), fit.getRegParam()
    out = []
    for i, name in enumerate(names):
        weight = float(fit.coefficients[i])
        # The solver fits the label in units of its deviation; the square penalty is so in its units, too.
        slope = -values[i] + (1 - mix) * strength / spread * weight
        held = mix * strength
        missed = abs(slope + math.copysign(held, weight)) if weight else max(0.0, abs(slope) - held)
        right = missed < CHECK_TOLERANCE * spread and abs(offset) < CHECK_TOLERANCE * spread
        out.append((name, n, values[k + i], values[2 * k + i], right))
    return rows.sparkSession.createDataFrame(out, "feature string, rows bigint, mean double, deviation double, optimal boolean")


def cluster_checks(placed: DataFrame, features: Column, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Rows, and rows that lie nearer to another centre than to that of their ``cluster``."""
    def distance(centre: Sequence[float]) -> Column:
        parts = [F.pow(F.element_at(features, i + 1) - F.lit(float(x)), F.lit(2.0)) for i, x in enumerate(centre)]
        return sum(parts[1:], parts[0])

    every = F.array(*[distance(centre) for centre in centres])
    own = F.element_at(every, F.col("cluster") + 1)
    misplaced = F.count_if(own > F.array_min(every) + CHECK_TOLERANCE)
    return placed.agg(F.count(F.lit(1)).alias("rows"), misplaced.alias("misplaced"))


def _scaled(inputs: Sequence[str]) -> list:
    """Stages from input columns to features of mean 0 and deviation 1."""
    return [
        VectorAssembler(inputCols=list(inputs), outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def _train_regression(
    rows: DataFrame, label: str, model_path: str | None, weight_col: str | None = None
) -> Fitted:
    stages = _regression_stages(label, weight_col)
    columns = dict.fromkeys([*PRIMARY_KEYS["zone_hourly"], *ZONE_FEATURES, label, *([weight_col] if weight_col else [])])
    # The stages pass over the rows several times. They are aggregate rows, far
    # fewer than trips, and only these columns.
    rows = rows.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = hash_split(rows, PRIMARY_KEYS["zone_hourly"])
        model = Pipeline(stages=stages).fit(train)
        metrics = {"training_rows": train.count(), **_regression_error(model.transform(test), label)}
    finally:
        rows.unpersist()
    if model_path:
        model.write().overwrite().save(model_path)
    return Fitted(model, metrics)


def _regression_error(predictions: DataFrame, label: str) -> dict[str, float]:
    """RMSE and MAE in one pass."""
    error = F.col("prediction") - F.col(label)
    row = predictions.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    ).first()
    return {name: value for name, value in row.asDict().items() if value is not None}


def train_fare_in_store(store: Store, model_path: str) -> Fitted:
    """Train the fare model on the stored hourly table, with status and metrics in the log.

    Each model is saved in a folder of its own below ``model_path``; a log row, written last, makes
    it the current one. A crash before that leaves the former model in force and whole.
    """
    spark, job, started = store.spark, FARE_JOB, time.time()
    store.append("run_metrics", metric_rows(spark, job, [("status", {}, None, "training")]))
    try:
        version = 1 + (store.log("model_log").filter(F.col("job") == job).agg(F.max("version")).first()[0] or 0)
        path = f"{model_path.rstrip('/')}/version={version}"
        fitted = train_fare(store.dataset("zone_hourly"), path)
        entry = spark.createDataFrame([(job, version, path)], "job string, version bigint, path string")
        store.append("model_log", entry.withColumn("committed_at", F.current_timestamp()))
    except Exception:
        store.append("run_metrics", metric_rows(spark, job, [("status", {}, None, "failed")]))
        raise
    values = [(name, {}, value, None) for name, value in fitted.metrics.items()]
    values += [("training_seconds", {}, time.time() - started, None), ("last_trained_timestamp", {}, time.time(), None)]
    store.append("run_metrics", metric_rows(spark, job, [*values, ("status", {}, None, "ready")]))
    return fitted


def current_model(store: Store, job: str = FARE_JOB) -> PipelineModel | None:
    """The newest model of a job that was saved whole; None if there is none."""
    log = store.log("model_log").filter(F.col("job") == job)
    row = log.agg(F.max_by("path", "version").alias("path")).first()
    return PipelineModel.load(row.path) if row.path else None


def score(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Predictions of a fare, demand or tip model for requested zones and times.

    Requests carry the model's inputs: zone, hour, day of week and month; the type
    for fare and demand; fare and kind of payment for tips.
    """
    return model.transform(requests).drop(*_WORKING_COLUMNS)


# -- tips -----------------------------------------------------------------------


def tip_training_set(trips: DataFrame, types: Sequence[str] = FARE_TYPES) -> DataFrame:
    """Clean trips of the types with tips, labelled by whether a tip was paid."""
    return trips.filter(
        F.col("taxi_type").isin(*types) & F.col("tip_amount").isNotNull() & F.col("payment_type").isNotNull()
    ).withColumn("tipped", (F.col("tip_amount") > 0).cast("double"))


def train_tip(trips: DataFrame, model_path: str | None = None, max_iter: int = 50) -> Fitted:
    """Logistic regression of paying a tip on fare, zone, time and kind of payment.

    Trips that the model cannot tell apart become one row with their number as weight;
    those rows are computed once.
    """
    inputs = ["fare_amount", *ZONE_FEATURES, "payment_kind"]
    alike = ["fare_amount", *ZONE_FEATURES, "payment_type", "tipped"]
    rows = tip_training_set(trips).withColumn("training", in_training(TIP_KEYS))
    rows = rows.groupBy(*alike, "training").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    stages = [
        StringIndexer(inputCol="payment_type", outputCol="payment_idx", handleInvalid="keep"),
        OneHotEncoder(inputCol="payment_idx", outputCol="payment_kind"),
        *_scaled(inputs),
        LogisticRegression(featuresCol="features", labelCol="tipped", weightCol="weight", maxIter=max_iter),
    ]
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = _without_summary(Pipeline(stages=stages).fit(rows.filter("training")))
        predictions = model.transform(rows.filter("NOT training"))
        right = F.sum(F.when(F.col("prediction") == F.col("tipped"), F.col("weight")).otherwise(0.0))
        counts = predictions.agg(F.sum("weight").alias("test_rows"), (right / F.sum("weight")).alias("accuracy")).first()
        metrics = {name: value for name, value in counts.asDict().items() if value is not None}
        evaluator = BinaryClassificationEvaluator(labelCol="tipped", weightCol="weight")
        metrics["area_under_roc"] = evaluator.evaluate(predictions)
    finally:
        rows.unpersist()
    if model_path:
        model.write().overwrite().save(model_path)
    return Fitted(model, metrics)


def _without_summary(model: PipelineModel) -> PipelineModel:
    """A fitted model as it is when saved and loaded.

    The training summary of a fitted classifier holds the session. Tasks get the model with it,
    which fails as soon as anything in the session has been observed.
    """
    spark = SparkSession.active()
    with temporary(spark):
        path = scratch(spark, "model")
        model.write().save(path)
        return PipelineModel.load(path)


# -- anomalies --------------------------------------------------------------------


@dataclass
class TripClusters:
    """Fitted trip clusters, and the distance from a centre beyond which a trip is an anomaly."""

    model: PipelineModel
    limit: float

    def flag(self, trips: DataFrame) -> DataFrame:
        """Cluster, distance to its centre and anomaly flag of each trip; a trip that lacks a
        feature is in no cluster and not flagged."""
        placed = _place(self.model, trips)
        beyond = F.col("centre_distance") > F.lit(self.limit)
        return placed.withColumn("is_anomaly", F.coalesce(beyond, F.lit(False)))


def train_clusters(
    trips: DataFrame,
    k: int = 8,
    cut: float = 0.99,
    seed: int = SPLIT_SEED,
    max_iter: int = 20,
    model_path: str | None = None,
) -> TripClusters:
    """Cluster clean trips by fare, duration and distance, each scaled to unit deviation.

    Equal trips become one row with their number as weight; those rows are computed once
    and serve the scaling, the clusters and the limit, which is the ``cut`` quantile of
    all distances to the assigned centre.
    """
    rows = trips.dropna(subset=list(CLUSTER_FEATURES)).groupBy(*CLUSTER_FEATURES)
    rows = rows.agg(F.count(F.lit(1)).cast("double").alias("weight")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stages = [
            _cluster_scaling(rows),
            VectorAssembler(inputCols=[f"{c}_scaled" for c in CLUSTER_FEATURES], outputCol="features"),
            KMeans(predictionCol="cluster", weightCol="weight", k=k, seed=seed, maxIter=max_iter),
        ]
        model = Pipeline(stages=stages).fit(rows)
        limit = weighted_quantile(_place(model, rows), "centre_distance", "weight", cut)
    finally:
        rows.unpersist()
    if model_path:
        model.write().overwrite().save(model_path)
    return TripClusters(model, limit)


def weighted_quantile(rows: DataFrame, value: str, weight: str, share: float) -> float | None:
    """The least value that, with all below it, has ``share`` of the weight of all rows.

    Weights are counted exactly in bins between two bounds, and the bounds drawn around the
    bin in which the share is reached. A pass is one aggregate of at most ``QUANTILE_BINS``
    groups, whatever the number of rows and their weights. After the last pass the result
    lies at most ``QUANTILE_BINS ** -QUANTILE_PASSES`` of the range above the exact value.
    """
    rows = rows.select(F.col(value).alias("v"), F.col(weight).cast("double").alias("w")).filter("v IS NOT NULL AND w > 0")
    low, high, total = rows.agg(F.min("v"), F.max("v"), F.sum("w")).first()
    if low is None:
        return None
    rank, below = share * total, 0.0
    for _ in range(QUANTILE_PASSES):
        if low == high:
            break
        place = F.floor((F.col("v") - F.lit(low)) / F.lit(high - low) * QUANTILE_BINS)
        within = rows.filter(F.col("v").between(F.lit(low), F.lit(high)))
        bins = within.groupBy(F.least(place, F.lit(QUANTILE_BINS - 1)).alias("bin"))
        counted = bins.agg(F.sum("w").alias("w"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        for found in sorted(counted, key=lambda row: row.bin):
            low, high = found.low, found.high
            if below + found.w >= rank:
                break
            below += found.w
    return high


def cluster_moments(rows: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation of the cluster features of weighted rows."""
    weight = F.col("weight")
    names = CLUSTER_FEATURES
    first = rows.agg(F.sum(weight), *[F.sum(weight * F.col(c)) / F.sum(weight) for c in names]).first()
    squares = [F.sum(weight * F.pow(F.col(c) - F.lit(mean), F.lit(2))) for c, mean in zip(names, first[1:])]
    second = rows.agg(*squares).first()
    n = first[0] or 0.0
    return {c: (m, math.sqrt(q / (n - 1)) if n > 1 else 0.0) for c, m, q in zip(names, first[1:], second)}


def _cluster_scaling(rows: DataFrame) -> SQLTransformer:
    """Scales to mean 0 and deviation 1; a missing feature counts as average."""
    scaled = [
        f"(coalesce({c}, {mean!r}D) - {mean!r}D) / {deviation or 1.0!r}D AS {c}_scaled"
        for c, (mean, deviation) in cluster_moments(rows).items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def cluster_trips(trips: DataFrame, **settings) -> DataFrame:
    """Cluster clean trips and flag those far from their centre."""
    return train_clusters(trips, **settings).flag(trips)


def _place(model: PipelineModel, trips: DataFrame) -> DataFrame:
    """Trips with their cluster and centre distance, NULL for those that lack a feature."""
    placed = model.transform(trips)
    whole = F.lit(True)
    for name in CLUSTER_FEATURES:
        whole = whole & F.col(name).isNotNull()
    distance = _centre_distance(model.stages[-1].clusterCenters())
    placed = placed.withColumns({"cluster": F.when(whole, F.col("cluster")), "centre_distance": F.when(whole, distance)})
    return placed.drop("features", *[f"{c}_scaled" for c in CLUSTER_FEATURES])


def _centre_distance(centres: Sequence[Sequence[float]]) -> Column:
    """Euclidean distance to the assigned centre; the k centres become constants of the plan."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in centres])
    centre = F.element_at(table, F.col("cluster") + 1)
    features = vector_to_array("features")
    squares = [
        F.pow(F.element_at(features, i) - F.element_at(centre, i), F.lit(2.0))
        for i in range(1, len(CLUSTER_FEATURES) + 1)
    ]
    return F.sqrt(sum(squares[1:], squares[0]))


def zscore_flags(
    trips: DataFrame, stats: DataFrame, threshold: float = 3.0, stats_rows: int | None = None
) -> DataFrame:
    """Clean trips with the z-scores of fare, duration and distance within their zone and
    type; flagged if any exceeds ``threshold``. No deviation, or none to compare: no flag.

    ``stats`` should be the stored table of zone statistics: one row per zone and type.
    They are counted before they are looked up, unless ``stats_rows`` tells their number.
    """
    keys = PRIMARY_KEYS["zone_anomaly_stats"]
    stats = stats.drop("trip_count")
    joined = lookup_join(trips, stats, keys, "left", lookup_rows=stats_rows)
    scores = {}
    for column in CLUSTER_FEATURES:
        spread = F.col(f"stddev_{column}")
        scores[f"z_{column}"] = F.when(spread > 0, F.abs(F.col(column) - F.col(f"avg_{column}")) / spread)
    scored = joined.withColumns(scores).drop(*[c for c in stats.columns if c.startswith(("avg_", "stddev_"))])
    beyond = [F.coalesce(F.col(name) > threshold, F.lit(False)) for name in scores]
    return scored.withColumn("is_anomaly", beyond[0] | beyond[1] | beyond[2])
