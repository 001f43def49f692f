import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import rows_of
from kerbside.operators.joins import lookup_join
from kerbside.operators.keyed import conform, dedupe_last, duplicate_count, nan_to_null, upsert, upsert_small


def test_dedupe_keeps_the_highest_version_in_any_order(spark):
    rng = random.Random(5)
    rows = [(rng.randint(1, 9) if i % 3 else 0, rng.randint(1, 40), rng.random()) for i in range(600)]
    expected = {}
    for key, version, value in rows:
        expected[key] = max(expected.get(key, (0, 0.0)), (version, value))
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, version int, value double").repartition(7)
        found = dedupe_last(frame, ["k"], "version")
        assert {r.k: (r.version, r.value) for r in found.collect()} == expected
        assert found.columns == ["k", "version", "value"]
    count = duplicate_count(frame, ["k"]).first()
    assert (count["rows"], count["keys"], count["dropped"]) == (600, len(expected), 600 - len(expected))


def test_dedupe_combines_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.lit("x").alias("text"))
    plan = dedupe_last(frame, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_upsert(spark):
    target = spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b")], "k int, x double, y string")
    source = spark.createDataFrame([(2, None), (3, 30.0)], "k int, x double")
    once = upsert(target, source, ["k"])
    assert rows_of(once) == [(1, 10.0, "a"), (2, None, "b"), (3, 30.0, None)]
    assert rows_of(upsert(once, source, ["k"])) == rows_of(once)


def test_upsert_of_keys_only_changes_nothing_else(spark):
    target = spark.createDataFrame([(1, 10.0)], "k int, x double")
    source = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows_of(upsert(target, source, ["k"])) == [(1, 10.0), (2, None)]


def test_upsert_refuses_unknown_columns(spark):
    target = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        upsert(target, target.withColumn("z", F.lit(1)), ["k"])


def test_conform(spark):
    schema = T.StructType(
        [T.StructField("b", T.LongType()), T.StructField("a", T.DoubleType()), T.StructField("c", T.DateType())]
    )
    frame = spark.createDataFrame([("1.5", 2.5, 0), ("x", 3.6, 0)], "a string, b double, other int")
    found = conform(frame, schema)
    assert found.columns == ["b", "a", "c"]
    assert [tuple(r) for r in found.orderBy("b").collect()] == [(2, 1.5, None), (4, None, None)]


def test_nan_to_null(spark):
    frame = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None)], "k int, x double")
    assert rows_of(nan_to_null(frame)) == [(1, None), (2, 1.0), (3, None)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_gives_the_same_either_way(spark, how):
    """Half of the rows share one key, a third are copies of one row."""
    rows = [(0, i) for i in range(300)] + [(1, 7)] * 200 + [(i, i) for i in range(2, 100)]
    large = spark.createDataFrame(rows, "k int, v int").repartition(5)
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(0, 60)], "k int, name string")
    small = lookup_join(large, lookup, ["k"], how)
    salted = lookup_join(large, lookup, ["k"], how, broadcast_rows=10, salts=4)
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
    assert rows_of(small) == rows_of(salted)
    assert small.count() == (len(rows) if how == "left" else 300 + 200 + 58)


def test_small_upsert_is_an_upsert_that_moves_no_target(spark, tmp_path):
    schema = "k int, day string, a int, b int"
    old = [(1, "x", 10, 100), (2, "x", 20, 200), (None, "x", 30, 300), (3, "y", None, 400)]
    spark.createDataFrame(old, schema).write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    source = spark.createDataFrame([(2, "x", None), (3, "x", 7), (None, "x", 8)], "k int, day string, a int")
    found = upsert_small(target, source, ["k", "day"])
    assert rows_of(found) == rows_of(upsert(target, source, ["k", "day"]))
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    # Beyond the bounds, and with nothing on one side.
    assert rows_of(upsert_small(target, source, ["k", "day"], broadcast_rows=1)) == rows_of(found)
    assert rows_of(upsert_small(target, source.limit(0), ["k", "day"])) == rows_of(target)
    assert upsert_small(target.limit(0), source, ["k", "day"]).count() == 3
    with pytest.raises(ValueError):
        upsert_small(target, source.withColumnRenamed("a", "c"), ["k", "day"])
