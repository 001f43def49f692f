import os

import pytest
from pyspark.sql import functions as F

from frames import rows_of
from kerbside.operators.joins import lookup_join, size_within
from kerbside.workspace import scratch, settled, temporary, written


def test_scratch_of_a_block_goes_with_it(spark):
    outside = written(spark.range(3), "outside")
    with temporary(spark):
        paths = [written(spark.range(3), "inside").inputFiles()[0] for _ in range(2)]
        with temporary(spark):
            inner = scratch(spark, "inner")
            spark.range(2).write.parquet(inner)
        assert not os.path.exists(inner)
    assert not any(os.path.exists(path.removeprefix("file://")) for path in paths)
    assert outside.count() == 3


def test_scratch_goes_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), temporary(spark):
        path = scratch(spark, "failing")
        spark.range(2).write.parquet(path)
        raise ZeroDivisionError
    assert not os.path.exists(path)


def test_settled_keeps_the_result_alone(spark):
    made = []

    def build():
        made.append(scratch(spark, "part"))
        spark.range(5).write.parquet(made[0])
        return spark.read.parquet(made[0]).filter("id > 1")

    assert rows_of(settled(spark, "whole", build)) == [(2,), (3,), (4,)]
    assert not os.path.exists(made[0])


def test_wide_lookups_are_not_broadcast(spark):
    wide = spark.range(100).withColumn("text", F.repeat(F.lit("x"), 1000)).withColumn("pair", F.struct("id", "text"))
    assert size_within(wide, 100, 1 << 20) == 100
    assert size_within(wide, 99, 1 << 20) is None
    assert size_within(wide, 100, 150_000) is None
    assert size_within(wide.limit(0), 0, 0) == 0
    rows = spark.range(300).select((F.col("id") % 120).alias("id"))
    plans = []
    for most in (1 << 20, 50_000):
        joined = lookup_join(rows, wide.select("id", "text"), ["id"], broadcast_bytes=most)
        plans.append(joined._jdf.queryExecution().analyzed().toString())
        assert joined.count() == sum(1 for i in range(300) if i % 120 < 100)
    assert "_salt" not in plans[0]
    assert "_salt" in plans[1]
