"""Skew-safe positions equal a plain row_number, for any partitioning and a hot group."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopsignal.plans.ranking import with_dense_codes, with_global_position, with_group_position, with_prefix_sum


def _data(spark, n=3000, parts=7):
    # group 0 holds a third of the rows (hot key)
    return (spark.range(n).repartition(parts)
            .withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11))
            .withColumn("v", F.md5(F.col("id").cast("string"))))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_group_position(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = _data(spark)
        a = with_group_position(df, ["g"], [F.col("v")], "p")
        b = df.withColumn("q", F.row_number().over(Window.partitionBy("g").orderBy("v")))
        assert a.join(b, ["id", "g", "v"]).where("p != q").count() == 0
        assert a.count() == df.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_global_position_and_prefix_sum(spark):
    df = _data(spark)
    a = with_global_position(df, [F.col("v")], "p")
    b = df.withColumn("q", F.row_number().over(Window.orderBy("v")))
    assert a.join(b, ["id"]).where("p != q").count() == 0
    c = with_prefix_sum(df.withColumn("one", F.lit(1)), [F.col("v")], "one", "cum")
    assert c.join(b, ["id"]).where("cum != q").count() == 0


def test_dense_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "x string")
    assert {r["x"]: r["code"] for r in with_dense_codes(df, "x").collect()} == {"a": 0, "b": 1, "c": 2}


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from shopsignal.plans.ranking import exact_quantiles
    vals = [float(x) for x in np.random.default_rng(3).integers(0, 50, 501)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    got = exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0]).first()
    want = np.quantile(vals, [0.0, 0.25, 0.5, 0.9, 1.0])
    assert [got[f"q{i}"] for i in range(5)] == pytest.approx(list(want))
