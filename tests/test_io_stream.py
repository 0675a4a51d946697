"""Sinks round-trip (IO4-IO7, PF3) and the streaming form of the user statistics."""

import os
import tempfile

from pyspark.sql import functions as F

from shopsignal.operators.features import user_base_stats
from shopsignal.plans import pipeline as pl
from shopsignal.sources import fixtures as fx
from shopsignal.streaming import user_stats_stream
from shopsignal.streaming.user_stats import read_log_stream
from tests.conftest import SF_SMALL


def test_csv_and_parquet_round_trip(spark):
    d = tempfile.mkdtemp(prefix="shopsignal-io-")
    df = fx.train(spark, SF_SMALL)
    pl.write_table(df, os.path.join(d, "csv"), fmt="csv")
    back = pl.read_csv(spark, os.path.join(d, "csv"), schema=df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    pl.write_table(df, os.path.join(d, "pq"))
    assert spark.read.parquet(os.path.join(d, "pq")).count() == df.count()
    pl.write_table(df, os.path.join(d, "txt"), fmt="text")
    assert spark.read.text(os.path.join(d, "txt")).count() == df.count()


def test_drop_unnamed(spark):
    df = spark.createDataFrame([(0, 1)], "`Unnamed: 0` long, x long")
    assert pl.drop_unnamed(df).columns == ["x"]


def test_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="shopsignal-stream-")
    log = fx.user_log(spark, SF_SMALL)
    log.repartition(3).write.mode("overwrite").parquet(os.path.join(d, "in"))
    s = read_log_stream(spark, os.path.join(d, "in"), log.schema)
    q = (user_stats_stream(s).writeStream.outputMode("complete").format("memory")
         .queryName("user_stats_stream_test").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM user_stats_stream_test").drop("time_stamp_std")
    want = user_base_stats(log).drop("time_stamp_std")
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    assert got.where(F.col("user_cnt") <= 0).count() == 0
