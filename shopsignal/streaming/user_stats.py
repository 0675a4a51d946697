"""Per-user base statistics over an append-only action log stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shopsignal.operators.features import user_base_stats


def read_log_stream(spark: SparkSession, path: str, schema: StructType, max_files: int = 1) -> DataFrame:
    """Parquet files of user_log rows appearing in ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def user_stats_stream(log_stream: DataFrame, compat: bool = False) -> DataFrame:
    """The batch aggregate on a stream; run with outputMode("complete") or ("update")."""
    return user_base_stats(log_stream, compat=compat)
