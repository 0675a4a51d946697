"""Parquet table access (IO1/IO2) with an explicit column list.

Reading with ``select`` right after the scan lets Catalyst prune columns
and push filters into the parquet reader (ReadSchema / PushedFilters).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views with the same names DuckDB sees, for spark.sql use."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
