"""Registry of named queries: (spark, sf_dir) -> DataFrame, plus DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6  # float outputs are rounded to this many places on both sides


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(c: Column | str, digits: int = DIGITS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every float/double column (schema-driven)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import every module that registers queries."""
    from shopsignal.plans import q_eval, q_features, q_folds, q_history, q_models, q_profile, q_text  # noqa: F401
