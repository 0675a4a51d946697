"""Numeric type narrowing (PF11, A10, SC3) and category codes (PF12).

One aggregation pass computes min and max of every numeric column; the plan
is a small table (one row per column) that chooses the narrowest type whose
bounds strictly contain the range, trying the unsigned type between the
signed ones (N7). Spark has no unsigned types, so each choice maps to the
next wider signed type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Candidate integer types in the order they are tried, with the
# numpy bounds they are compared to (strictly), and the Spark type used.
INT_LADDER = [
    ("int8", -128, 127, "tinyint"),
    ("uint8", 0, 255, "smallint"),
    ("int16", -32768, 32767, "smallint"),
    ("uint16", 0, 65535, "int"),
    ("int32", -2147483648, 2147483647, "int"),
    ("uint32", 0, 4294967295, "bigint"),
    ("int64", -9223372036854775808, 9223372036854775807, "bigint"),
    ("uint64", 0, 18446744073709551615, "decimal(20,0)"),
]
FLOAT_LADDER = [
    ("float16", -65504.0, 65504.0, "float"),
    ("float32", -3.4028234663852886e38, 3.4028234663852886e38, "float"),
]
WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
         "decimal(20,0)": 16}

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL + _FRACTIONAL)]


def _choice(lo: Column, hi: Column, ladder, fallback: tuple[str, str]) -> tuple[Column, Column]:
    ref = F.lit(fallback[0])
    sp = F.lit(fallback[1])
    for name, bmin, bmax, spark_t in reversed(ladder):
        ok = (lo > F.lit(float(bmin))) & (hi < F.lit(float(bmax)))
        ref = F.when(ok, F.lit(name)).otherwise(ref)
        sp = F.when(ok, F.lit(spark_t)).otherwise(sp)
    return ref, sp


def narrow_plan(df: DataFrame, allow_float: bool = False) -> DataFrame:
    """(column, min, max, ref_dtype, spark_type, bytes_before, bytes_after)."""
    cols = numeric_columns(df)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        # "+ 0.0" folds a -0.0 extreme into 0.0
        aggs += [(F.min(F.col(c)).cast("double") + 0.0).alias(f"{c}__min"),
                 (F.max(F.col(c)).cast("double") + 0.0).alias(f"{c}__max")]
    one = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                 F.lit(isinstance(kinds[c], _INTEGRAL)).alias("is_int"),
                 F.lit(kinds[c].simpleString()).alias("orig"))
        for c in cols]))
    long = one.select(F.col("_rows"), stacked.alias("s")).select("_rows", "s.*")
    ri, si = _choice(F.col("min"), F.col("max"), INT_LADDER, ("uint64", "decimal(20,0)"))
    rf, sf = _choice(F.col("min"), F.col("max"), FLOAT_LADDER, ("float64", "double"))
    if not allow_float:
        sf = F.lit("double")  # D14: float16 loses integer digits above 2048
    out = long.select(
        "column", "min", "max",
        F.when(F.col("is_int"), ri).otherwise(rf).alias("ref_dtype"),
        F.when(F.col("is_int"), si).otherwise(sf).alias("spark_type"),
        "_rows", "orig")
    width = lambda c: F.element_at(F.create_map(*[x for k, v in WIDTH.items()
                                                  for x in (F.lit(k), F.lit(v))]), c)
    return out.select("column", "min", "max", "ref_dtype", "spark_type",
                      (F.col("_rows") * width(F.col("orig"))).cast("long").alias("bytes_before"),
                      (F.col("_rows") * width(F.col("spark_type"))).cast("long").alias("bytes_after"))


def apply_narrowing(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Cast columns to the planned types. The plan is one row per column (small)."""
    types = {r["column"]: r["spark_type"] for r in plan.select("column", "spark_type").collect()}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
