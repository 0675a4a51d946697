"""Table profiling (A1-A8, S3, PF4, PF6, PF7, SC1) and distribution summaries (DA1-DA4).

The reference pulls whole tables to the driver (``to_pandas``) to compute
rates and plots. Here every number is an aggregate computed by Spark; only
the aggregate (one row per key, bin or grid point) leaves the executors.
Scalars needed inside a plan (totals, bandwidth) enter as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.functions.stats import filliben_sql, norm_ppf_sql
from shopsignal.plans.ranking import exact_quantiles, value_positions
from shopsignal.session import ensure_checkpoint_dir


def _materialize(values: DataFrame, x: str) -> DataFrame:
    """One column of values, computed once: quantiles, statistics and buckets all read it.

    Without this, every scalar statistic re-runs the whole upstream plan
    (here: aggregates over the fact tables).
    """
    ensure_checkpoint_dir(values.sparkSession)
    return values.select(x).checkpoint(eager=True)

SQL_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
            "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def _missing(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType.typeName()
    m = F.col(c).isNull()
    if t in ("double", "float"):
        m = m | F.isnan(F.col(c))
    return m


def null_counts(df: DataFrame) -> DataFrame:
    """A1: ``isna().sum()`` -- one row, ``<col>_nulls`` per column."""
    return df.agg(*[F.count_if(_missing(df, c)).alias(f"{c}_nulls") for c in df.columns])


def table_info(df: DataFrame) -> DataFrame:
    """SC1: ``info()`` -- (column, dtype, non_null) in long form."""
    aggs = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = aggs.unpivot([], df.columns, "column", "non_null")
    types = {f.name: SQL_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
             for f in df.schema.fields}
    dtype = F.lit(None).cast("string")
    for c, t in types.items():
        dtype = F.when(F.col("column") == c, F.lit(t)).otherwise(dtype)
    return long.select("column", dtype.alias("dtype"), "non_null")


def unknown_ratio(info: DataFrame, specs: dict[str, int] | None = None) -> DataFrame:
    """A2/A3/PF4: share of rows whose code is null or the 'unknown' code."""
    specs = specs or {"age_range": 0, "gender": 2}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c, code in specs.items():
        aggs += [F.count(c).alias(f"{c}_non_null"),
                 F.count_if(F.col(c) == code).alias(f"{c}_unknown_code"),
                 F.avg((F.col(c).isNull() | (F.col(c) == code)).cast("double")).alias(f"{c}_unknown_ratio")]
    return info.agg(*aggs)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """A4: count, mean, sample std, min, quartiles (linear interpolation), max per column.

    Quartiles are exact order statistics from the range-sorted values
    (``exact_quantiles``), not a per-value map merged in one task.
    """
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        q = exact_quantiles(df, c, [0.25, 0.5, 0.75])
        parts.append(df.agg(
            F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
            q.select("q0").scalar().alias("p25"), q.select("q1").scalar().alias("p50"),
            q.select("q2").scalar().alias("p75"), F.max(x).alias("max")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def group_count(df: DataFrame, key: str, counted: str = "user_id", name: str = "n") -> DataFrame:
    """A5: ``groupby(key)[counted].count()`` (null keys dropped, N1)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(counted).alias(name))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Frequency table with share of all non-null keys (total as a scalar subquery)."""
    d = df.where(F.col(key).isNotNull())
    total = d.select(F.count(F.lit(1))).scalar()
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


def rate_by(df: DataFrame, key: str, label: str = "label", lo_open: float = 0.0,
            hi_closed: float = 1.0) -> DataFrame:
    """A7 + PF6: mean label per key, keeping lo < rate <= hi (HAVING)."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("rate"))
    return g.where((F.col("rate") > lo_open) & (F.col("rate") <= hi_closed))


def crosstab(df: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Two-way counts (countplot with hue) in long form."""
    return (df.where(F.col(key).isNotNull()).groupBy(key, label)
            .agg(F.count(F.lit(1)).alias("n")))


def top_k(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """S3: ``value_counts().head(k)``; ties broken by key (TakeOrderedAndProject)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(key).asc()).limit(k))


def topk_members(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """PF7: rows whose key is among the top k -- a semi join with a k-row table."""
    return df.join(F.broadcast(top_k(df, key, k).select(key)), key, "left_semi")


# ---------------------------------------------------------------- distributions

def norm_fit(values: DataFrame, x: str = "x") -> DataFrame:
    """DA2: normal fit -- mean and population std."""
    return values.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))


def fd_histogram(values: DataFrame, x: str = "x", max_bins: int = 50) -> DataFrame:
    """DA1: Freedman-Diaconis histogram (bins capped at ``max_bins``), equal widths.

    Output: bin, lo, hi, n, density -- every bin, empty ones included. The
    one-row statistics (count, min, max, exact quartiles, bin count, width)
    are read once and enter the bucketing pass as literals.
    """
    v = _materialize(values, x)
    q = exact_quantiles(v, x, [0.25, 0.75])
    st = v.agg(F.count(x).alias("cnt"), F.min(x).alias("mn"), F.max(x).alias("mx"))
    h = F.lit(2.0) * (F.col("q1") - F.col("q0")) / F.pow(F.col("cnt"), F.lit(1.0) / F.lit(3.0))
    nb = (F.when(F.col("cnt") < 2, F.lit(1))
          .when(h == 0, F.floor(F.sqrt(F.col("cnt"))))
          .otherwise(F.ceil((F.col("mx") - F.col("mn")) / h)))
    qr = q.first()  # one row: the two quartiles
    one = st.withColumn("q0", F.lit(qr["q0"])).withColumn("q1", F.lit(qr["q1"]))
    one = one.withColumn("nb", F.greatest(F.lit(1), F.least(F.lit(max_bins), nb.cast("int"))))
    one = one.withColumn("w", (F.col("mx") - F.col("mn")) / F.col("nb")).first()
    mn, w, nb_, cnt = one["mn"], one["w"], one["nb"], one["cnt"]
    if not cnt:  # no values: no bins
        return v.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint, density double")
    bucket = (F.lit(0) if w == 0 else
              F.least(F.floor((F.col(x) - F.lit(mn)) / F.lit(w)), F.lit(nb_ - 1))).cast("int")
    counts = v.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = v.sparkSession.range(nb_).select(F.col("id").cast("int").alias("bin"))
    out = bins.join(counts, "bin", "left").select(
        "bin", (F.lit(mn) + F.col("bin") * F.lit(w)).alias("lo"),
        (F.lit(mn) + (F.col("bin") + 1) * F.lit(w)).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    return out.withColumn("density", F.col("n") / F.lit(cnt * w) if w > 0 else F.lit(None).cast("double"))


def kde(values: DataFrame, x: str = "x", gridsize: int = 100, cut: float = 3.0) -> DataFrame:
    """DA3: Gaussian KDE on a fixed grid, Scott's bandwidth n^(-1/5) * sample std.

    Each value emits its contribution to the fixed-size grid (a bounded
    generator, not a cross join); contributions are summed per grid point
    with partial aggregation.
    """
    values = _materialize(values, x)
    st = values.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("mn"),
                    F.max(x).alias("mx"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n"), -0.2))
    st = st.withColumn("lo", F.col("mn") - cut * F.col("bw")).withColumn("hi", F.col("mx") + cut * F.col("bw"))
    row = st.first()  # one row of statistics
    if not row["bw"]:  # fewer than two values or no spread: the density is undefined
        return values.sparkSession.createDataFrame([], "grid int, x double, density double")
    bw, lo, hi, n = (F.lit(row[c]) for c in ("bw", "lo", "hi", "n"))
    step = (hi - lo) / (gridsize - 1)
    g = F.col("g")
    # distinct values first: the generator runs once per value, not once per row
    distinct = values.where(F.col(x).isNotNull()).groupBy(F.col(x).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    contrib = distinct.select("v", "c", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("g"))
    z = ((lo + g * step) - F.col("v")) / bw
    dens = contrib.groupBy("g").agg(F.sum(F.exp(-0.5 * z * z) * F.col("c")).alias("s"))
    return dens.select(F.col("g").cast("int").alias("grid"), (lo + g * step).alias("x"),
                       (F.col("s") / (n * bw * F.sqrt(F.lit(2 * 3.141592653589793)))).alias("density"))


def probplot_points(values: DataFrame, x: str = "x") -> DataFrame:
    """DA4: ordered values with Filliben plotting positions and normal quantiles."""
    v = value_positions(values, x)
    n = F.lit(v.agg(F.max("_upto")).first()[0] or 0)
    # ranks of a value in slices of 10,000, dealt over tasks: a value that fills the table is not one task's work
    lo = F.col("_upto") - F.col("_n") + 1
    slices = v.select("_x", "_upto", F.explode(F.sequence(lo, F.col("_upto"), F.lit(10_000).cast("long"))).alias("a"))
    pos = slices.repartition("_x", "a").select(
        F.col("_x").alias(x), F.explode(F.sequence("a", F.least(F.col("a") + 9_999, F.col("_upto")))).alias("i"))
    m = F.expr(filliben_sql("i", "n"))
    return (pos.withColumn("n", n).withColumn("m", m)
            .select(F.col("i").alias("rank"), F.col(x).alias("value"),
                    F.expr(norm_ppf_sql("m")).alias("quantile")))


def probplot_fit(values: DataFrame, x: str = "x") -> DataFrame:
    """DA4: least-squares line through (quantile, value) and its correlation r."""
    p = probplot_points(values, x)
    return p.agg(F.count(F.lit(1)).alias("n"), F.regr_slope("value", "quantile").alias("slope"),
                 F.regr_intercept("value", "quantile").alias("intercept"),
                 F.corr("quantile", "value").alias("r"))
