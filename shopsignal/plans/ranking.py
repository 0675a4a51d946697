"""Skew-safe ordinal positions and prefix sums.

An unpartitioned ``row_number()`` window (or one partitioned by a key that
holds a third of the rows) sorts everything in a single task. Instead:

1. sort with range partitioning -- Spark samples the sort key, so even one
   hot group is spread over many partitions;
2. number rows inside each partition (``monotonically_increasing_id`` is
   ``partition_index << 33 | row_in_partition`` after the sort);
3. count rows per (group, partition) -- at most #groups + #partitions rows --
   and turn the counts into offsets with a window over that small table;
4. add the offset back. For a global order the offsets table has one row per
   partition, so broadcasting it is bounded by the partition count.

The numbered rows are read twice (counts and the rows themselves), and the
range bounds come from sampling an input whose row order after a shuffle is
not fixed. The numbered rows are therefore checkpointed once into the shared
``spark.checkpoint.dir``: both readers see the same layout, and a lost
executor re-reads the checkpoint instead of re-sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignal.session import ensure_checkpoint_dir

_ROW_BITS = 33


def _sorted_with_ids(df: DataFrame, order: list, keep: list[str] | None = None) -> DataFrame:
    mid = F.monotonically_increasing_id()
    s = (df.orderBy(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_rid", mid - F.shiftleft(F.spark_partition_id().cast("long"), _ROW_BITS)))
    if keep is not None:  # what only the order needs is not written
        s = s.select(*keep, "_pid", "_rid")
    ensure_checkpoint_dir(df.sparkSession)
    return s.checkpoint(eager=True)


def with_global_position(df: DataFrame, order: list, name: str = "pos") -> DataFrame:
    """1-based position of each row in the total order ``order``."""
    s = _sorted_with_ids(df, order)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a single-task window and a broadcast of bounded size
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).select("_pid", "_off")
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_off") + F.col("_rid") + 1)
            .drop("_pid", "_rid", "_off"))


def with_group_position(df: DataFrame, group: list[str], order: list, name: str = "pos", keep: list[str] | None = None) -> DataFrame:
    """1-based position of each row inside its group, ordered by ``order``; with ``keep`` only these columns and the group's."""
    keep = keep if keep is None else [*group, *[c for c in keep if c not in group]]
    s = _sorted_with_ids(df, [F.col(g) for g in group] + list(order), keep)
    seg = s.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_r0"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    # seg has at most #groups + #partitions rows; AQE broadcasts it when its
    # measured size is under the threshold and shuffles otherwise.
    return (s.join(seg, [*group, "_pid"])
            .withColumn(name, F.col("_off") + F.col("_rid") - F.col("_r0") + 1)
            .drop("_pid", "_rid", "_r0", "_off"))


def with_dense_codes(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """Distinct values of ``col`` with 0-based codes in ascending order (dense rank - 1)."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return with_global_position(d, [F.col(col).asc()], "_p").select(col, (F.col("_p") - 1).alias(name))


def with_prefix_sum(df: DataFrame, order: list, value: str, name: str = "cum",
                    inclusive: bool = True) -> DataFrame:
    """Running sum of ``value`` in the total order ``order`` (ties broken arbitrarily)."""
    s = _sorted_with_ids(df, order)
    parts = s.groupBy("_pid").agg(F.sum(value).alias("_s"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = parts.withColumn("_off", F.coalesce(F.sum("_s").over(w), F.lit(0))).select("_pid", "_off")
    end = Window.currentRow if inclusive else -1
    wi = Window.partitionBy("_pid").orderBy("_rid").rowsBetween(Window.unboundedPreceding, end)
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_off") + F.coalesce(F.sum(value).over(wi), F.lit(0)))
            .drop("_pid", "_rid", "_off"))


def value_positions(df: DataFrame, x: str) -> DataFrame:
    """Distinct values of ``x`` with their count and last position: (_x, _n, _upto).

    Equal values are combined before the range sort, so a value that makes up
    most rows is one row here and not one task.
    """
    v = df.select(F.col(x).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    return with_prefix_sum(v.groupBy("_x").agg(F.count(F.lit(1)).alias("_n")), [F.col("_x").asc()], "_n", "_upto")


def exact_quantiles(df: DataFrame, x: str, probs: list[float], prefix: str = "q") -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics (h = (n - 1) p).

    Order statistics are read off the running counts of the distinct values.
    Output: one row with ``{prefix}0 .. {prefix}{k-1}``.
    """
    pos = value_positions(df, x)
    n = F.lit(pos.agg(F.max("_upto")).first()[0] or 0)  # from the checkpointed rows
    aggs = []
    for j, p in enumerate(probs):
        h = (n - 1) * F.lit(float(p))
        lo = F.floor(h)
        # the value at 1-based position i is the smallest one whose running count reaches i
        a = F.min(F.when(F.col("_upto") >= lo + 1, F.col("_x")))
        b = F.min(F.when(F.col("_upto") >= lo + 2, F.col("_x")))
        aggs.append((a + (h - lo) * (F.coalesce(b, a) - a)).alias(f"{prefix}{j}"))
    return pos.agg(*aggs)


def order_cuts(df: DataFrame, key: Column, positions: list[int], step: int = 4, most: int = 10_000) -> list[str | None]:
    """The hex-digest ``key`` of the row at each 0-based position of the order by ``key``.

    Counts per prefix of ``step`` digits (at most 16 ** step rows) locate each
    position; its bucket is then counted by the next digits, until it has at
    most ``most`` rows. No rows are sorted or moved. None beyond the last row.
    """
    keys = df.select(key.alias("k"))

    def find(prefix: str, at: int, hist: list) -> str | None:
        for p, c in hist:
            if at < c:
                if c <= most or len(p) >= 32:
                    rows = keys.where(F.col("k").startswith(p)).orderBy("k").limit(at + 1)
                    return rows.agg(F.max("k")).first()[0]
                return find(p, at, _histogram(keys, p, step))
            at -= c
        return None

    top = _histogram(keys, "", step)
    return [find("", at, top) for at in positions]


def _histogram(keys: DataFrame, prefix: str, step: int) -> list:
    k = keys.where(F.col("k").startswith(prefix)) if prefix else keys
    h = k.groupBy(F.substring("k", 1, len(prefix) + step).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    return sorted((r["p"], r["c"]) for r in h.collect())  # at most 16 ** step rows
