"""Deterministic folds and splits (K1-K6) as columns.

Randomness comes from ``md5(key, seed)``: the same key and seed always land
in the same fold, whatever the partitioning (``randomSplit`` depends on the
partition layout, so it is not used). Fold sizes follow the reference's
splitters exactly: K-fold blocks of n//k (+1 for the first n%k folds) over
the shuffled order; stratified folds use the per-class allocation of a
round-robin over the label-sorted rows. A fold is a range of that order, so
only the order's values at the k - 1 fold borders are looked up (from counts
per digest prefix); the fold is then a column expression, and no row with its
feature vector is sorted, shuffled or written. Keys are unique; rows that
share a key share a fold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.plans.ranking import order_cuts, with_global_position

KEYS = ("user_id", "merchant_id")


def shuffle_key(keys=KEYS, seed: int | str = 0) -> Column:
    return F.md5(F.concat_ws("_", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _starts(n: int, k: int) -> list[int]:
    """First positions of folds 1 .. k - 1: blocks of n // k, one more in the first n % k."""
    q, r = divmod(n, k)
    return [i * q + min(i, r) for i in range(1, k)]


def _fold_of(h: Column, cuts: list, name: str) -> Column:
    """The number of fold borders at or before ``h``."""
    return sum(((h >= c).cast("int") for c in cuts if c is not None), F.lit(0)).cast("int").alias(name)


def _key_cuts(df: DataFrame, keys, positions: list[int]) -> list[Column | None]:
    """The key at each 0-based position of the order by key (only keys are ranked)."""
    pos = with_global_position(df.select(*keys), [F.col(c) for c in keys], "_p")
    want = [p + 1 for p in positions]
    at = {r["_p"]: r for r in pos.where(F.col("_p").isin(want)).collect()}  # k - 1 rows
    return [F.struct(*[F.lit(at[p][c]).alias(c) for c in keys]) if p in at else None for p in want]


def _cuts(df: DataFrame, keys, seed, shuffle: bool, positions: list[int]) -> tuple[Column, list]:
    if shuffle:
        h = shuffle_key(keys, seed)
        return h, order_cuts(df, h, positions)
    return F.struct(*[F.col(c) for c in keys]), _key_cuts(df, keys, positions)


def kfold(df: DataFrame, k: int = 5, keys=KEYS, seed: int = 0, shuffle: bool = True,
          name: str = "fold") -> DataFrame:
    """K1 (shuffle=True) / K2 (contiguous blocks in key order)."""
    h, cuts = _cuts(df, keys, seed, shuffle, _starts(df.count(), k))
    return df.select("*", _fold_of(h, cuts, name))


def stratified_kfold(df: DataFrame, k: int = 5, label: str = "label", keys=KEYS, seed: int = 1,
                     shuffle: bool = True, name: str = "fold") -> DataFrame:
    """K3: per-class contiguous blocks whose sizes follow a round-robin over label-sorted rows."""
    sizes = sorted((r[label], r["n"]) for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect())
    fold, start = F.lit(None).cast("int"), 0
    for value, n in sizes:  # one pass per class
        upto = lambda x, i: (x - i + k - 1) // k  # noqa: E731  rows p in [0, x) with p % k == i
        parts = [upto(start + n, i) - upto(start, i) for i in range(k)]
        h, cuts = _cuts(df.where(F.col(label) == F.lit(value)), keys, seed, shuffle,
                        [sum(parts[:i]) for i in range(1, k)])
        fold = F.when(F.col(label) == F.lit(value), _fold_of(h, cuts, "f")).otherwise(fold)
        start += n
    return df.select("*", fold.alias(name))


def train_test_split(df: DataFrame, test_size: float = 0.25, keys=KEYS, seed: int = 0,
                     name: str = "is_test") -> DataFrame:
    """K5: the first ceil(test_size * n) rows in md5(key, seed) order are the test part."""
    h, (cut,) = _cuts(df, keys, seed, True, [math.ceil(df.count() * test_size)])
    return df.withColumn(name, F.lit(True) if cut is None else h < cut)


def shuffle_split(df: DataFrame, n_splits: int = 5, test_size: float = 0.3, keys=KEYS,
                  name: str = "is_test") -> DataFrame:
    """K4: ``n_splits`` independent train/test splits (``repeat`` = seed)."""
    at = [math.ceil(df.count() * test_size)]
    parts = []
    for r in range(n_splits):
        h, (cut,) = _cuts(df, keys, r, True, at)
        parts.append(F.struct(F.lit(r).alias("repeat"), (F.lit(True) if cut is None else h < cut).alias(name)))
    return df.select(*keys, F.explode(F.array(*parts)).alias("_s")).select(*keys, "_s.*")


# The distribution function of the Poisson law with mean 1, up to the largest count whose
# share is above 2 ** -52, the step of the uniform numbers below.
POISSON_CDF = tuple(math.exp(-1) * sum(1 / math.factorial(i) for i in range(j + 1)) for j in range(18))


def bootstrap_count(bag: int | Column, keys=KEYS) -> Column:
    """K6: how often the bootstrap of ``bag`` draws a row, from its keys alone.

    In a bootstrap of n of n rows a row's count tends to the Poisson law with mean 1. The count is
    that law's inverse at a uniform number made of the first 52 bits of ``md5(keys, bag)``: the same
    for any partitioning and order, and rows with equal keys get equal counts.
    """
    digest = F.md5(F.concat_ws("_", *[F.col(k).cast("string") for k in keys], F.concat(F.lit("bag"), F.lit(bag).cast("string"))))
    u = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)
    # bound to one variable: the digest is computed once a row, not once a step of the law
    steps = lambda v: sum(((v >= c).cast("int") for c in POISSON_CDF), F.lit(0)).cast("int")
    return F.transform(F.array(u), steps)[0]
