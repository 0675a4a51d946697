"""Registered queries: folds and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsignal.operators import folds as fo
from shopsignal.plans.registry import register
from shopsignal.sources import fixtures as fx

W = fx.with_fixtures


def md5_sql(seed: str) -> str:
    return f"md5(CAST(user_id AS VARCHAR) || '_' || CAST(merchant_id AS VARCHAR) || '_' || {seed})"


def block_sql(p0="p0", n="n", k=5) -> str:
    q, r = f"({n} // {k})", f"({n} % {k})"
    return (f"CAST(CASE WHEN {p0} < {r} * ({q} + 1) THEN {p0} // ({q} + 1) "
            f"ELSE {r} + ({p0} - {r} * ({q} + 1)) // {q} END AS INT)")


KFOLD_CTE = (f"kf AS (SELECT user_id, merchant_id, label, row_number() OVER (ORDER BY {md5_sql(chr(39) + '0' + chr(39))}) - 1 "
             "AS p0, count(*) OVER () AS n FROM train),\n"
             f"kfold AS (SELECT user_id, merchant_id, label, {block_sql()} AS fold FROM kf)")


@register("kfold", sql=W("SELECT * FROM kfold", KFOLD_CTE))
def kfold(spark, sf):
    return fo.kfold(fx.shared_train(spark, sf), 5, seed=0, shuffle=True)


@register("kfold_blocks", sql=W(
    f"SELECT user_id, merchant_id, label, {block_sql()} AS fold FROM (SELECT *, row_number() OVER "
    "(ORDER BY user_id, merchant_id) - 1 AS p0, count(*) OVER () AS n FROM train)"))
def kfold_blocks(spark, sf):
    return fo.kfold(fx.shared_train(spark, sf), 5, shuffle=False)


STRAT_SQL = W(
    "SELECT sk.user_id, sk.merchant_id, sk.label, CAST((SELECT count(*) FROM cb WHERE cb.label = sk.label "
    "AND cb.hi <= sk.q) AS INT) AS fold FROM sk",
    f"""sk AS (SELECT user_id, merchant_id, label,
           row_number() OVER (PARTITION BY label ORDER BY {md5_sql("'1'")}) - 1 AS q FROM train),
cl AS (SELECT label, count(*) AS nc FROM train GROUP BY label),
cl2 AS (SELECT label, nc, COALESCE(sum(nc) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
        FROM cl),
al AS (SELECT label, i, floor((st + nc - i + 4) / 5) - floor((st - i + 4) / 5) AS a
       FROM cl2, (SELECT unnest(range(0, 5)) AS i) r),
cb AS (SELECT label, i, sum(a) OVER (PARTITION BY label ORDER BY i) AS hi FROM al)""")


@register("stratified_kfold", sql=STRAT_SQL)
def stratified_kfold(spark, sf):
    return fo.stratified_kfold(fx.shared_train(spark, sf), 5, seed=1, shuffle=True)


@register("train_test_split", sql=W(
    f"SELECT user_id, merchant_id, label, row_number() OVER (ORDER BY {md5_sql(chr(39) + '0' + chr(39))}) "
    "<= ceil(0.25e0 * count(*) OVER ()) AS is_test FROM train"))
def train_test_split(spark, sf):
    return fo.train_test_split(fx.shared_train(spark, sf), 0.25, seed=0)


@register("shuffle_split", sql=W(
    f"SELECT user_id, merchant_id, CAST(r AS BIGINT) AS repeat, row_number() OVER (PARTITION BY r ORDER BY "
    f"{md5_sql('CAST(r AS VARCHAR)')}) <= ceil(0.3e0 * count(*) OVER (PARTITION BY r)) AS is_test "
    "FROM train, (SELECT unnest(range(0, 5)) AS r) rr"))
def shuffle_split(spark, sf):
    s = fo.shuffle_split(fx.shared_train(spark, sf), 5, 0.3)
    return s.withColumn("repeat", F.col("repeat").cast("long"))


BAGS = 3
_U = "('0x' || substr(md5(CAST(user_id AS VARCHAR) || '_' || CAST(merchant_id AS VARCHAR) || '_bag' || bag), 1, 13))::BIGINT::DOUBLE / 4503599627370496"


@register("bootstrap_counts", sql=W(
    f"SELECT user_id, merchant_id, bag, CAST({' + '.join(f'CASE WHEN u >= {c!r}::DOUBLE THEN 1 ELSE 0 END' for c in fo.POISSON_CDF)} AS INT) AS draws "
    f"FROM (SELECT *, {_U} AS u FROM train, (SELECT unnest(range({BAGS}))::INT AS bag))"))
def bootstrap_counts(spark, sf):
    """K6: how often each of three bootstraps draws a pair."""
    bags = F.explode(F.array(*[F.lit(b) for b in range(BAGS)])).alias("bag")
    return fx.train(spark, sf).select("user_id", "merchant_id", bags).withColumn("draws", fo.bootstrap_count(F.col("bag")))
