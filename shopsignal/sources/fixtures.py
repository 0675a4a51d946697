"""The reference's four input tables, derived from the TPC-H-like test data.

Definitions follow FIXTURES.md section 2. Each builder reads only the columns
it needs; filters on scan columns are written so they reach the parquet
reader. On a cluster the same builders run over the full tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignal.sources.tables import read_table

# Fixed values of the fixture definition (FIXTURES.md): first year of the day
# code, days per year / month of the day code, the label cut year, and the
# segment -> age_range mapping.
BASE_YEAR = 1995
DAYS_PER_YEAR = 372
DAYS_PER_MONTH = 31
CUT_YEAR = 1999
CUT_DAY = (CUT_YEAR - BASE_YEAR) * DAYS_PER_YEAR + 1  # first day code of the cut year: 1489
AGE_BY_SEGMENT = {"HOUSEHOLD": 0, "BUILDING": 2, "MACHINERY": 3, "AUTOMOBILE": 4}

# Event order inside a user's history (total up to identical events).
EVENT_ORDER = ("time_stamp", "item_id", "seller_id", "action_type", "cat_id", "brand_id")
LOG_COLUMNS = ("user_id", "item_id", "cat_id", "seller_id", "brand_id", "time_stamp", "action_type")
TOKEN_COLUMNS = {"seller": "seller_id", "cat": "cat_id", "brand": "brand_id",
                 "item": "item_id", "action_type": "action_type"}

# action_type codes
CLICK, ADD_CART, BUY, ADD_FAV = "0", "1", "2", "3"


def day_code(ts: Column) -> Column:
    return ((F.year(ts) - BASE_YEAR) * DAYS_PER_YEAR + (F.month(ts) - 1) * DAYS_PER_MONTH
            + F.dayofmonth(ts)).cast("int")


def _cut_ts() -> Column:
    return F.to_timestamp_ntz(F.lit(f"{CUT_YEAR}-01-01 00:00:00"))


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")


def line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's customer and date: the join both the log and the pairs need."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_returnflag", "l_linestatus")
    o = _orders(spark, sf_dir)
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "o_custkey", "o_orderdate")


def shared_line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_orders`` computed once and checkpointed, for plans that read it twice."""
    from shopsignal.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return line_orders(spark, sf_dir).checkpoint(eager=True)


def user_log_all(spark: SparkSession, sf_dir: str, before_cut: bool = False,
                 lo: DataFrame | None = None) -> DataFrame:
    """One row per order line: user_log(user_id, item_id, cat_id, seller_id, brand_id, time_stamp, action_type).

    ``lo``: a precomputed ``line_orders`` (e.g. ``shared_line_orders``) instead of joining again.
    """
    if lo is None:
        li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                        "l_returnflag", "l_linestatus")
        o = _orders(spark, sf_dir)
        if before_cut:
            # same as time_stamp < CUT_DAY, but on the raw column so it is pushed to the scan
            o = o.where(F.col("o_orderdate") < _cut_ts())
        lo = li.join(o, li.l_orderkey == o.o_orderkey)
    elif before_cut:
        lo = lo.where(F.col("o_orderdate") < _cut_ts())
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand")
    j = lo.join(p, lo.l_partkey == p.p_partkey)
    action = (F.when(F.col("l_returnflag") == "N", F.lit(CLICK))
              .when(F.col("l_returnflag") == "R", F.lit(ADD_FAV))
              .when(F.col("l_linestatus") == "O", F.lit(ADD_CART))
              .otherwise(F.lit(BUY)))
    return j.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("p_type").alias("cat_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(F.col("p_partkey") % 20 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("brand_id"),
        day_code(F.col("o_orderdate")).alias("time_stamp"),
        action.alias("action_type"),
    )


def user_log(spark: SparkSession, sf_dir: str, lo: DataFrame | None = None) -> DataFrame:
    """History before the label period (time_stamp < CUT_DAY)."""
    return user_log_all(spark, sf_dir, before_cut=True, lo=lo)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    age = F.lit(None).cast("int")
    for seg, code in AGE_BY_SEGMENT.items():
        age = F.when(F.col("c_mktsegment") == seg, F.lit(code)).otherwise(age)
    g = F.col("c_nationkey") % 4
    return c.select(F.col("c_custkey").alias("user_id"), age.cast("int").alias("age_range"),
                    F.when(g < 3, g).cast("int").alias("gender"))


def pairs(spark: SparkSession, sf_dir: str, lo: DataFrame | None = None) -> DataFrame:
    """(user_id, merchant_id, label): bought before the cut; label = bought again after it.

    One scan and one aggregation keyed by the pair, instead of two DISTINCT
    scans and a join: the partial aggregate collapses repeats map-side.
    """
    if lo is None:
        li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
        o = _orders(spark, sf_dir)
        lo = li.join(o, li.l_orderkey == o.o_orderkey)
    before = F.col("o_orderdate") < _cut_ts()
    g = (lo
         .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("merchant_id"))
         .agg(F.max(before.cast("int")).alias("h"), F.max((~before).cast("int")).alias("f")))
    return g.where(F.col("h") == 1).select("user_id", "merchant_id", F.col("f").cast("int").alias("label"))


def _is_test(df: DataFrame) -> Column:
    return (df.user_id * 7 + df.merchant_id) % 5 == 0


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return p.where(~_is_test(p)).select("user_id", "merchant_id", "label")


def shared_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``train`` computed once and checkpointed (three short columns), for plans that read it several times."""
    from shopsignal.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return train(spark, sf_dir).checkpoint(eager=True)


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return p.where(_is_test(p)).select("user_id", "merchant_id", F.lit(None).cast("double").alias("prob"))


def all_pairs(spark: SparkSession, sf_dir: str, lo: DataFrame | None = None) -> DataFrame:
    """Train.append(test) in one pass -- label null on test rows, prob null on train rows.

    Two filtered copies of ``pairs`` would scan and aggregate the fact tables
    twice (the split filter is pushed below the aggregate, so the exchanges
    are not reused); one pass with conditional columns does not.
    """
    p = pairs(spark, sf_dir, lo)
    t = _is_test(p)
    return p.select("user_id", "merchant_id",
                    F.when(~t, F.col("label")).cast("int").alias("label"),
                    F.lit(None).cast("double").alias("prob"))


# ---------------------------------------------------------------------------
# The same views as SQL text (DuckDB dialect), used by the oracle queries.
# ---------------------------------------------------------------------------
FIXTURE_CTES = """
user_log_all AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, p_type AS cat_id, l_suppkey AS seller_id,
    CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_brand END AS brand_id,
    CAST((year(o_orderdate) - 1995) * 372 + (month(o_orderdate) - 1) * 31 + day(o_orderdate) AS INT) AS time_stamp,
    CASE WHEN l_returnflag = 'N' THEN '0' WHEN l_returnflag = 'R' THEN '3'
         WHEN l_linestatus = 'O' THEN '1' ELSE '2' END AS action_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
user_log AS (SELECT * FROM user_log_all WHERE time_stamp < 1489),
user_info AS (
  SELECT c_custkey AS user_id,
    CAST(CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'BUILDING' THEN 2 WHEN 'MACHINERY' THEN 3
                      WHEN 'AUTOMOBILE' THEN 4 END AS INT) AS age_range,
    CAST(CASE WHEN c_nationkey % 4 < 3 THEN c_nationkey % 4 END AS INT) AS gender
  FROM customer),
pairs AS (
  SELECT h.user_id, h.merchant_id, CAST(CASE WHEN f.user_id IS NULL THEN 0 ELSE 1 END AS INT) AS label
  FROM (SELECT DISTINCT o_custkey AS user_id, l_suppkey AS merchant_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) < 1999) h
  LEFT JOIN (SELECT DISTINCT o_custkey AS user_id, l_suppkey AS merchant_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) >= 1999) f
  ON h.user_id = f.user_id AND h.merchant_id = f.merchant_id),
train AS (SELECT user_id, merchant_id, label FROM pairs WHERE (user_id * 7 + merchant_id) % 5 <> 0),
test AS (SELECT user_id, merchant_id, CAST(NULL AS DOUBLE) AS prob FROM pairs WHERE (user_id * 7 + merchant_id) % 5 = 0),
all_pairs AS (
  SELECT user_id, merchant_id, label, CAST(NULL AS DOUBLE) AS prob FROM train
  UNION ALL SELECT user_id, merchant_id, CAST(NULL AS INT) AS label, prob FROM test)
"""


def with_fixtures(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix a SELECT with the fixture views as CTEs."""
    ctes = FIXTURE_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return "WITH " + ctes + "\n" + sql_body
