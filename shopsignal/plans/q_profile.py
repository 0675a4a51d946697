"""Registered queries: profiling, rates, counts, distributions, narrowing."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsignal.functions import narrowing as nw
from shopsignal.functions.stats import filliben_sql, norm_ppf_sql, sanitize
from shopsignal.operators import profile as pr
from shopsignal.plans.ranking import with_dense_codes
from shopsignal.plans.registry import register, rounded
from shopsignal.sources import fixtures as fx
from shopsignal.sources.tables import read_table

W = fx.with_fixtures


def _train_info(spark, sf):
    return fx.train(spark, sf).join(fx.user_info(spark, sf), "user_id", "left")


TRAIN_INFO = "train_info AS (SELECT t.*, i.age_range, i.gender FROM train t LEFT JOIN user_info i ON t.user_id = i.user_id)"

# ---------------------------------------------------------------- A1 / SC1 / A3 / A4


@register("null_counts", sql=W("SELECT " + ", ".join(
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}_nulls" for c in fx.LOG_COLUMNS) + " FROM user_log_all"))
def null_counts(spark, sf):
    return pr.null_counts(fx.user_log_all(spark, sf))


@register("table_info", sql=W(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", any_value(typeof({c})) AS dtype, count({c}) AS non_null FROM user_log_all"
    for c in fx.LOG_COLUMNS)))
def table_info(spark, sf):
    return pr.table_info(fx.user_log_all(spark, sf))


@register("unknown_ratio", sql=W(
    "SELECT count(*) AS rows, " + ", ".join(
        f"count({c}) AS {c}_non_null, CAST(count_if({c} = {k}) AS BIGINT) AS {c}_unknown_code, "
        f"ROUND(avg(CASE WHEN {c} IS NULL OR {c} = {k} THEN 1.0 ELSE 0.0 END), 6) AS {c}_unknown_ratio"
        for c, k in (("age_range", 0), ("gender", 2))) + " FROM user_info"))
def unknown_ratio(spark, sf):
    return rounded(pr.unknown_ratio(fx.user_info(spark, sf)))


@register("describe_profile", sql=W(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(x) AS count, ROUND(avg(x), 6) AS mean, ROUND(stddev_samp(x), 6) AS std, "
    f"ROUND(min(x), 6) AS min, ROUND(quantile_cont(x, 0.25), 6) AS p25, ROUND(quantile_cont(x, 0.5), 6) AS p50, "
    f"ROUND(quantile_cont(x, 0.75), 6) AS p75, ROUND(max(x), 6) AS max "
    f"FROM (SELECT CAST({c} AS DOUBLE) AS x FROM user_info)"
    for c in ("age_range", "gender"))))
def describe_profile(spark, sf):
    return rounded(pr.describe(fx.user_info(spark, sf), ["age_range", "gender"]))


# ---------------------------------------------------------------- A5 / A6 / S3 / PF7


@register("label_counts", sql=W("SELECT label, count(user_id) AS n FROM train GROUP BY label"))
def label_counts(spark, sf):
    return pr.group_count(fx.train(spark, sf), "label")


@register("value_counts", sql=W(
    "SELECT merchant_id, count(*) AS n, ROUND(count(*) / (SELECT count(*) FROM train), 6) AS share "
    "FROM train GROUP BY merchant_id"))
def value_counts(spark, sf):
    return rounded(pr.value_counts(fx.train(spark, sf), "merchant_id"))


@register("top_merchants", sql=W(
    "SELECT merchant_id, count(*) AS n FROM train GROUP BY merchant_id ORDER BY n DESC, merchant_id LIMIT 5"))
def top_merchants(spark, sf):
    return pr.top_k(fx.train(spark, sf), "merchant_id", 5)


@register("topk_members", sql=W(
    "SELECT * FROM train WHERE merchant_id IN (SELECT merchant_id FROM train GROUP BY merchant_id "
    "ORDER BY count(*) DESC, merchant_id LIMIT 5)"))
def topk_members(spark, sf):
    return pr.topk_members(fx.train(spark, sf), "merchant_id", 5)


# ---------------------------------------------------------------- A7 + PF6, A8

RATE_KEYS = {"merchant": ("merchant_id", False), "user": ("user_id", False),
             "gender": ("gender", True), "age": ("age_range", True)}


def _reg_rate(suffix, key, needs_info):
    src = "train_info" if needs_info else "train"
    sql = W(f"SELECT {key}, ROUND(avg(CAST(label AS DOUBLE)), 6) AS rate FROM {src} WHERE {key} IS NOT NULL "
            f"GROUP BY {key} HAVING avg(CAST(label AS DOUBLE)) > 0 AND avg(CAST(label AS DOUBLE)) <= 1",
            TRAIN_INFO)

    @register(f"repeat_rate_{suffix}", sql=sql)
    def q(spark, sf):
        df = _train_info(spark, sf) if needs_info else fx.train(spark, sf)
        return rounded(pr.rate_by(df, key))


def _reg_crosstab(suffix, key, needs_info):
    src = "train_info" if needs_info else "train"
    sql = W(f"SELECT {key}, label, count(*) AS n FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}, label",
            TRAIN_INFO)

    @register(f"crosstab_{suffix}", sql=sql)
    def q(spark, sf):
        df = _train_info(spark, sf) if needs_info else fx.train(spark, sf)
        return pr.crosstab(df, key)


for _s, (_k, _i) in RATE_KEYS.items():
    _reg_rate(_s, _k, _i)
    if _s != "user":
        _reg_crosstab(_s, _k, _i)


# ---------------------------------------------------------------- DA1-DA4 on repeat rates

def _rates(spark, sf, key):
    return pr.rate_by(fx.train(spark, sf), key).select(F.col("rate").alias("x"))


def _rates_cte(key):
    return (f"r AS (SELECT avg(CAST(label AS DOUBLE)) AS x FROM train GROUP BY {key} "
            f"HAVING avg(CAST(label AS DOUBLE)) > 0 AND avg(CAST(label AS DOUBLE)) <= 1)")


def _hist_sql(key):
    ctes = _rates_cte(key) + """,
hs AS (SELECT count(x) AS cnt, min(x) AS mn, max(x) AS mx, quantile_cont(x, 0.25) AS q1,
              quantile_cont(x, 0.75) AS q3 FROM r),
hs2 AS (SELECT *, GREATEST(1, LEAST(50, CAST(CASE WHEN cnt < 2 THEN 1
          WHEN 2.0e0 * (q3 - q1) / pow(cnt, 1.0e0 / 3.0e0) = 0 THEN floor(sqrt(cnt))
          ELSE ceil((mx - mn) / (2.0e0 * (q3 - q1) / pow(cnt, 1.0e0 / 3.0e0))) END AS INT))) AS nb FROM hs),
hs3 AS (SELECT *, (mx - mn) / nb AS w FROM hs2),
hc AS (SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE LEAST(floor((x - mn) / w), nb - 1) END AS INT) AS bin,
              count(*) AS n FROM r, hs3 GROUP BY 1),
hb AS (SELECT CAST(unnest(range(0, nb)) AS INT) AS bin FROM hs3)"""
    return W("""SELECT hb.bin, ROUND(mn + hb.bin * w, 6) AS lo, ROUND(mn + (hb.bin + 1) * w, 6) AS hi,
  COALESCE(hc.n, 0) AS n, ROUND(CASE WHEN w > 0 THEN COALESCE(hc.n, 0) / (cnt * w) END, 6) AS density
FROM hb LEFT JOIN hc ON hb.bin = hc.bin, hs3""", ctes)


for _s, _k in (("merchant", "merchant_id"), ("user", "user_id")):
    def _mk(key):
        return lambda spark, sf: rounded(pr.fd_histogram(_rates(spark, sf, key)))
    register(f"hist_{_s}", sql=_hist_sql(_k))(_mk(_k))


@register("norm_fit", sql=W(
    "SELECT count(x) AS n, ROUND(avg(x), 6) AS mean, ROUND(stddev_pop(x), 6) AS std FROM r",
    _rates_cte("merchant_id")))
def norm_fit(spark, sf):
    return rounded(pr.norm_fit(_rates(spark, sf, "merchant_id")))


KDE_SQL = W("""SELECT CAST(g AS INT) AS grid, ROUND(lo + g * ((hi - lo) / 99), 6) AS x,
  ROUND(sum(exp(-0.5e0 * ((lo + g * ((hi - lo) / 99) - r.x) / bw) * ((lo + g * ((hi - lo) / 99) - r.x) / bw)))
        / (n * bw * sqrt(2.0e0 * pi())), 6) AS density
FROM r, ks3, (SELECT unnest(range(0, 100)) AS g) gg
GROUP BY g, lo, hi, bw, n""", _rates_cte("merchant_id") + """,
ks AS (SELECT count(x) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx FROM r),
ks2 AS (SELECT *, sd * pow(n, -0.2e0) AS bw FROM ks),
ks3 AS (SELECT *, mn - 3.0e0 * bw AS lo, mx + 3.0e0 * bw AS hi FROM ks2)""")


@register("kde_merchant", sql=KDE_SQL)
def kde_merchant(spark, sf):
    return rounded(pr.kde(_rates(spark, sf, "merchant_id")))


PP_CTES = _rates_cte("merchant_id") + f""",
pp AS (SELECT row_number() OVER (ORDER BY x) AS i, x AS value, count(*) OVER () AS n FROM r),
pm AS (SELECT i, value, {filliben_sql('i', 'n')} AS m FROM pp),
pq AS (SELECT i, value, {norm_ppf_sql('m')} AS quantile FROM pm)"""


@register("probplot_points", sql=W(
    "SELECT CAST(i AS BIGINT) AS rank, ROUND(value, 6) AS value, ROUND(quantile, 6) AS quantile FROM pq", PP_CTES))
def probplot_points(spark, sf):
    return rounded(pr.probplot_points(_rates(spark, sf, "merchant_id")))


@register("probplot_merchant", sql=W(
    "SELECT count(*) AS n, ROUND(regr_slope(value, quantile), 6) AS slope, "
    "ROUND(regr_intercept(value, quantile), 6) AS intercept, ROUND(corr(quantile, value), 6) AS r FROM pq",
    PP_CTES))
def probplot_merchant(spark, sf):
    return rounded(pr.probplot_fit(_rates(spark, sf, "merchant_id")))


# ---------------------------------------------------------------- PF11 / SC3 / PF12 / PF9

LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax"]
LI_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
            "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double"}


def _ladder_sql(ladder, fallback, idx):
    out = f"'{fallback}'"
    for row in reversed(ladder):
        out = (f"CASE WHEN mn > CAST({row[1]} AS DOUBLE) AND mx < CAST({row[2]} AS DOUBLE) "
               f"THEN '{row[idx]}' ELSE {out} END")
    return out


def _narrow_sql():
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST(min({c}) AS DOUBLE) + 0.0e0 AS mn, CAST(max({c}) AS DOUBLE) + 0.0e0 AS mx, "
        f"{'TRUE' if LI_TYPES[c] in ('bigint', 'int') else 'FALSE'} AS is_int, '{LI_TYPES[c]}' AS orig, "
        f"count(*) AS nrows FROM lineitem" for c in LI_NUMERIC)
    width = "CASE {} END".format(" ".join(f"WHEN {{x}} = '{k}' THEN {v}" for k, v in nw.WIDTH.items()))
    ref = (f"CASE WHEN is_int THEN {_ladder_sql(nw.INT_LADDER, 'uint64', 0)} "
           f"ELSE {_ladder_sql(nw.FLOAT_LADDER, 'float64', 0)} END")
    spk = f"CASE WHEN is_int THEN {_ladder_sql(nw.INT_LADDER, 'decimal(20,0)', 3)} ELSE 'double' END"
    return (f"SELECT col AS \"column\", mn AS min, mx AS max, ref_dtype, spark_type, "
            f"CAST(nrows * {width.format(x='orig')} AS BIGINT) AS bytes_before, "
            f"CAST(nrows * {width.format(x='spark_type')} AS BIGINT) AS bytes_after "
            f"FROM (SELECT *, {ref} AS ref_dtype, {spk} AS spark_type FROM ({rows}) s) t")


@register("narrow_plan", sql=_narrow_sql())
def narrow_plan(spark, sf):
    return rounded(nw.narrow_plan(read_table(spark, sf, "lineitem", *LI_NUMERIC)))


def _applied_sql():
    return " UNION ALL ".join(
        f"SELECT n.\"column\", n.spark_type, (SELECT ROUND(sum({c}), 6) FROM lineitem) AS total FROM narrowed n "
        f"WHERE n.\"column\" = '{c}'" for c in LI_NUMERIC)


@register("narrow_apply", sql=f"WITH narrowed AS ({_narrow_sql()}) " + _applied_sql())
def narrow_apply(spark, sf):
    """PF11: the table cast to the planned types; each column's type and its unchanged total."""
    li = read_table(spark, sf, "lineitem", *LI_NUMERIC)
    cast = nw.apply_narrowing(li, nw.narrow_plan(li))
    kinds = dict(cast.dtypes)
    one = cast.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in cast.columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("spark_type"), F.col(c).alias("total"))
                               for c in cast.columns]))
    return rounded(one.select(rows.alias("r")).select("r.*"))


@register("category_codes", sql=W(
    "SELECT cat_id, CAST(dense_rank() OVER (ORDER BY cat_id) - 1 AS BIGINT) AS code "
    "FROM (SELECT DISTINCT cat_id FROM user_log_all WHERE cat_id IS NOT NULL)"))
def category_codes(spark, sf):
    return with_dense_codes(fx.user_log_all(spark, sf), "cat_id", "code")


SAN_RAW = ("CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) "
           "WHEN event_type = 'signup' THEN CAST('Infinity' AS DOUBLE) "
           "WHEN event_type = 'view' THEN CAST('-Infinity' AS DOUBLE) ELSE value END")


@register("sanitize", sql=(
    f"SELECT event_id, event_type, ROUND(CASE WHEN isnan(raw) OR isinf(raw) OR raw IS NULL THEN 0.0 "
    f"ELSE raw END, 6) AS value FROM (SELECT event_id, event_type, {SAN_RAW} AS raw FROM events)"))
def sanitize_q(spark, sf):
    ev = read_table(spark, sf, "events", "event_id", "event_type", "value")
    raw = ev.select("event_id", "event_type", F.expr(SAN_RAW).alias("raw"))
    return rounded(raw.select("event_id", "event_type", sanitize(F.col("raw")).alias("value")))

