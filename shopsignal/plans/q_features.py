"""Registered queries: fixture scans, joins and per-user behaviour features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shopsignal.functions.stats import softmax2
from shopsignal.operators import features as feat
from shopsignal.session import ensure_checkpoint_dir
from shopsignal.plans.registry import register, rounded
from shopsignal.plans.sqltext import defaults_select, ustats_ctes
from shopsignal.sources import fixtures as fx

# ---------------------------------------------------------------- IO1 / U1 / J1


def _dbl(df, *cols):
    """Nullable integer outputs leave as double so both engines agree on representation."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@register("scan_log", sql=fx.with_fixtures("SELECT * FROM user_log_all"))
def scan_log(spark, sf):
    return fx.user_log_all(spark, sf)


@register("union_pairs", sql=fx.with_fixtures(
    "SELECT user_id, merchant_id, CAST(label AS DOUBLE) AS label, prob FROM all_pairs"))
def union_pairs(spark, sf):
    return _dbl(fx.all_pairs(spark, sf), "label")


@register("pairs_with_profile", sql=fx.with_fixtures(
    "SELECT p.user_id, p.merchant_id, CAST(p.label AS DOUBLE) AS label, p.prob, "
    "CAST(i.age_range AS DOUBLE) AS age_range, CAST(i.gender AS DOUBLE) AS gender "
    "FROM all_pairs p LEFT JOIN user_info i ON p.user_id = i.user_id"))
def pairs_with_profile(spark, sf):
    j = fx.all_pairs(spark, sf).join(fx.user_info(spark, sf), "user_id", "left")
    return _dbl(j, "label", "age_range", "gender")


@register("label_split", sql=fx.with_fixtures(
    "SELECT user_id, merchant_id, CAST(label AS DOUBLE) AS label, prob, "
    "CASE WHEN label IS NULL THEN 'unlabelled' ELSE 'labelled' END AS part FROM all_pairs"))
def label_split(spark, sf):
    """PF5: the labelled (train) / unlabelled (test) split on a null label."""
    part = F.when(F.col("label").isNull(), "unlabelled").otherwise("labelled")
    return _dbl(fx.all_pairs(spark, sf).withColumn("part", part), "label")


# ---------------------------------------------------------------- A14-A21 per user

def _per_user(spark, sf, cols, n=1, compat=False, groups=feat.GROUPS):
    users = fx.user_info(spark, sf).select("user_id")
    stats = feat.user_stats(fx.user_log(spark, sf), n=n, compat=compat, groups=groups)
    out = feat.with_missing_defaults(users.join(stats, "user_id", "left"), n=n)
    return rounded(out.select("user_id", *cols))


def _per_user_sql(cols, n=1, compat=False):
    body = (f"SELECT user_id, {', '.join(cols)} FROM (SELECT i.user_id,\n  {defaults_select('s', n)}\n"
            "FROM user_info i LEFT JOIN ustats s ON i.user_id = s.user_id) q")
    return fx.with_fixtures(body, ustats_ctes(n, compat))


NUNIQUE = ["seller_nunique", "cat_nunique", "brand_nunique", "item_nunique",
           "time_stamp_nunique", "action_type_nunique"]
TIME = ["time_stamp_max", "time_stamp_min", "time_stamp_std", "time_stamp_range"]
MOST1 = [f"{k}_most_1" for k in fx.TOKEN_COLUMNS] + [f"{k}_most_cnt_1" for k in fx.TOKEN_COLUMNS]
MOST2 = [f"{k}_most_2" for k in fx.TOKEN_COLUMNS] + [f"{k}_most_cnt_2" for k in fx.TOKEN_COLUMNS]
ACTION = ["user_cnt_0", "cart_cnt", "buy_cnt"]


def _reg_per_user(name, cols, group, n=1, compat=False):
    register(name, sql=_per_user_sql(cols, n, compat))(
        lambda spark, sf: _per_user(spark, sf, cols, n, compat, (group,)))


_reg_per_user("user_cnt", ["user_cnt"], "base")
_reg_per_user("user_nunique", NUNIQUE, "nunique")
_reg_per_user("user_time_stats", TIME, "base")
_reg_per_user("user_most_n", MOST1, "most")
_reg_per_user("user_most_n_cnt", MOST2, "most", n=2)
_reg_per_user("user_action_cnt", ACTION, "base")
_reg_per_user("user_action_cnt_compat", ACTION, "base", compat=True)
_reg_per_user("user_action_nunique", ["fav_seller_item_nunique"], "nunique")
_reg_per_user("user_action_nunique_compat", ["fav_seller_item_nunique"], "nunique", compat=True)


@register("softmax_actions", sql=fx.with_fixtures(
    "SELECT user_id, ROUND(exp(c * 0.1e0) / (exp(c * 0.1e0) + exp(b * 0.1e0)), 6) AS p_cart FROM (SELECT user_id, "
    "count_if(action_type = '1') AS c, count_if(action_type = '2') AS b FROM user_log GROUP BY user_id)"))
def softmax_actions(spark, sf):
    """softmax of two scores, here a tenth of a user's cart and buy counts."""
    s = feat.user_base_stats(fx.user_log(spark, sf))
    return rounded(s.select("user_id", softmax2(F.col("cart_cnt") * 0.1, F.col("buy_cnt") * 0.1).alias("p_cart")))


# ---------------------------------------------------------------- full feature table

FEATURE_COLS = (["user_cnt"] + NUNIQUE + TIME + MOST1 + ACTION + ["fav_seller_item_nunique"])


def user_features_df(spark, sf):
    # the pairs and the log both read lineitem joined with orders: join once
    lo = fx.shared_line_orders(spark, sf)
    return feat.user_features(fx.all_pairs(spark, sf, lo), fx.user_info(spark, sf), fx.user_log(spark, sf, lo))


USER_FEATURES_SQL = fx.with_fixtures(
    "SELECT p.user_id, p.merchant_id, CAST(p.label AS DOUBLE) AS label, p.prob, "
    "CAST(i.age_range AS DOUBLE) AS age_range, CAST(i.gender AS DOUBLE) AS gender,\n  "
    + defaults_select("s", 1)
    + "\nFROM all_pairs p LEFT JOIN user_info i ON p.user_id = i.user_id"
      " LEFT JOIN ustats s ON p.user_id = s.user_id",
    ustats_ctes(1))


@register("user_features", sql=USER_FEATURES_SQL)
def user_features(spark, sf):
    return rounded(_dbl(user_features_df(spark, sf), "label", "age_range", "gender"))


NUMERIC_COLS = ["age_range", "gender"] + [c for c in FEATURE_COLS if not (c.endswith("_most_1"))]


@register("project_features", sql=f"SELECT {', '.join(NUMERIC_COLS)} FROM ({USER_FEATURES_SQL}) q")
def project_features(spark, sf):
    """PF1: all numeric columns of the feature table but the excluded keys and targets."""
    from shopsignal.plans import pipeline as pl
    return rounded(_dbl(pl.project(user_features_df(spark, sf)), "age_range", "gender"))


EMBEDDING_DIM = 64  # width of the `embeddings` test table
LISTED = [f"embedding_{i}" for i in range(EMBEDDING_DIM)] + ["user_cnt", "buy_cnt"]


@register("project_listed", sql=fx.with_fixtures(
    "SELECT p.user_id, p.merchant_id, " + ", ".join(f"ROUND(COALESCE(m.e{i}, 0.0), 6) AS embedding_{i}" for i in range(EMBEDDING_DIM))
    + ", CAST(COALESCE(s.user_cnt, -1) AS BIGINT) AS user_cnt, CAST(COALESCE(s.buy_cnt, -1) AS BIGINT) AS buy_cnt FROM all_pairs p "
      "LEFT JOIN m ON p.user_id = m.user_id LEFT JOIN s ON p.user_id = s.user_id",
    "m AS (SELECT l.user_id, " + ", ".join(f"avg(e.embedding[{i + 1}]) AS e{i}" for i in range(EMBEDDING_DIM))
    + " FROM user_log l JOIN embeddings e ON l.item_id = e.vec_id GROUP BY l.user_id),\n"
      "s AS (SELECT user_id, count(*) AS user_cnt, count_if(action_type = '2') AS buy_cnt FROM user_log GROUP BY user_id)"))
def project_listed(spark, sf):
    """PF2: a listed projection of the feature table with its embedding block."""
    from shopsignal.plans import pipeline as pl
    ft = pl.feature_table(spark, sf, embedding=True)
    return rounded(pl.project(ft, ["user_id", "merchant_id", *LISTED]))


@register("events_most_frequent", sql=(
    "WITH p AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos "
    "FROM events), c AS (SELECT user_id, event_type AS token, count(*) AS cnt, min(pos) AS first FROM p "
    "WHERE event_type IS NOT NULL GROUP BY user_id, event_type), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, first) AS rn FROM c) "
    "SELECT user_id, count(*) AS event_type_nunique, CAST(sum(cnt) AS BIGINT) AS n_events, "
    "max(CASE WHEN rn = 1 THEN token END) AS event_type_most_1, max(CASE WHEN rn = 1 THEN cnt END) AS event_type_most_cnt_1 "
    "FROM r GROUP BY user_id"))
def events_most_frequent(spark, sf):
    """A15/A18/A19 on the events log (unique key event_id; order ts, event_id)."""
    from shopsignal.sources.tables import read_table
    ev = read_table(spark, sf, "events", "event_id", "ts", "user_id", "event_type")
    return feat.most_frequent(ev, "user_id", "event_type", ["ts", "event_id"])


# A15 from sketches: the second half of the log's days, for columns whose tokens repeat
SKETCHED = {"seller": "seller_id", "brand": "brand_id", "item": "item_id"}
WINDOW = (745, 1488)


@register("window_nunique", sql=fx.with_fixtures(" UNION ALL ".join(
    f"SELECT user_id, '{n}' AS \"column\", count(DISTINCT {c}) AS nunique FROM user_log "
    f"WHERE time_stamp BETWEEN {WINDOW[0]} AND {WINDOW[1]} AND {c} IS NOT NULL GROUP BY user_id" for n, c in SKETCHED.items())))
def window_nunique(spark, sf):
    """A15 for any window of days, merged from one written sketch per user, day and column."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
    feat.distinct_sketches(fx.user_log(spark, sf), SKETCHED).write.parquet(path)
    return feat.distinct_in_window(spark.read.parquet(path), *WINDOW)
