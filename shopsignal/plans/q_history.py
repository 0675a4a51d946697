"""Registered queries: event positions, paths, path merge, tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsignal.operators import features as feat
from shopsignal.operators import history as hi
from shopsignal.plans.registry import register
from shopsignal.sources import fixtures as fx

W = fx.with_fixtures
ORDER_SQL = "time_stamp, item_id, seller_id, action_type, cat_id, brand_id"
UPOS = f"upos AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {ORDER_SQL}) AS pos FROM user_log)"
PATHS = UPOS + ",\nupaths AS (SELECT user_id, CAST((pos - 1) // 1000 AS BIGINT) AS chunk, count(*) AS n_events,\n  " + \
    ",\n  ".join(f"string_agg(COALESCE(CAST({c} AS VARCHAR), 'nan'), ' ' ORDER BY pos) AS {name}"
                 for name, c in hi.PATH_COLUMNS.items()) + "\n FROM upos GROUP BY user_id, chunk)"


@register("event_position", sql=W(
    "SELECT user_id, item_id, cat_id, seller_id, brand_id, time_stamp, action_type, CAST(pos AS BIGINT) AS pos "
    "FROM upos", UPOS))
def event_position(spark, sf):
    return hi.event_positions(fx.user_log(spark, sf))


@register("user_paths", sql=W("SELECT * FROM upaths", PATHS))
def user_paths(spark, sf):
    return hi.user_paths(fx.user_log(spark, sf))


@register("merge_user_paths", sql=W(
    "SELECT p.user_id, p.merchant_id, CAST(p.label AS DOUBLE) AS label, p.prob, "
    "CAST(u.n_events AS DOUBLE) AS n_events, CAST(u.n_chunks AS DOUBLE) AS n_chunks "
    "FROM all_pairs p LEFT JOIN (SELECT user_id, sum(n_events) AS n_events, count(*) AS n_chunks "
    "FROM upaths GROUP BY user_id) u ON p.user_id = u.user_id", PATHS))
def merge_user_paths(spark, sf):
    m = hi.merge_paths(fx.all_pairs(spark, sf), hi.user_paths(fx.user_log(spark, sf)))
    return m.withColumns({c: F.col(c).cast("double") for c in ("label", "n_events", "n_chunks")})


@register("pair_paths", sql=W(
    "SELECT p.user_id, p.merchant_id, CAST(u.chunk AS DOUBLE) AS chunk, " + ", ".join(f"u.{name}" for name in hi.PATH_COLUMNS)
    + " FROM all_pairs p LEFT JOIN upaths u ON p.user_id = u.user_id", PATHS))
def pair_paths(spark, sf):
    """The six paths on every pair, chunk by chunk."""
    m = hi.join_paths(fx.all_pairs(spark, sf), hi.user_paths(fx.user_log(spark, sf)))
    return m.select("user_id", "merchant_id", F.col("chunk").cast("double").alias("chunk"), *hi.PATH_COLUMNS)


@register("tokens", sql=W(
    "SELECT user_id, chunk, CAST(unnest(generate_series(0, len(arr) - 1)) AS BIGINT) AS idx, unnest(arr) AS token "
    "FROM (SELECT user_id, chunk, string_split(lower(seller_path), ' ') AS arr FROM upaths)", PATHS))
def tokens(spark, sf):
    t = hi.path_tokens(hi.user_paths(fx.user_log(spark, sf)), "seller_path")
    return t.withColumn("idx", F.col("idx").cast("long"))


def _seq_sql():
    from shopsignal.plans.sqltext import ustats_ctes
    return W("""SELECT time_stamp_nunique, CAST((pos - 1) // 1000 AS BIGINT) AS chunk, count(*) AS n_rows,
  string_agg(CAST(user_id AS VARCHAR) || '_' || CAST(merchant_id AS VARCHAR), ' ' ORDER BY pos) AS row_key,
  string_agg(CAST(user_cnt AS VARCHAR) || ',' || CAST(seller_nunique AS VARCHAR) || ',' || CAST(buy_cnt AS VARCHAR), ' ' ORDER BY pos)
    AS feature_path
FROM (SELECT *, row_number() OVER (PARTITION BY time_stamp_nunique ORDER BY user_id, merchant_id) AS pos FROM (
  SELECT t.user_id, t.merchant_id, CAST(COALESCE(s.time_stamp_nunique, -1) AS BIGINT) AS time_stamp_nunique,
    COALESCE(s.user_cnt, -1) AS user_cnt, COALESCE(s.seller_nunique, -1) AS seller_nunique, COALESCE(s.buy_cnt, -1) AS buy_cnt
  FROM train t LEFT JOIN ustats s ON t.user_id = s.user_id) x) y
GROUP BY time_stamp_nunique, chunk""", ustats_ctes())


@register("sequence_groups", sql=_seq_sql())
def sequence_groups(spark, sf):
    """A12 with the rows' feature vectors, written as text for the comparison."""
    feats = ["user_cnt", "seller_nunique", "buy_cnt"]
    stats = feat.user_stats(fx.user_log(spark, sf), groups=("base", "nunique"))
    tr = feat.with_missing_defaults(fx.train(spark, sf).join(stats, "user_id", "left"))
    g = hi.sequence_groups(tr.select("user_id", "merchant_id", "time_stamp_nunique", *feats), "time_stamp_nunique",
                           ["user_id", "merchant_id"], feats)
    row = lambda v: F.array_join(F.transform(v, lambda x: x.cast("long").cast("string")), ",")
    return g.withColumn("feature_path", F.array_join(F.transform("features", row), " ")).drop("features")
