"""DuckDB SQL fragments shared by oracle queries (written independently of the Spark plans)."""

from __future__ import annotations

TOKEN_SQL = {  # name -> SQL expression of the token
    "seller": "CAST(seller_id AS VARCHAR)",
    "cat": "cat_id",
    "brand": "brand_id",
    "item": "CAST(item_id AS VARCHAR)",
    "action_type": "action_type",
}


def ustats_ctes(n: int = 1, compat: bool = False) -> str:
    """CTEs: upos (positioned log), ubase, utok (n-th most frequent), ustats (one row per user)."""
    union = "\n    UNION ALL ".join(
        f"SELECT user_id, '{k}' AS col, {v} AS token, pos FROM upos" for k, v in TOKEN_SQL.items())
    most = ",\n    ".join(
        f"max(CASE WHEN col = '{k}' THEN token END) AS {k}_most_{n}, "
        f"max(CASE WHEN col = '{k}' THEN cnt END) AS {k}_most_cnt_{n}" for k in TOKEN_SQL)
    if compat:
        acts = "count(*) AS user_cnt_0, count(*) AS cart_cnt, count(*) AS buy_cnt"
        fav = ("count(DISTINCT CASE WHEN action_type = '3' THEN CAST(seller_id AS VARCHAR) || '_' || "
               "CAST(item_id AS VARCHAR) END) + CASE WHEN count(*) > count_if(action_type = '3') "
               "THEN 1 ELSE 0 END AS fav_seller_item_nunique")
    else:
        acts = ("count_if(action_type = '0') AS user_cnt_0, count_if(action_type = '1') AS cart_cnt, "
                "count_if(action_type = '2') AS buy_cnt")
        fav = ("count(DISTINCT CASE WHEN action_type = '3' THEN CAST(seller_id AS VARCHAR) || '_' || "
               "CAST(item_id AS VARCHAR) END) AS fav_seller_item_nunique")
    return f"""
upos AS (SELECT *, row_number() OVER (PARTITION BY user_id
           ORDER BY time_stamp, item_id, seller_id, action_type, cat_id, brand_id) AS pos FROM user_log),
ubase AS (
  SELECT user_id, count(*) AS user_cnt,
    count(DISTINCT seller_id) AS seller_nunique, count(DISTINCT cat_id) AS cat_nunique,
    count(DISTINCT brand_id) AS brand_nunique, count(DISTINCT item_id) AS item_nunique,
    count(DISTINCT time_stamp) AS time_stamp_nunique, count(DISTINCT action_type) AS action_type_nunique,
    CAST(max(time_stamp) AS DOUBLE) AS time_stamp_max, CAST(min(time_stamp) AS DOUBLE) AS time_stamp_min,
    stddev_pop(time_stamp) AS time_stamp_std,
    {acts},
    {fav}
  FROM user_log GROUP BY user_id),
utok_long AS (
    {union}),
utok_cnt AS (SELECT user_id, col, token, count(*) AS cnt, min(pos) AS first
             FROM utok_long WHERE token IS NOT NULL GROUP BY user_id, col, token),
utok_rank AS (SELECT *, row_number() OVER (PARTITION BY user_id, col ORDER BY cnt DESC, first) AS rn
              FROM utok_cnt),
utok AS (SELECT user_id,
    {most}
  FROM utok_rank WHERE rn = {n} GROUP BY user_id),
ustats AS (SELECT b.*, {", ".join(f"t.{k}_most_{n}, t.{k}_most_cnt_{n}" for k in TOKEN_SQL)}
           FROM ubase b LEFT JOIN utok t ON b.user_id = t.user_id)
"""


def defaults_select(prefix: str = "s", n: int = 1) -> str:
    """SELECT list applying the -1 defaults (N2) and range after defaults."""
    longs = ["user_cnt", "seller_nunique", "cat_nunique", "brand_nunique", "item_nunique",
             "time_stamp_nunique", "action_type_nunique",
             "user_cnt_0", "cart_cnt", "buy_cnt", "fav_seller_item_nunique"]
    longs += [f"{k}_most_cnt_{n}" for k in TOKEN_SQL]
    parts = [f"CAST(COALESCE({prefix}.{c}, -1) AS BIGINT) AS {c}" for c in longs]
    parts.append(f"ROUND(COALESCE({prefix}.time_stamp_std, -1.0), 6) AS time_stamp_std")
    parts += [f"COALESCE({prefix}.time_stamp_{m}, -1.0) AS time_stamp_{m}" for m in ("max", "min")]
    parts.append(f"COALESCE({prefix}.time_stamp_max, -1.0) - COALESCE({prefix}.time_stamp_min, -1.0) AS time_stamp_range")
    parts += [f"COALESCE({prefix}.{k}_most_{n}, '-1') AS {k}_most_{n}" for k in TOKEN_SQL]
    return ",\n  ".join(parts)
