"""Registered queries: evaluation metrics on a fixed, SQL-computable predictor.

The predictor is the smoothed repeat rate of the pair's merchant
((positives + 1) / (rows + 2)) with a 0.15 threshold, folds from the
shuffled K-fold (K1). Trained models are checked by properties instead.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsignal.functions.stats import d
from shopsignal.operators import evaluate as ev
from shopsignal.operators import features as feat
from shopsignal.operators import folds as fo
from shopsignal.plans.q_folds import KFOLD_CTE
from shopsignal.plans.registry import register, rounded
from shopsignal.plans.sqltext import ustats_ctes
from shopsignal.sources import fixtures as fx

W = fx.with_fixtures
THRESHOLD = 0.15
NAMES = {0: "no-repeat", 1: "repeat"}

SCORED = KFOLD_CTE + f""",
mr AS (SELECT merchant_id, (sum(label) + 1.0e0) / (count(*) + 2.0e0) AS score FROM train GROUP BY merchant_id),
ur AS (SELECT user_id, (sum(label) + 1.0e0) / (count(*) + 2.0e0) AS uscore FROM train GROUP BY user_id),
scored AS (SELECT k.user_id, k.merchant_id, k.label, k.fold, mr.score,
           CASE WHEN mr.score > {d(THRESHOLD)} THEN 1 ELSE 0 END AS prediction
           FROM kfold k JOIN mr ON k.merchant_id = mr.merchant_id)"""


def scored(spark, sf):
    t = fx.shared_train(spark, sf)
    f = fo.kfold(t, 5, seed=0)
    mr = t.groupBy("merchant_id").agg(((F.sum("label") + 1.0) / (F.count(F.lit(1)) + 2.0)).alias("score"))
    s = f.join(mr, "merchant_id")
    return s.withColumn("prediction", (F.col("score") > THRESHOLD).cast("int"))


PC = f"least(greatest(score, {d(ev.EPS)}), {d(1 - ev.EPS)})"


@register("log_loss", sql=W(
    f"SELECT fold, ROUND(avg(-(label * ln({PC}) + (1 - label) * ln(1 - {PC}))), 6) AS log_loss "
    "FROM scored GROUP BY fold", SCORED))
def log_loss(spark, sf):
    return rounded(ev.log_loss(scored(spark, sf), by=["fold"]))


ACC_SQL = "SELECT fold, avg(CASE WHEN label = prediction THEN 1.0e0 ELSE 0.0e0 END) AS accuracy FROM scored GROUP BY fold"


@register("accuracy_by_fold", sql=W(f"SELECT fold, ROUND(accuracy, 6) AS accuracy FROM ({ACC_SQL})", SCORED))
def accuracy_by_fold(spark, sf):
    return rounded(ev.accuracy(scored(spark, sf), by=["fold"]))


@register("fold_score_summary", sql=W(
    f"SELECT ROUND(avg(accuracy), 6) AS mean, ROUND(stddev_pop(accuracy), 6) AS std FROM ({ACC_SQL})", SCORED))
def fold_score_summary(spark, sf):
    return rounded(ev.summary(ev.accuracy(scored(spark, sf), by=["fold"]), "accuracy"))


CLASS_CTE = SCORED + """,
cc AS (SELECT fold, cls, sum(hit) AS tp, sum(is_lab) AS support, sum(is_pred) AS npred FROM (
         SELECT fold, label AS cls, CASE WHEN label = prediction THEN 1 ELSE 0 END AS hit, 1 AS is_lab, 0 AS is_pred
         FROM scored
         UNION ALL SELECT fold, prediction AS cls, 0, 0, 1 FROM scored) u GROUP BY fold, cls),
cc_all AS (SELECT cls, sum(tp) AS tp, sum(support) AS support, sum(npred) AS npred FROM cc GROUP BY cls),
prf AS (SELECT cls, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
               CASE WHEN npred + support > 0 THEN 2 * tp / (npred + support) ELSE 0.0 END AS f1, support
        FROM cc_all)"""


@register("f1_macro", sql=W(
    "SELECT fold, ROUND(avg(CASE WHEN npred + support > 0 THEN 2 * tp / (npred + support) ELSE 0.0 END), 6) "
    "AS f1_macro FROM cc GROUP BY fold", CLASS_CTE))
def f1_macro(spark, sf):
    return rounded(ev.f1_macro(scored(spark, sf), by=["fold"]))


@register("classification_report", sql=W(
    "SELECT CASE cls WHEN 0 THEN 'no-repeat' WHEN 1 THEN 'repeat' ELSE CAST(cls AS VARCHAR) END AS class, "
    "ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, "
    "CAST(support AS BIGINT) AS support FROM prf "
    "UNION ALL SELECT 'macro avg', ROUND(avg(precision), 6), ROUND(avg(recall), 6), ROUND(avg(f1), 6), "
    "CAST(sum(support) AS BIGINT) FROM prf "
    "UNION ALL SELECT 'weighted avg', ROUND(sum(precision * support) / sum(support), 6), "
    "ROUND(sum(recall * support) / sum(support), 6), ROUND(sum(f1 * support) / sum(support), 6), "
    "CAST(sum(support) AS BIGINT) FROM prf", CLASS_CTE))
def classification_report(spark, sf):
    return rounded(ev.classification_report(scored(spark, sf), names=NAMES))


@register("confusion_matrix", sql=W(
    "SELECT label, prediction, n, ROUND(n / sum(n) OVER (PARTITION BY label), 6) AS row_share FROM "
    "(SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction)", SCORED))
def confusion_matrix(spark, sf):
    return rounded(ev.confusion_matrix(scored(spark, sf)))


@register("r2_score", sql=W(
    "SELECT ROUND(1 - sum((label - score) * (label - score)) / sum((label - m) * (label - m)), 6) AS r2 "
    "FROM scored, (SELECT avg(CAST(label AS DOUBLE)) AS m FROM scored) mm", SCORED))
def r2_score(spark, sf):
    return rounded(ev.r2_score(scored(spark, sf)))


@register("auc", sql=W(
    "SELECT ROUND((sum(CASE WHEN label = 1 THEN r END) - n1 * (n1 + 1) / 2.0e0) / (n1 * n0), 6) AS auc "
    "FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0 AS r "
    "FROM scored) x, (SELECT count_if(label = 1) AS n1, count_if(label = 0) AS n0 FROM scored) c "
    "GROUP BY n1, n0", SCORED))
def auc(spark, sf):
    return rounded(ev.auc(scored(spark, sf)))


@register("ensemble_mean", sql=W(
    "SELECT s.user_id, s.merchant_id, ROUND((s.score + ur.uscore + CAST(s.prediction AS DOUBLE)) / 3, 6) AS prob "
    "FROM scored s JOIN ur ON s.user_id = ur.user_id", SCORED))
def ensemble_mean(spark, sf):
    t = fx.train(spark, sf)
    ur = t.groupBy("user_id").agg(((F.sum("label") + 1.0) / (F.count(F.lit(1)) + 2.0)).alias("uscore"))
    s = scored(spark, sf).join(ur, "user_id").withColumn("p", F.col("prediction").cast("double"))
    return rounded(ev.ensemble_mean(s, ["score", "uscore", "p"]).select("user_id", "merchant_id", "prob"))


# ---------------------------------------------------------------- feature-table statistics

ZCOLS = ["user_cnt", "item_nunique"]


@register("zscore", sql=W(
    "SELECT user_id, " + ", ".join(
        f"ROUND(({c} - (SELECT avg({c}) FROM ubase)) / (SELECT stddev_pop({c}) FROM ubase), 6) AS z_{c}"
        for c in ZCOLS) + " FROM ubase", ustats_ctes()))
def zscore(spark, sf):
    st = feat.user_stats(fx.user_log(spark, sf))
    return rounded(ev.zscore(st, ZCOLS).select("user_id", *[f"z_{c}" for c in ZCOLS]))


VCOLS = ["user_cnt", "seller_nunique", "item_nunique", "action_type_nunique", "time_stamp_std"]


@register("variance_filter", sql=W(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(var_pop(CAST({c} AS DOUBLE)), 6) AS variance, "
    f"var_pop(CAST({c} AS DOUBLE)) > 0.16e0 AS kept FROM ubase" for c in VCOLS), ustats_ctes()))
def variance_filter(spark, sf):
    return rounded(ev.variance_filter(feat.user_stats(fx.user_log(spark, sf)), VCOLS))


GCOLS = ["user_cnt", "item_nunique", "time_stamp_std"]


@register("gnb_params", sql=W(" UNION ALL ".join(
    f"SELECT t.label, count(*) AS n, '{c}' AS feature, ROUND(avg(CAST(b.{c} AS DOUBLE)), 6) AS mean, "
    f"ROUND(var_pop(CAST(b.{c} AS DOUBLE)), 6) AS var FROM train t JOIN ubase b ON t.user_id = b.user_id "
    "GROUP BY t.label" for c in GCOLS), ustats_ctes()))
def gnb_params(spark, sf):
    st = feat.user_stats(fx.user_log(spark, sf))
    return rounded(ev.class_stats(fx.train(spark, sf).join(st, "user_id"), "label", GCOLS))


# ---------------------------------------------------------------- metrics on the `labels` table

DOC_SCORE_SQL = ("SELECT d.doc_id, l.quality AS label, ln(1 + d.n_chars) / 10.0e0 AS score FROM documents d "
                 "JOIN labels l ON d.doc_id = l.doc_id")


@register("doc_quality_auc", sql=(
    "WITH scored AS (" + DOC_SCORE_SQL + ") "
    "SELECT ROUND((sum(CASE WHEN label = 1 THEN r END) - n1 * (n1 + 1) / 2.0e0) / (n1 * n0), 6) AS auc "
    "FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0 AS r "
    "FROM scored) x, (SELECT count_if(label = 1) AS n1, count_if(label = 0) AS n0 FROM scored) c GROUP BY n1, n0"))
def doc_quality_auc(spark, sf):
    """M19 on document quality labels with a length score (ties counted one half)."""
    from shopsignal.sources.tables import read_table
    d = read_table(spark, sf, "documents", "doc_id", "n_chars")
    lab = read_table(spark, sf, "labels", "doc_id", "quality")
    s = d.join(lab, "doc_id").select("doc_id", F.col("quality").alias("label"),
                                     (F.ln(1 + F.col("n_chars")) / 10.0).alias("score"))
    return rounded(ev.auc(s))
