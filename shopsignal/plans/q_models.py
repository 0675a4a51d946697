"""Registered queries: trained models at the reference's sizes.

All labelled rows are fitted on, and all rows are scored.
Naive Bayes is checked by SQL value for value. The other models have companion queries, checked
by SQL: which keys, folds and learners were scored, and 0 <= p <= 1.

Queries over the same table share frames and fitted results within a session (``_once``): a
stack of two boosters is the two boosters' own scores side by side. ``forget`` drops them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shopsignal.operators import evaluate as ev
from shopsignal.operators.ensemble import (KEYS, StackedBagging, StackedBaggingModel, _shared_folder, _union, oof_scores,
                                            stack_tables)
from shopsignal.operators.folds import kfold, stratified_kfold, train_test_split
from shopsignal.operators.knn import nearest
from shopsignal.operators.learners import make_learner, prob1
from shopsignal.operators.mlp import MLPRegressor
from shopsignal.operators.prepare import Preparation
from shopsignal.operators.select import (cv_accuracy, fit_importance_model, importance_table,
                                         select_features, top_k_features)
from shopsignal.plans import pipeline as pl
from shopsignal.plans.q_features import ACTION, NUNIQUE, TIME
from shopsignal.plans.q_folds import KFOLD_CTE, block_sql
from shopsignal.plans.registry import register, rounded
from shopsignal.plans.sqltext import TOKEN_SQL, defaults_select, ustats_ctes
from shopsignal.sources import fixtures as fx
from shopsignal.sources.tables import read_table

K = 5
BOOSTERS = ["lgb", "xgb"]
PRESET = "reference"  # sizes of all learners; tests set "small"
_MEMO: dict = {}


def _once(spark, sf, name, make):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MEMO:
        _MEMO[key] = make()
    return _MEMO[key]


def forget() -> None:
    """Drop frames and results kept by this session's queries."""
    _MEMO.clear()


def _written(df, name):
    path = _shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _frames(spark, sf):
    return _once(spark, sf, "frames", lambda: pl.model_frames(spark, sf, missing_value=-1.0))


def _scores(spark, sf, name):
    """Long out-of-fold and test scores of one learner."""
    def make():
        train, test, cols = _frames(spark, sf)
        # M6: the one booster that reads -1 as missing
        marker = {"xgb": pl.missing_markers(cols)}
        return oof_scores(train, test, [name], k=K, preset=PRESET, missing=marker)
    return _once(spark, sf, f"scores-{name}", make)


def _stack(spark, sf, names):
    parts = [_scores(spark, sf, n) for n in names]
    return stack_tables(_union([p[0] for p in parts]), _union([p[1] for p in parts]), names)


def _stacked(spark, sf, names):
    tm, sm, _ = _stack(spark, sf, names)
    return (tm.withColumn("part", F.lit("train"))
            .unionByName(sm.withColumn("part", F.lit("test")), allowMissingColumns=True))


for _n in ("rf", "gb", "et", "xgb", "lgb", "lr", "ada"):
    register(f"stack_{_n}")(lambda spark, sf, n=_n: _stacked(spark, sf, [n]))


# ---- Gaussian naive Bayes in SQL: class means and variances (plus 1e-9 of the largest variance) per fold

_FEATURES = (["age_range", "gender", "user_cnt"] + NUNIQUE + TIME + [f"{c}_most_cnt_1" for c in TOKEN_SQL] + ACTION
             + ["fav_seller_item_nunique", "has_history"])
_DEFAULTS = defaults_select("s", 1).replace("ROUND(COALESCE(s.time_stamp_std, -1.0), 6)", "COALESCE(s.time_stamp_std, -1.0)")

GNB_SQL = fx.with_fixtures(
    """SELECT user_id, merchant_id, CAST(label AS DOUBLE) AS label, ROUND(1 / (1 + exp(lr)), 6) AS gnb, 'train' AS part
FROM post JOIN kfold USING (user_id, merchant_id, fold) UNION ALL
SELECT user_id, merchant_id, NULL, ROUND(avg(1 / (1 + exp(lr))), 6), 'test'
FROM post JOIN test USING (user_id, merchant_id) GROUP BY user_id, merchant_id""",
    ustats_ctes(1) + ",\n" + KFOLD_CTE + f""",
wide AS (SELECT p.user_id, p.merchant_id, i.age_range, i.gender, {_DEFAULTS},
    CASE WHEN s.user_id IS NULL THEN 0 ELSE 1 END AS has_history
  FROM all_pairs p LEFT JOIN user_info i ON p.user_id = i.user_id LEFT JOIN ustats s ON p.user_id = s.user_id),
long AS (""" + " UNION ALL ".join(
        f"SELECT user_id, merchant_id, '{c}' AS f, COALESCE(CAST({c} AS DOUBLE), 0) AS x FROM wide" for c in _FEATURES) + f"""),
folds AS (SELECT unnest(range({K})) AS fold),
lab AS (SELECT l.*, k.label, k.fold AS own FROM long l JOIN kfold k USING (user_id, merchant_id)),
st AS (SELECT folds.fold, f, label, avg(x) AS m, var_pop(x) AS v, count(*) AS n FROM lab JOIN folds ON lab.own <> folds.fold GROUP BY ALL),
eps AS (SELECT fold, 1e-9 * max(v) AS e FROM (SELECT folds.fold, f, var_pop(x) AS v FROM lab JOIN folds ON lab.own <> folds.fold
  GROUP BY ALL) GROUP BY fold),
par AS (SELECT a.fold, a.f, a.m AS m0, a.v + e AS v0, b.m AS m1, b.v + e AS v1, a.n AS n0, b.n AS n1 FROM st a JOIN st b
  ON a.fold = b.fold AND a.f = b.f AND a.label = 0 AND b.label = 1 JOIN eps ON a.fold = eps.fold),
post AS (SELECT user_id, merchant_id, fold, sum(-(ln(v0) + (x - m0) * (x - m0) / v0) / 2 + (ln(v1) + (x - m1) * (x - m1) / v1) / 2)
  + ln(max(n0) / max(n1)) AS lr FROM long JOIN par USING (f) GROUP BY ALL)""")


@register("stack_gnb", sql=GNB_SQL)
def stack_gnb(spark, sf):
    """M8 out of fold: the one stacked learner that SQL can express."""
    return rounded(_stacked(spark, sf, ["gnb"]))


_KNN_ROWS = f"""SELECT vec_id, x, y, {block_sql()} AS fold FROM (
  SELECT vec_id, embedding::DOUBLE[] AS x, CASE WHEN label % 2 = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS y,
         row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '_0')) - 1 AS p0, count(*) OVER () AS n FROM embeddings)"""


def _knn_rows(spark, sf):
    e = read_table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("x"),
                    F.when(F.col("label") % 2 == 1, 1.0).otherwise(0.0).alias("y"))


@register("stack_knn", sql=f"""WITH f AS ({_KNN_ROWS}),
d AS (SELECT a.vec_id, a.fold, b.y, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS r
      FROM f a JOIN f b ON a.fold <> b.fold)
SELECT vec_id, fold, count(*) AS n, round(avg(y), 6) AS knn FROM d WHERE r <= 200 GROUP BY ALL""")
def stack_knn(spark, sf):
    """M10 out of fold on the embeddings: share of odd labels among the 200 nearest vectors of the other folds."""
    f = _written(kfold(_knn_rows(spark, sf), K, keys=("vec_id",), seed=0), "knn-folds")
    parts = [nearest(f.where(F.col("fold") == i), f.where(F.col("fold") != i), 200, "vec_id", pay=F.col("y"), totals=True)
             .groupBy("query").agg(F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("knn"))
             .select(F.col("query").alias("vec_id"), F.lit(i).alias("fold"), "n", "knn") for i in range(K)]
    return rounded(_union(parts))


@register("knn_neighbours", sql="""SELECT * FROM (
  SELECT a.vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id)::INT
         AS rank, b.vec_id AS neighbour, round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS distance
  FROM embeddings a, embeddings b) WHERE rank <= 10""")
def knn_neighbours(spark, sf):
    """M10's search: the 10 nearest of all vectors for every vector (itself included)."""
    e = _knn_rows(spark, sf)
    return rounded(nearest(e, e, 10, "vec_id").select(F.col("query").alias("vec_id"), "rank", "neighbour", "distance"))


@register("stack_knn_pairs")
def stack_knn_pairs(spark, sf):
    """M10 as the reference stacks it: 200 neighbours over the pairs' features."""
    return _stacked(spark, sf, ["knn"])


@register("oof_stacking")
def oof_stacking_q(spark, sf):
    """M1 with the reference's pair of boosters; train meta + test meta."""
    return _stacked(spark, sf, BOOSTERS)


@register("oof_rows", sql=fx.with_fixtures(
    f"SELECT user_id, merchant_id, fold, learner, true AS in_range FROM kfold, (SELECT unnest({BOOSTERS}) AS learner) "
    f"UNION ALL SELECT user_id, merchant_id, fold, learner, true FROM test, (SELECT unnest({BOOSTERS}) AS learner), "
    f"(SELECT unnest(range({K})) AS fold)", KFOLD_CTE))
def oof_rows(spark, sf):
    """Companion of ``oof_stacking``: every training pair scored in its own fold, every test pair in each."""
    parts = [p.select(*KEYS, F.col("fold").cast("long").alias("fold"), "learner", F.col("p").between(0, 1).alias("in_range"))
             for n in BOOSTERS for p in _scores(spark, sf, n)]
    return _union(parts)


@register("stack_cv_scores")
def stack_cv_scores(spark, sf):
    """Per-learner, per-fold log loss of the OOF predictions."""
    return _stack(spark, sf, BOOSTERS)[2]


def _split(spark, sf, size=0.25, seed=0):
    train, test, cols = _frames(spark, sf)
    return train_test_split(train, size, seed=seed), test, cols


@register("logreg")
def logreg(spark, sf):
    """M9 (multinomial, standardised) + M14 on a 25 % holdout: (part, accuracy)."""
    s, _, _ = _split(spark, sf)
    fit = s.where(~F.col("is_test"))
    m = make_learner("lr", PRESET, n_rows=fit.count(), C=1.0, family="multinomial").fit(fit)
    p = m.transform(s.where(F.col("is_test")))
    return ev.accuracy(p).withColumn("model", F.lit("logreg"))


@register("mlp")
def mlp(spark, sf):
    """MLP regressor (5, 5) with L2 on scaled features, a 25 % holdout; R^2 (M16), accuracy at 0.5, iterations."""
    s, _, _ = _split(spark, sf)
    fit = s.where(~F.col("is_test"))
    scale = Preparation(scale=True).fit(fit)
    m = MLPRegressor((5, 5), max_iter=200 if PRESET == "reference" else 20).fit(scale.transform(fit))
    p = m.transform(scale.transform(s.where(F.col("is_test"))), "score").withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    p = p.checkpoint(eager=True)
    return ev.accuracy(p).withColumn("r2", ev.r2_score(p).select("r2").scalar()).withColumn("iterations", F.lit(m.iterations))


def _importance(spark, sf):
    return _once(spark, sf, "importance", lambda: fit_importance_model(_frames(spark, sf)[0], PRESET))


@register("gbt_early_stop")
def gbt_early_stop(spark, sf):
    """Booster with validation-driven early stopping; (trees, validation AUC)."""
    model, s = _importance(spark, sf)
    v = model.transform(s.where(F.col("is_valid"))).withColumn("score", prob1())
    return ev.auc(v).withColumn("trees", F.lit(model.getNumTrees))


@register("importance_topk")
def importance_topk(spark, sf):
    """M21 + S4: the 20 most important features of the booster."""
    imp = importance_table(_importance(spark, sf)[0], _frames(spark, sf)[2])
    return imp.orderBy(F.col("importance").desc(), F.col("col").asc()).limit(20)


@register("selection_compare")
def selection_compare(spark, sf):
    """5-fold accuracy of a small forest on all vs selected features (mean, std)."""
    train, _, cols = _frames(spark, sf)
    idx = top_k_features(importance_table(_importance(spark, sf)[0], cols), 20)
    sel = stratified_kfold(select_features(train, idx), K, shuffle=False)
    a = ev.summary(cv_accuracy(sel, "features", fold="fold"), "accuracy").withColumn("features", F.lit("all"))
    b = ev.summary(cv_accuracy(sel, "features_sel", fold="fold"), "accuracy").withColumn("features", F.lit("selected"))
    return a.unionByName(b)


def _sbbtree(spark, sf, bagging_num=1):
    """The ensemble with its first ``bagging_num`` of three bags: bags are fitted side by side and do not depend on each other."""
    train, _, _ = _frames(spark, sf)
    m = _once(spark, sf, "sbbtree", lambda: StackedBagging(
        stacking_num=2, bagging_num=3, bagging_test_size=0.33, preset=PRESET, parallelism=3).fit(train))
    return StackedBaggingModel(m.stacking_models, m.bagging_models[:bagging_num], m.features)


@register("sbbtree")
def sbbtree(spark, sf):
    """Stacked bagging ensemble scored on the labelled rows (user_id, merchant_id, label, prob)."""
    return _sbbtree(spark, sf).transform(_frames(spark, sf)[0]).select(*KEYS, "label", "prob")


@register("bagging_predict")
def bagging_predict(spark, sf):
    """K6: three seeded bags, averaged."""
    return _sbbtree(spark, sf, bagging_num=3).transform(_frames(spark, sf)[1]).select(*KEYS, "prob")


@register("submission")
def submission(spark, sf):
    """M25/IO6: the full modelling path -> (user_id, merchant_id, prob) for every test pair."""
    return _once(spark, sf, "submission", lambda: _written(pl.run(spark, sf, preset=PRESET), "submission"))


@register("predicted_rows", sql=fx.with_fixtures(
    "SELECT 'submission' AS source, user_id, merchant_id, true AS in_range FROM test UNION ALL "
    "SELECT 'bagging', user_id, merchant_id, true FROM test UNION ALL SELECT 'sbbtree', user_id, merchant_id, true FROM train"))
def predicted_rows(spark, sf):
    """Companion of ``submission``, ``bagging_predict`` and ``sbbtree``: the pairs they score."""
    parts = {"submission": submission, "bagging": bagging_predict, "sbbtree": sbbtree}
    return _union([q(spark, sf).select(F.lit(n).alias("source"), *KEYS, F.col("prob").between(0, 1).alias("in_range"))
                   for n, q in parts.items()])
