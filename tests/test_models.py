"""Property tests for trained-model operators (no SQL oracle)."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shopsignal.operators import evaluate as ev
from shopsignal.operators.learners import make_learner
from shopsignal.operators.ensemble import StackedBagging, oof_stacking
from shopsignal.plans import pipeline as pl
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def planted(spark):
    """Pairs with a planted signal: label depends on x1 (AUC of a good model > 0.8)."""
    df = (spark.range(4000).withColumn("user_id", F.col("id")).withColumn("merchant_id", F.col("id") % 97)
          .withColumn("x1", F.rand(7)).withColumn("x2", F.rand(8))
          .withColumn("label", (F.col("x1") + 0.2 * F.rand(9) > 0.6).cast("double")))
    df = VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(df)
    df = df.select("user_id", "merchant_id", "label", "features").checkpoint(eager=True)
    return df.where(F.col("id") % 5 != 0) if "id" in df.columns else df


def test_unknown_learner():
    with pytest.raises(ValueError):
        make_learner("svm")


def test_oof_properties(spark, planted):
    train = planted.where(F.col("user_id") % 5 != 0)
    test = planted.where(F.col("user_id") % 5 == 0).drop("label")
    tm, sm, cv = oof_stacking(train, test, ["gnb", "lgb"], k=3, preset="small")
    n = train.count()
    assert tm.count() == n and tm.select("user_id", "merchant_id").distinct().count() == n
    assert sm.count() == test.count()
    for c in ("gnb", "lgb"):
        assert tm.where((F.col(c) < 0) | (F.col(c) > 1) | F.col(c).isNull()).count() == 0
    a = ev.auc(tm.withColumn("score", F.col("lgb"))).first()["auc"]
    assert a > 0.8
    assert cv.count() == 6


def test_oof_deterministic(spark, planted):
    train = planted.where(F.col("user_id") % 5 != 0)
    test = planted.where(F.col("user_id") % 5 == 0).drop("label")
    a = oof_stacking(train, test, ["gnb"], k=3)[0].orderBy("user_id").collect()
    b = oof_stacking(train, test, ["gnb"], k=3)[0].orderBy("user_id").collect()
    assert a == b


def test_stacked_bagging(spark, planted):
    train = planted.where(F.col("user_id") % 5 != 0)
    m = StackedBagging(stacking_num=2, bagging_num=2, preset="small").fit(train)
    out = m.transform(train)
    assert out.where((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0
    assert ev.auc(out.withColumn("score", F.col("prob"))).first()["auc"] > 0.8


def test_feature_frame_has_no_ids(spark):
    train, test, cols = pl.model_frames(spark, SF_MID)
    assert not {"user_id", "merchant_id", "label", "prob"} & set(cols)
    assert train.where(F.col("label").isNull()).count() == 0
    assert test.count() > 0


def test_hashing_tf_counts_every_token(spark):
    from shopsignal.operators import text as tx
    from shopsignal.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    from pyspark.ml.functions import vector_to_array
    log = fx.user_log(spark, SF_SMALL)
    h = tx.hashed_tfidf(log, "seller_id", 100)
    got = {r["user_id"]: r["n"] for r in h.select(
        "user_id", F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, b: a + b).alias("n")).collect()}
    want = {r["user_id"]: r["n"] for r in log.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: float(v) for k, v in want.items()}


@pytest.mark.parametrize("fit_rows", [700, 10**6])
@pytest.mark.parametrize("name", ["gnb", "gb", "rf", "knn"])
def test_oof_rows_scored_by_models_that_did_not_see_them(spark, planted, name, fit_rows):
    """Each OOF score equals the score of a model fit without the row's fold, on the rows that a fit may read."""
    from shopsignal.operators.folds import kfold
    from shopsignal.operators.learners import BOUNDED, fit_sample, prob1
    train = planted.where(F.col("user_id") % 5 != 0)
    tm, _, _ = oof_stacking(train, train.drop("label").limit(1), [name], k=3, preset="small", fit_rows=fit_rows)
    f = kfold(train, 3, seed=0)
    sample = fit_sample(f, fit_rows) if name in BOUNDED else f
    # the same folds, with the labels of fold 1 turned round: a model of fold 1 must not notice
    turned = f.withColumn("label", F.when(F.col("fold") == 1, 1 - F.col("label")).otherwise(F.col("label"))).drop("fold")
    other, _, _ = oof_stacking(turned, train.drop("label").limit(1), [name], k=3, preset="small", fit_rows=fit_rows)
    mine = f.where("fold = 1").select("user_id", "merchant_id")
    both = mine.join(tm.select("user_id", "merchant_id", F.col(name).alias("a")), ["user_id", "merchant_id"]).join(
        other.select("user_id", "merchant_id", F.col(name).alias("b")), ["user_id", "merchant_id"])
    assert both.count() == mine.count() and both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    if name in ("gnb", "knn"):  # and the score is that of a model fitted by itself
        m = make_learner(name, "small").fit(sample.where(F.col("fold") != 1))
        own = m.transform(f.where(F.col("fold") == 1)).select("user_id", "merchant_id", prob1().alias("own"))
        assert own.join(tm, ["user_id", "merchant_id"]).where(F.abs(F.col("own") - F.col(name)) > 1e-9).count() == 0


def test_missing_marker_and_indicator(spark):
    """A user without history has -1 statistics, the indicator, and the median inside a fold."""
    from pyspark.ml.functions import vector_to_array
    from shopsignal.operators.prepare import Preparation
    cols = [c for c in ("user_cnt", "buy_cnt")]
    df = spark.createDataFrame([(1, 1, 0.0, 4, 1), (2, 1, 1.0, -1, -1), (3, 1, 0.0, 8, 3), (4, 1, 1.0, 6, 2)],
                               "user_id long, merchant_id long, label double, user_cnt long, buy_cnt long")
    a = pl.assemble(df, cols, missing_value=-1.0)
    got = {r["user_id"]: r["features"].toArray().tolist() for r in a.collect()}
    assert got[2] == [-1.0, -1.0, 0.0] and got[1] == [4.0, 1.0, 1.0]
    marker, marked = pl.missing_markers(cols + ["has_history"])
    assert marked == (0, 1)
    done = Preparation(missing=marker, marked=marked).fit(a).transform(a)
    got = {r["user_id"]: r["v"] for r in done.select("user_id", vector_to_array("features").alias("v")).collect()}
    assert got[2] == [6.0, 2.0, 0.0] and got[3] == [8.0, 3.0, 1.0]


def test_preparation_never_sees_held_out_rows(spark):
    from pyspark.ml.functions import vector_to_array
    from shopsignal.operators.prepare import Prepared, Preparation

    class Keep:
        def fit(self, df):
            return self

        def transform(self, df):
            return df.withColumn("seen", vector_to_array("features"))

    rows = [(i, float(i), 7.0, False) for i in range(5)] + [(9, 1e6, -1e6, True)]
    df = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(
        spark.createDataFrame(rows, "id long, x double, y double, held boolean"))
    model = Prepared(Keep(), Preparation(scale=True), "held").fit(df)
    assert model.preparation.mean == [2.0, 7.0]
    assert model.preparation.std == [pytest.approx(2 ** 0.5), 1.0]  # population std; a constant column becomes 0
    out = {r["id"]: r for r in model.transform(df).collect()}
    assert out[4]["seen"] == [pytest.approx(2 / 2 ** 0.5), 0.0]
    assert out[4]["features"].toArray().tolist() == [4.0, 7.0]  # the caller's features stay


def test_lr_and_mlp_beat_the_majority(spark, planted):
    """On features of very different scale with a planted signal."""
    from shopsignal.operators.learners import prob1
    from pyspark.ml.functions import vector_to_array
    a = vector_to_array("features")
    big = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        planted.select("user_id", "merchant_id", "label", (a[0] * 1e5 + 1e6).alias("a"), (a[1] * 1e-3).alias("b")))
    fit, held = big.where("user_id % 4 <> 0"), big.where("user_id % 4 = 0")
    share = held.agg(F.avg("label")).first()[0]
    for est in (make_learner("lr", n_rows=fit.count(), C=1.0), make_learner("mlp", n_features=2, hidden=(5, 5))):
        p = est.fit(fit).transform(held)
        assert ev.accuracy(p).first()["accuracy"] > max(share, 1 - share) + 0.2
        assert ev.auc(p.withColumn("score", prob1())).first()["auc"] > 0.8


@pytest.mark.parametrize("fit_rows", [900, 10**6])
def test_boosters_see_only_their_own_held_out_fold(spark, planted, fit_rows):
    """Fold 0's booster is the one fitted on the other folds and stopped on fold 0, within the sample."""
    from shopsignal.operators.folds import kfold
    from shopsignal.operators.learners import fit_sample, prob1
    f = kfold(planted, 3, seed=0).withColumn("_valid", F.col("fold") == 0)
    m = make_learner("lgb", "small", valid="_valid").fit(fit_sample(f, fit_rows))
    tm, _, _ = oof_stacking(planted, planted.drop("label").limit(1), ["lgb"], k=3, preset="small", fit_rows=fit_rows)
    own = m.transform(f.where("fold = 0")).select("user_id", "merchant_id", prob1().alias("own"))
    assert own.join(tm, ["user_id", "merchant_id"]).where(F.abs(F.col("own") - F.col("lgb")) > 1e-9).count() == 0
    assert f.where("fold = 0").count() == own.count() > 0


def test_fit_sample_is_bounded_and_stable(spark):
    from shopsignal.operators.learners import fit_sample
    df = spark.range(5000).select(F.col("id").alias("user_id"), F.lit(1).alias("merchant_id"))
    a = fit_sample(df, 700)
    assert a.count() == 700 and fit_sample(df, 6000).count() == 5000
    b = fit_sample(df.repartition(13), 700)
    assert a.exceptAll(b).count() == 0


def test_bootstrap_bagging(spark, planted):
    train = planted.where(F.col("user_id") % 5 != 0)
    out = StackedBagging(stacking_num=1, bagging_num=2, bootstrap=True, preset="small").fit(train).transform(train)
    assert out.where((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0


def test_null_keys_rejected(spark):
    df = spark.createDataFrame([(1, None)], "user_id long, merchant_id long")
    with pytest.raises(ValueError):
        pl.assert_keys_not_null(df)


def test_reference_presets_carry_reference_sizes(spark):
    rf, et = (make_learner(n).settings for n in ("rf", "et"))
    assert (rf.trees, rf.depth, rf.bootstrap, rf.random_thresholds) == (1200, 20, True, False)
    assert (et.trees, et.depth, et.bootstrap, et.random_thresholds) == (1200, 35, False, True)
    gb = make_learner("gb", "reference").settings
    assert (gb.rounds, gb.rate, gb.row_share, gb.depth, gb.patience) == (100, 0.04, 0.8, 5, 0)
    xgb = make_learner("xgb", "reference").settings
    assert (xgb.rounds, xgb.patience, xgb.rate, xgb.depth, xgb.l2, xgb.gamma, xgb.min_hessian) == (10000, 100, 0.03, 5, 10, 1, 1.5)
    assert xgb.missing and xgb.row_share == xgb.column_share == xgb.level_share == 0.7
    lgb = make_learner("lgb", "reference").settings
    assert (lgb.rounds, lgb.patience, lgb.rate, lgb.leaves, lgb.l2, lgb.missing) == (10000, 100, 0.3, 32, 10, False)
    es = make_learner("gbt_es", "reference").settings
    assert (es.rounds, es.patience, es.rate, es.leaves, es.metric, es.min_rows) == (10000, 200, 0.03, 9, "auc", 20)
    assert make_learner("knn").k == 200
    assert make_learner("mlp", n_features=7).learner.getLayers() == [7, 50, 50, 2]


def test_bootstrap_counts(spark):
    """Poisson counts from the keys alone: the same for any partitioning, with the law's mean and variance."""
    from shopsignal.operators.folds import bootstrap_count
    df = spark.range(20000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("merchant_id"))
    rows = [sorted(map(tuple, df.repartition(p).select("user_id", bootstrap_count(1).alias("a"), bootstrap_count(2).alias("b")).collect()))
            for p in (1, 4, 16)]
    assert rows[0] == rows[1] == rows[2]
    a, b = ([r[i] for r in rows[0]] for i in (1, 2))
    assert a != b and abs(sum(a) / 20000 - 1) < 0.03 and abs(sum((x - 1) ** 2 for x in a) / 20000 - 1) < 0.06
    assert abs(a.count(0) / 20000 - 0.3679) < 0.015


def test_importance_counts_splits_of_the_node_table(spark, duck, tmp_path):
    """The reference's split counts, against SQL over the written node table."""
    import duckdb

    from shopsignal.operators.boosting import Boosting, fit_boosters
    from shopsignal.operators.select import importance_table, top_k_features
    from tests.test_boosting import frame, planted as made
    x, y = made()
    model, = fit_boosters(frame(spark, x, y), [Boosting(rounds=8, leaves=6)], [F.lit(1.0)], [F.lit(False)], ["k"])
    model.nodes(spark).write.parquet(str(tmp_path / "nodes"))
    for by, value in (("split", "count(*)::DOUBLE"), ("gain", "sum(gain)")):
        want = dict(duckdb.sql(f"SELECT feature, {value} FROM '{tmp_path}/nodes/*.parquet' WHERE feature >= 0 GROUP BY feature").fetchall())
        got = importance_table(model, list("abcd"), by)
        assert {r["col"]: r["importance"] for r in got.collect()} == pytest.approx({i: want.get(i, 0.0) for i in range(4)})
        assert top_k_features(got, 2) == sorted(sorted(range(4), key=lambda i: (-want.get(i, 0.0), i))[:2])
