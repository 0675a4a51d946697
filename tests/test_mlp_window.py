"""MLP regressor, saved ensembles, mergeable distinct counts."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shopsignal.operators import features as feat
from shopsignal.operators import mlp
from shopsignal.operators.ensemble import StackedBagging, StackedBaggingModel
from tests.test_models import planted  # noqa: F401


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    sizes = [3, 4, 2, 1]
    flat = rng.normal(size=sum(a * b for a, b in mlp.shapes(sizes)))
    x, y = rng.normal(size=(20, 3)), rng.normal(size=20)
    _, grad = mlp.loss_and_gradient(x, y, flat, sizes)
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        up, down = (mlp.loss_and_gradient(x, y, flat + s, sizes)[0] for s in (step, -step))
        assert np.isclose(grad[i], (up - down) / 2e-6, rtol=1e-4, atol=1e-5)


def test_minimiser_on_a_known_valley():
    def rosenbrock(v):
        a, b = v
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    at, steps = mlp.minimise(rosenbrock, np.array([-1.2, 1.0]), max_iter=200, tol=1e-6)
    assert np.allclose(at, 1, atol=1e-4) and steps < 120


def linear(spark, n=2000, parts=3):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=n) * 0.05
    df = spark.createDataFrame([(i, [float(a) for a in r], float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, x array<double>, label double")
    return df.withColumn("features", array_to_vector("x")).repartition(parts)


def test_regressor_finds_a_linear_signal(spark):
    df = linear(spark)
    fit, held = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    model = mlp.MLPRegressor((5, 5)).fit(fit)
    p = model.transform(held).select("label", "prediction").toPandas()
    r2 = 1 - ((p.label - p.prediction) ** 2).sum() / ((p.label - p.label.mean()) ** 2).sum()
    assert r2 > 0.99
    strong = mlp.MLPRegressor((5, 5), alpha=1e4).fit(fit)
    assert sum((w[:-1] ** 2).sum() for w in strong.weights) < 0.1 * sum((w[:-1] ** 2).sum() for w in model.weights)
    other = mlp.MLPRegressor((5, 5), max_iter=4).fit(linear(spark, parts=40).where("id % 4 <> 0"))  # added in a tree of tasks
    same = mlp.MLPRegressor((5, 5), max_iter=4).fit(fit)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(other.weights, same.weights))


def test_regressor_on_odd_rows(spark):
    df = linear(spark, 50)
    nulls = df.select(F.lit(None).cast("long").alias("id"), "x", F.lit(None).cast("double").alias("label"), "features").limit(3)
    assert mlp.MLPRegressor((2,), max_iter=3).fit(df.union(nulls)).iterations <= 3
    empty = mlp.MLPRegressor().fit(df.limit(0))
    assert {r["prediction"] for r in empty.transform(df).collect()} == {0.0}


def test_ensemble_saves_and_loads(spark, planted, tmp_path):  # noqa: F811
    train = planted.where("user_id % 5 <> 0")
    model = StackedBagging(stacking_num=2, bagging_num=2, bootstrap=True, preset="small").fit(train)
    model.write().save(str(tmp_path / "m"))
    again = StackedBaggingModel.load(str(tmp_path / "m"))
    a, b = ({(r["user_id"], r["merchant_id"]): r["prob"] for r in m.transform(train).collect()} for m in (model, again))
    assert a == pytest.approx(b) and len(a) > 3000
    with pytest.raises(Exception):
        model.write().save(str(tmp_path / "m"))
    model.write().overwrite().save(str(tmp_path / "m"))


def test_sketches_merge_to_one_pass(spark):
    log = spark.range(60_000).select((F.col("id") % 3).alias("user_id"), (F.col("id") % 50).cast("int").alias("time_stamp"),
                                     (F.xxhash64("id") % 9000).alias("item_id"), F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("brand_id"))
    columns = {"item": "item_id", "brand": "brand_id"}
    days = feat.distinct_sketches(log, columns)
    for first, last in ((0, 49), (10, 20), (5, 5)):
        got = {(r["user_id"], r["column"]): r["nunique"] for r in feat.distinct_in_window(days, first, last).collect()}
        part = log.where(F.col("time_stamp").between(first, last))
        at_once = {(r["user_id"], r["column"]): r["nunique"] for r in feat.distinct_in_window(
            feat.distinct_sketches(part.withColumn("time_stamp", F.lit(0)), columns), 0, 0).collect()}
        exact = {}
        for n, c in columns.items():
            exact |= {(r["user_id"], n): r["k"] for r in part.where(F.col(c).isNotNull()).groupBy("user_id").agg(F.count_distinct(c).alias("k")).collect()}
        assert got.keys() == exact.keys() == at_once.keys()
        for k, v in exact.items():
            assert abs(got[k] - v) <= max(0.5, 4 * 0.0163 * v) and abs(got[k] - at_once[k]) <= max(0.5, 0.05 * v)
    assert feat.distinct_in_window(days, 90, 99).count() == 0
