"""Perceptron classifier fitted on all rows in passes over packed blocks."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shopsignal.operators import evaluate as ev
from shopsignal.operators import mlp
from shopsignal.operators.learners import make_learner, prob1


def pairs(spark, n=4000, per_user=8, parts=2):
    """Pairs whose features are their user's; the label follows two features and chance."""
    df = spark.range(0, n, 1, parts).select(F.floor(F.col("id") / per_user).alias("user_id"), F.col("id").alias("merchant_id"))
    x = [(F.pmod(F.xxhash64("user_id", F.lit(i)), F.lit(1000)) / 1000.0).alias(f"x{i}") for i in range(6)]
    df = df.select("*", *x)
    chance = F.pmod(F.xxhash64("merchant_id"), F.lit(1000)) / 1000.0
    df = df.withColumn("label", (F.col("x0") + F.col("x1") + chance > 1.5).cast("double"))
    return df.select("user_id", "merchant_id", "label", array_to_vector(F.array(*[f"x{i}" for i in range(6)])).alias("features"))


def test_class_gradient_against_differences():
    rng = np.random.default_rng(0)
    sizes = [3, 4, 5, 2]
    x, y, times = rng.normal(size=(20, 3)), rng.integers(0, 2, 20), rng.integers(1, 4, 20).astype(float)
    flat = rng.normal(size=sum(a * b for a, b in mlp.shapes(sizes)))
    loss, grad = mlp.class_loss_and_gradient(x, y, times, flat, sizes)
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        up, down = (mlp.class_loss_and_gradient(x, y, times, flat + s, sizes)[0] for s in (step, -step))
        assert (up - down) / 2e-6 == pytest.approx(grad[i], abs=1e-4)
    again = mlp.class_loss_and_gradient(np.repeat(x, times.astype(int), 0), np.repeat(y, times.astype(int)), np.ones(int(times.sum())), flat, sizes)
    assert again[0] == pytest.approx(loss) and np.allclose(again[1], grad)


def test_perceptron_has_each_row_once_and_reaches_sparks_loss(spark):
    df = pairs(spark).cache()
    blocks = mlp.class_blocks(df, [6, 8, 8, 2], "features", "label").collect()
    assert sum(b[2].sum() for b in blocks) == 4000 and sum(len(b[1]) for b in blocks) <= 2 * 500 + 2
    loss = {}
    for kind in (mlp.Perceptron, MultilayerPerceptronClassifier):
        model = kind(layers=[6, 8, 8, 2], maxIter=40, seed=1).fit(df)
        assert isinstance(model, MultilayerPerceptronClassificationModel)
        loss[kind] = ev.log_loss(model.transform(df).withColumn("score", prob1())).first()["log_loss"]
    assert loss[mlp.Perceptron] < 1.02 * loss[MultilayerPerceptronClassifier]  # Spark's line search may fail early
    assert isinstance(make_learner("mlp", n_features=6).learner, mlp.Perceptron)


def test_perceptron_starts_from_sparks_weights_and_refuses_odd_labels(spark):
    df = pairs(spark, 200)
    own, sparks = (kind(layers=[6, 4, 2], maxIter=0, seed=3).fit(df).weights.toArray() for kind in (mlp.Perceptron, MultilayerPerceptronClassifier))
    assert np.array_equal(own, sparks)
    for label in (None, 0.5, 2.0):
        with pytest.raises(Exception):
            mlp.Perceptron(layers=[6, 4, 2], maxIter=1).fit(df.withColumn("label", F.lit(label).cast("double")))
