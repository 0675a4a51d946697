"""Pluggable classifiers by name (UD6): M2-M9, M13, M20.

Each name maps to settings of this library's tree learners or to a Spark ML estimator. The
default preset ``reference`` carries the reference's sizes; ``small`` keeps the same shape with
sizes for tests. An unknown name raises ``ValueError``.

Every learner is fitted on all labelled rows that it is given, and scores are computed for every
row. ``fit_sample`` is for callers that name a bound themselves; no query does.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.operators.boosting import Boosting, HistogramBooster
from shopsignal.operators.forest import Forest, ForestLearner
from shopsignal.operators.knn import KNeighbors
from shopsignal.operators.mlp import Perceptron
from shopsignal.operators.prepare import Preparation, Prepared
from shopsignal.plans.ranking import order_cuts
from shopsignal.session import ensure_checkpoint_dir

SEED = 2017
# Partitions of a sample.
SAMPLE_PARTITIONS = 32

# M4: 100 trees, rate 0.04, subsample 0.8, depth 5, splits by squared error
# M6: depth 5, eta 0.03, lambda 10, gamma 1, min_child_weight 1.5, subsample / colsample 0.7 by tree and level,
#     missing = -1, a tree per class, base score 0.5
# M7: 32 leaves, rate 0.3, lambda 10, min hessian 1.5, 20 rows a leaf, feature fraction 0.7; no bagging frequency, so no bagging
# 9 leaves, rate 0.03, feature fraction 0.9, bagging 0.8 every 5 rounds, min_data 20, min_hessian 1, AUC
BOOSTERS = {
    "gb": Boosting(rounds=100, rate=0.04, depth=5, row_share=0.8, by_rows=True, min_hessian=0.0, seed=SEED),
    "xgb": Boosting(rounds=10_000, patience=100, rate=0.03, depth=5, l2=10.0, gamma=1.0, min_hessian=1.5, row_share=0.7,
                    column_share=0.7, level_share=0.7, both_classes=True, from_prior=False, missing=True, seed=SEED),
    "lgb": Boosting(rounds=10_000, patience=100, rate=0.3, leaves=32, l2=10.0, min_hessian=1.5, min_rows=20, column_share=0.7,
                    both_classes=True, seed=SEED),
    "gbt_es": Boosting(rounds=10_000, patience=200, rate=0.03, leaves=9, min_hessian=1.0, min_rows=20, row_share=0.8, bag_every=5,
                       column_share=0.9, metric="auc", seed=2),
}
# Rounds and patience of the small preset.
SMALL = {"gb": (10, 0), "xgb": (15, 5), "lgb": (15, 5), "gbt_es": (30, 5)}
# M2: 1200 trees of depth 20, bootstrap, sqrt features; M5: 1200 of depth 35, all rows, random thresholds
FORESTS = {"rf": Forest(trees=1200, depth=20, seed=SEED),
           "et": Forest(trees=1200, depth=35, bootstrap=False, random_thresholds=True, seed=SEED)}
SMALL_FORESTS = {"rf": (20, 6), "et": (20, 8)}
# Learners whose fits a caller may bound.
BOUNDED = {*BOOSTERS, *FORESTS, "ada"}


def booster_settings(name: str, preset: str = "reference", **changes) -> Boosting:
    rounds, patience = SMALL[name]
    sizes = {"rounds": rounds, "patience": patience} if preset == "small" else {}
    return replace(BOOSTERS[name], **(sizes | changes))


def forest_settings(name: str, preset: str = "reference") -> Forest:
    trees, depth = SMALL_FORESTS[name]
    return replace(FORESTS[name], trees=trees, depth=depth) if preset == "small" else FORESTS[name]


def _gnb(p, **kw):
    # M8: Gaussian naive Bayes
    return NaiveBayes(modelType="gaussian", **kw)


def _lr(p, n_rows: int | None = None, C: float = 0.1, **kw):
    # M9: inverse strength C (0.1 for the stacked learner, 1.0 by default elsewhere) ->
    # regParam = 1 / (C * n); 200 iterations
    reg = 1.0 / (C * n_rows) if n_rows else 0.0
    return LogisticRegression(maxIter=200 if p == "reference" else 50, regParam=reg, standardization=False, **kw)


def _mlp(p, n_features: int = 0, hidden=(50, 50), **kw):
    # MLP with two hidden layers, l-bfgs
    return Perceptron(layers=[n_features, *hidden, 2], solver="l-bfgs", maxIter=200 if p == "reference" else 20, seed=1, **kw)


FACTORIES = {"gnb": _gnb, "lr": _lr, "mlp": _mlp}


def make_learner(name: str, preset: str = "reference", features: str = "features", label: str = "label",
                 valid: str | None = None, missing: tuple[float, tuple[int, ...]] | None = None, **params):
    """The learner ``name``; ``lr`` and ``mlp`` standardise their features (fitted with the model).

    ``valid``: a boolean column of held-out rows; boosters with patience then keep
    their rounds up to the best one on these rows. ``missing``: (marker, feature
    indices) that boosters which read missing values send in a learned direction.
    """
    if name == "ada":
        return AdaBoostSAMME(n_estimators=50 if preset == "reference" else 5, learning_rate=0.01,
                             features=features, label=label)
    if name in BOOSTERS:
        settings = booster_settings(name, preset, **params)
        return HistogramBooster(settings, features, label, valid, missing=missing if settings.missing else None)
    if name == "knn":
        return KNeighbors(200 if preset == "reference" else 15, features, label)  # M10
    if name in FORESTS:
        return ForestLearner(forest_settings(name, preset), features, label)
    if name not in FACTORIES:
        raise ValueError(f"unknown learner {name!r}; known: {sorted([*FACTORIES, *BOOSTERS, *FORESTS, 'ada', 'knn'])}")
    learner = FACTORIES[name](preset, featuresCol=features, labelCol=label, **params)
    return Prepared(learner, Preparation(features, True), valid) if name in ("lr", "mlp") else learner


def fit_sample(df: DataFrame, bound: int, keys=("user_id", "merchant_id")) -> DataFrame:
    """At most ``bound`` rows: the first in md5 order of their keys (all rows if there are no more).

    A sample is checkpointed, so that a fit's many passes read it and not the whole frame again.
    """
    if df.count() <= bound:
        return df
    h = F.md5(F.concat_ws("_", F.lit("fit"), *[F.col(k).cast("string") for k in keys]))
    ensure_checkpoint_dir(df.sparkSession)
    return df.where(h < order_cuts(df, h, [bound])[0]).repartition(SAMPLE_PARTITIONS, *keys).checkpoint(eager=True)


def prob1(df: DataFrame | None = None, col: str = "probability") -> F.Column:
    """P(class 1) from a classifier's probability vector (D4: never class 0)."""
    return vector_to_array(F.col(col))[1]


class AdaBoostSAMME:
    """M3: SAMME boosting of depth-1 trees with a weight column.

    Each round is one Spark job over the weighted training frame; weights are
    a column updated by an expression, and the frame is checkpointed every
    few rounds so lineage does not grow with the number of rounds.
    """

    def __init__(self, n_estimators=50, learning_rate=0.01, features="features", label="label"):
        self.n, self.lr, self.features, self.label = n_estimators, learning_rate, features, label

    def fit(self, df: DataFrame) -> "AdaBoostModel":
        n = df.count()
        cur = df.withColumn("_w", F.lit(1.0 / n))
        stumps, alphas = [], []
        for i in range(self.n):
            stump = DecisionTreeClassifier(maxDepth=1, featuresCol=self.features, labelCol=self.label,
                                           weightCol="_w", predictionCol="_p", probabilityCol="_pp",
                                           rawPredictionCol="_rp").fit(cur)
            pred = stump.transform(cur)
            miss = (F.col("_p") != F.col(self.label)).cast("double")
            err = pred.agg((F.sum(F.col("_w") * miss) / F.sum("_w")).alias("e")).first()["e"]
            if err is None or err >= 0.5:
                break
            alpha = self.lr * math.log((1 - err) / max(err, 1e-12))  # K = 2: log(K - 1) = 0
            stumps.append(stump)
            alphas.append(alpha)
            cur = pred.withColumn("_w", F.col("_w") * F.exp(F.lit(alpha) * miss)).drop("_p", "_pp", "_rp")
            if (i + 1) % 5 == 0 and i + 1 < self.n:
                cur = cur.checkpoint(eager=True)
            if err == 0:
                break
        return AdaBoostModel(stumps, alphas, self.features)


def _stump_vote(stump, x: F.Column) -> F.Column | None:
    """1 or -1 by the stump's threshold, as an expression of the feature array; None for a split by categories."""
    vote = lambda node: F.lit(1.0 if node.prediction() == 1 else -1.0)
    root = stump._java_obj.rootNode()
    if not stump.depth:
        return vote(root)
    split = root.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        return None
    return F.when(x[split.featureIndex()] <= split.threshold(), vote(root.leftChild())).otherwise(vote(root.rightChild()))


class AdaBoostModel:
    def __init__(self, stumps, alphas, features="features"):
        self.stumps, self.alphas, self.features = stumps, alphas, features

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        out = df.withColumn("_dec", F.lit(0.0))
        x = vector_to_array(F.col(self.features))
        for s, a in zip(self.stumps, self.alphas):
            vote = _stump_vote(s, x)
            if vote is not None:
                out = out.withColumn("_dec", F.col("_dec") + F.lit(a) * vote)
                continue
            out = s.setPredictionCol("_p").setProbabilityCol("_pp").setRawPredictionCol("_rp").transform(out)
            out = out.withColumn("_dec", F.col("_dec") + F.lit(a) * F.when(F.col("_p") == 1, 1.0).otherwise(-1.0))
            out = out.drop("_p", "_pp", "_rp")
        total = sum(self.alphas) or 1.0
        p1 = 1 / (1 + F.exp(-2 * F.col("_dec") / total))
        return (out.withColumn("probability", array_to_vector(F.array(1 - p1, p1)))
                .withColumn("prediction", (p1 > 0.5).cast("double")).drop("_dec"))
