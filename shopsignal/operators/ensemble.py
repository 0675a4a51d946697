"""Out-of-fold stacking (M1), stacked bagging ensemble (M24) and model averaging.

Folds are a column (K1/K3). The tree learners of all folds and bags are fitted side by side over
all rows; other learners are one Spark ML job per fold on a filter of the persisted frame. A fold's scores are written as soon as its model is fitted and the model is dropped. Keys
travel with every prediction (no positional concat, D6); scores are P(class 1) (D4) in training
and scoring alike (D8).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.operators import evaluate as ev
from shopsignal.operators.boosting import BoostedModel, fit_boosters
from shopsignal.operators.folds import bootstrap_count, kfold, stratified_kfold, train_test_split
from shopsignal.operators.forest import fit_forests
from shopsignal.operators.learners import (BOOSTERS, BOUNDED, FORESTS, booster_settings, fit_sample, forest_settings, make_learner,
                                           prob1)
from shopsignal.operators.prepare import PreparedModel
from shopsignal.session import ensure_checkpoint_dir

KEYS = ["user_id", "merchant_id"]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _n_features(df: DataFrame, features: str) -> int:
    return len(df.select(features).first()[0])


def _learner(name, preset, n_features, n_rows, features, label, **extra):
    if name == "mlp":
        extra["n_features"] = n_features
    if name == "lr":
        extra["n_rows"] = n_rows
    return make_learner(name, preset, features=features, label=label, **extra)


def _each(work, jobs, parallelism: int) -> list:
    """Run the jobs, some at a time: small fits leave executors idle one by one."""
    if parallelism <= 1:
        return [work(j) for j in jobs]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(work, jobs))


def _shared_folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def oof_scores(train: DataFrame, test: DataFrame, learners: list[str], k: int = 5, seed: int = 0,
               preset: str = "reference", features: str = "features", label: str = "label",
               parallelism: int = 8, missing: dict[str, tuple] | None = None, fit_rows: int | None = None):
    """M1 in long form: (keys, label, learner, fold, p) of the held-out rows, and of all test rows per fold.

    A fold's model is fitted on the rows of the other folds; boosters stop early on those of the
    held-out fold, as the reference's do, other learners never see it. All rows are fitted on and
    scored; a caller's ``fit_rows`` bounds the rows that tree learners are fitted on. ``missing``: per learner, its missing marker.
    """
    spark = train.sparkSession
    tr = kfold(train, k, seed=seed).persist(StorageLevel.MEMORY_AND_DISK)
    te = test.persist(StorageLevel.MEMORY_AND_DISK)
    d = _n_features(tr, features)
    folder = _shared_folder(spark, "oof")
    sample = fit_sample(tr, fit_rows) if fit_rows and BOUNDED & set(learners) else tr
    others, own = [F.col("fold") != i for i in range(k)], [F.col("fold") == i for i in range(k)]
    fitted: dict[tuple[str, int], object] = {}
    boosters = [n for n in learners if n in BOOSTERS]
    if boosters:  # all folds of all boosters in one go
        settings = [booster_settings(n, preset) for n in boosters for _ in range(k)]
        marker, marked = next((m for n, m in (missing or {}).items() if n in boosters), (None, ()))
        models = fit_boosters(sample, settings, [w.cast("double") for w in others] * len(boosters), own * len(boosters), KEYS, features,
                              label, marker, marked)
        fitted |= {(n, i): models[j * k + i] for j, n in enumerate(boosters) for i in range(k)}
    for n in (n for n in learners if n in FORESTS):
        models = fit_forests(sample, [forest_settings(n, preset)] * k, [w.cast("double") for w in others], KEYS, features, label)
        fitted |= {(n, i): models[i] for i in range(k)}

    def one(job):
        name, i = job
        model = fitted.get(job)
        if model is None:
            rows = (sample if name in BOUNDED else tr).where(others[i])
            # regParam = 1 / (C * n_fit)
            model = _learner(name, preset, d, rows.count() if name == "lr" else 0, features, label).fit(rows)
        out = [F.lit(name).alias("learner"), F.lit(i).alias("fold"), prob1().alias("p")]
        model.transform(tr.where(own[i])).select(*KEYS, F.col(label), *out).write.parquet(f"{folder}/oof/{name}-{i}")
        model.transform(te).select(*KEYS, *out).write.parquet(f"{folder}/test/{name}-{i}")

    grid = [(name, i) for name in learners for i in range(k)]
    _each(one, grid, parallelism)
    oof_long, tst_long = (spark.read.parquet(*[f"{folder}/{part}/{name}-{i}" for name, i in grid])
                          for part in ("oof", "test"))
    tr.unpersist()
    te.unpersist()
    return oof_long, tst_long


def oof_stacking(train: DataFrame, test: DataFrame, learners: list[str], label: str = "label", **settings):
    """M1: returns (train_meta, test_meta, cv_scores); ``settings`` as in ``oof_scores``.

    train_meta: keys, label, one OOF P(class 1) column per learner.
    test_meta:  keys, the mean over the k fold models of P(class 1) per learner.
    cv_scores:  learner, fold, log_loss (M11).
    """
    return stack_tables(*oof_scores(train, test, learners, label=label, **settings), learners, label)


def stack_tables(oof_long: DataFrame, tst_long: DataFrame, learners: list[str], label: str = "label"):
    """The three tables of ``oof_stacking`` from long scores; conditional aggregates move the rows once, a pivot twice."""
    own = {n: F.when(F.col("learner") == n, F.col("p")) for n in learners}
    train_meta = oof_long.groupBy(*KEYS, label).agg(*[F.first(p, ignorenulls=True).alias(n) for n, p in own.items()])
    test_meta = tst_long.groupBy(*KEYS).agg(*[F.avg(p).alias(n) for n, p in own.items()])  # A11
    cv = ev.log_loss(oof_long.withColumnRenamed("p", "score"), label=label, by=["learner", "fold"])
    return train_meta, test_meta, cv


def append_columns(df: DataFrame, cols: list[str], features: str = "features", out: str = "features") -> DataFrame:
    """Append scalar columns to a feature vector (meta features next to the originals)."""
    tmp = VectorAssembler(inputCols=[features, *cols], outputCol="_fv", handleInvalid="keep").transform(df)
    return tmp.drop(features).withColumnRenamed("_fv", out) if out == features else tmp.withColumnRenamed("_fv", out)


class StackedBagging(Estimator):
    """Stacking layer (stratified K folds, MLP meta model) then bagged boosters.

    fit: for each of ``stacking_num`` stratified folds an MLP is fit on the
    other folds and scores its fold (OOF meta column); then ``bagging_num``
    boosters are fit on the features + meta column, each with a seeded
    train/validation split driving early stopping; ``bootstrap``: training rows
    weighted by how often a bootstrap draws them (K6).
    predict: meta = mean of the stacking models' P(class 1); output = mean of
    the boosters' P(class 1). Boosters read all rows.
    """

    def __init__(self, stacking_num: int = 2, bagging_num: int = 1, bagging_test_size: float = 0.33,
                 preset: str = "reference", features: str = "features", label: str = "label",
                 parallelism: int = 1, bootstrap: bool = False, patience: int = 0):
        super().__init__()
        self.patience, self.parallelism, self.bootstrap = patience, parallelism, bootstrap
        self.stacking_num, self.bagging_num, self.test_size = stacking_num, bagging_num, bagging_test_size
        self.preset, self.features, self.label = preset, features, label

    def _fit(self, train: DataFrame) -> StackedBaggingModel:
        ensure_checkpoint_dir(train.sparkSession)
        d = _n_features(train, self.features)
        x, stacking = train, []
        if self.stacking_num > 1:
            f = stratified_kfold(train, self.stacking_num, label=self.label, seed=1).persist(
                StorageLevel.MEMORY_AND_DISK)
            stacking = _each(
                lambda k: make_learner("mlp", self.preset, features=self.features, label=self.label, n_features=d)
                .fit(f.where(F.col("fold") != k)), range(self.stacking_num), self.parallelism)
            parts = [m.transform(f.where(F.col("fold") == k)).select(*train.columns, prob1().alias("meta"))
                     for k, m in enumerate(stacking)]
            x = _union(parts).checkpoint(eager=True)
            f.unpersist()
            x = append_columns(x, ["meta"], self.features)

        rows, weights, held = x, [], []
        for bn in range(self.bagging_num):
            rows = train_test_split(rows, self.test_size, seed=bn, name=f"_valid{bn}")
            held.append(F.col(f"_valid{bn}"))
            weights.append(F.when(~held[bn], bootstrap_count(bn).cast("double") if self.bootstrap else F.lit(1.0)))
        changes = {"patience": self.patience} if self.patience else {}
        settings = [booster_settings("gbt_es", self.preset, **changes)] * self.bagging_num
        bags = fit_boosters(rows, settings, weights, held, KEYS, self.features, self.label)
        return StackedBaggingModel(stacking, bags, self.features)


class StackedBaggingModel(Model, MLWritable, MLReadable):
    """The fitted layers; adds ``prob``. Written as the stacking models, and per booster a node table."""

    def __init__(self, stacking_models: list, bagging_models: list[BoostedModel], features: str = "features"):
        super().__init__()
        self.stacking_models, self.bagging_models, self.features = stacking_models, bagging_models, features

    def _transform(self, df: DataFrame) -> DataFrame:
        x, out = df, "prob"
        if self.stacking_models:
            p = F.lit(0.0)
            for i, m in enumerate(self.stacking_models):
                x = m.setPredictionCol(f"_sp{i}").setProbabilityCol(f"_spp{i}") \
                    .setRawPredictionCol(f"_spr{i}").transform(x)
                p = p + vector_to_array(F.col(f"_spp{i}"))[1]
                x = x.drop(f"_sp{i}", f"_spr{i}")
            x = x.withColumn("meta", p / len(self.stacking_models))
            x = x.drop(*[f"_spp{i}" for i in range(len(self.stacking_models))])
            x = append_columns(x, ["meta"], self.features)
        q = F.lit(0.0)
        for i, m in enumerate(self.bagging_models):
            x = m.setPredictionCol(f"_bp{i}").setProbabilityCol(f"_bpp{i}") \
                .setRawPredictionCol(f"_bpr{i}").transform(x)
            q = q + vector_to_array(F.col(f"_bpp{i}"))[1]
            x = x.drop(f"_bp{i}", f"_bpr{i}")
        x = x.withColumn(out, q / len(self.bagging_models))
        return x.drop(*[f"_bpp{i}" for i in range(len(self.bagging_models))])

    def write(self) -> MLWriter:
        return _StackedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StackedReader()


class _StackedWriter(MLWriter):
    def __init__(self, model: StackedBaggingModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        spark.createDataFrame([(len(m.stacking_models), len(m.bagging_models), m.features)],
                              "stacking int, bagging int, features string").write.parquet(f"{path}/layers")
        for i, s in enumerate(m.stacking_models):
            s.save(spark, f"{path}/stacking-{i}")
        for i, b in enumerate(m.bagging_models):
            b.save(spark, f"{path}/bagging-{i}")


class _StackedReader(MLReader):
    def load(self, path: str) -> StackedBaggingModel:
        spark = self.sparkSession
        r = spark.read.parquet(f"{path}/layers").first()
        return StackedBaggingModel(
            [PreparedModel.load(spark, f"{path}/stacking-{i}", MultilayerPerceptronClassificationModel) for i in range(r["stacking"])],
            [BoostedModel.load(spark, f"{path}/bagging-{i}") for i in range(r["bagging"])], r["features"])


__all__ = ["oof_scores", "oof_stacking", "stack_tables", "StackedBagging", "StackedBaggingModel", "append_columns"]
