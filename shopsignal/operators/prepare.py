"""Feature preparation fitted on training rows only: missing marker -> median, standard scaling.

Both steps are column expressions over the feature vector; their parameters come from one
aggregate row each over the rows that a model is fitted on, never over held-out rows (D11).
"""

from __future__ import annotations

import json

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Preparation:
    def __init__(self, features: str = "features", scale: bool = False, missing: float | None = None,
                 marked: tuple[int, ...] = ()):
        self.features, self.scale, self.missing, self.marked = features, scale, missing, tuple(marked)

    def fit(self, df: DataFrame) -> PreparationModel:
        arr = vector_to_array(F.col(self.features))
        fill: dict[int, float] = {}
        if self.missing is not None and self.marked:
            row = df.agg(*[F.percentile_approx(F.when(arr[i] != self.missing, arr[i]), 0.5, 10_000) for i in self.marked]).first()
            # a column that is missing everywhere keeps its marker
            fill = {i: float(v) for i, v in zip(self.marked, row) if v is not None}
        model = PreparationModel(self.features, self.missing, fill, None, None)
        if self.scale:
            first = df.select(F.size(arr).alias("d")).first()
            d = first["d"] if first else 0
            x = vector_to_array(F.col(self.features))
            row = model.transform(df).agg(*[F.avg(x[i]) for i in range(d)], *[F.stddev_pop(x[i]) for i in range(d)]).first()
            model.mean = [float(v or 0) for v in row[:d]]
            model.std = [float(v) if v else 1.0 for v in row[d:]]  # a constant column becomes 0
        return model


class PreparationModel:
    def __init__(self, features, missing, fill, mean, std):
        self.features, self.missing, self.fill, self.mean, self.std = features, missing, fill, mean, std

    def transform(self, df: DataFrame) -> DataFrame:
        arr = vector_to_array(F.col(self.features))
        if self.fill:
            medians = F.create_map(*[F.lit(v) for kv in self.fill.items() for v in kv])
            missing = self.missing
            arr = F.transform(arr, lambda x, i: F.when(x == missing, F.coalesce(medians[i], x)).otherwise(x))
        if self.mean is not None:
            mean, std = (F.array(*[F.lit(v) for v in p]) for p in (self.mean, self.std))
            arr = F.transform(arr, lambda x, i: (x - mean[i]) / std[i])
        return df.withColumn(self.features, array_to_vector(arr))


    def parameters(self) -> dict:
        return {"features": self.features, "missing": self.missing, "fill": {str(i): v for i, v in self.fill.items()},
                "mean": self.mean, "std": self.std}

    @classmethod
    def of(cls, p: dict) -> PreparationModel:
        return cls(p["features"], p["missing"], {int(i): v for i, v in p["fill"].items()}, p["mean"], p["std"])


class Prepared:
    """A learner behind a preparation; with ``valid`` only rows outside that column are fitted on."""

    def __init__(self, learner, preparation: Preparation, valid: str | None = None):
        self.learner, self.preparation, self.valid = learner, preparation, valid

    def fit(self, df: DataFrame) -> PreparedModel:
        rows = df.where(~F.col(self.valid)) if self.valid else df
        model = self.preparation.fit(rows)
        return PreparedModel(model, self.learner.fit(model.transform(df)))


class PreparedModel:
    def __init__(self, preparation: PreparationModel, model):
        self.preparation, self.model = preparation, model

    def __getattr__(self, name):
        if name == "model":  # not there yet
            raise AttributeError(name)
        return getattr(self.model, name)

    def save(self, spark, path: str) -> None:
        """The preparation as a one-row table, the model by its own writer."""
        spark.createDataFrame([(json.dumps(self.preparation.parameters()),)], "preparation string").write.parquet(f"{path}/preparation")
        self.model.write().save(f"{path}/model")

    @classmethod
    def load(cls, spark, path: str, kind) -> PreparedModel:
        p = json.loads(spark.read.parquet(f"{path}/preparation").first()[0])
        return cls(PreparationModel.of(p), kind.load(f"{path}/model"))

    def setPredictionCol(self, name):
        self.model.setPredictionCol(name)
        return self

    def setProbabilityCol(self, name):
        self.model.setProbabilityCol(name)
        return self

    def setRawPredictionCol(self, name):
        self.model.setRawPredictionCol(name)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """The model's columns; the caller's features stay as they were."""
        f = self.preparation.features
        out = self.model.transform(self.preparation.transform(df.withColumn("_given", F.col(f))))
        return out.withColumn(f, F.col("_given")).drop("_given")
