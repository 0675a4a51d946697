"""Multi-layer perceptrons fitted by L-BFGS over Spark: a regressor with squared loss and L2 (M13), and a classifier.

Loss and gradient of all rows are sums over row blocks: a job per evaluation adds the blocks'
partial sums (in a tree of tasks beyond a few partitions). Weights and the L-BFGS memory, whose
size the layers set, stay on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.operators.trees import total
from shopsignal.session import ship_sources


def shapes(sizes: list[int]) -> list[tuple[int, int]]:
    """Weight matrices of the layers; the last row of each holds the biases."""
    return [(a + 1, b) for a, b in zip(sizes, sizes[1:])]


def split(flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    out, at = [], 0
    for a, b in shapes(sizes):
        out.append(flat[at:at + a * b].reshape(a, b))
        at += a * b
    return out


def forward(x: np.ndarray, weights: list[np.ndarray]) -> list[np.ndarray]:
    """Inputs of every layer, then the output (rectified units inside, a straight line at the end)."""
    out = [x]
    for i, w in enumerate(weights):
        z = out[-1] @ w[:-1] + w[-1]
        out.append(np.maximum(z, 0) if i + 1 < len(weights) else z)
    return out


def loss_and_gradient(x: np.ndarray, y: np.ndarray, flat: np.ndarray, sizes: list[int]) -> tuple[float, np.ndarray]:
    """Sums over the rows of half the squared error and of its gradient."""
    weights = split(flat, sizes)
    layers = forward(x, weights)
    delta = layers[-1] - y[:, None]
    loss, grads = 0.5 * float((delta * delta).sum()), []
    for w, given in zip(reversed(weights), reversed(layers[:-1])):
        grads.append(np.vstack([given.T @ delta, delta.sum(0)]).ravel())
        delta = (delta @ w[:-1].T) * (given > 0)
    return loss, np.concatenate(grads[::-1])


def class_loss_and_gradient(x: np.ndarray, y: np.ndarray, times: np.ndarray, flat: np.ndarray, sizes: list[int]) -> tuple[float, np.ndarray]:
    """Sums over the rows, each counted ``times``, of the cross-entropy and of its gradient (sigmoid units inside, softmax at the end)."""
    weights, layers = split(flat, sizes), [x]
    for w in weights[:-1]:
        layers.append(expit(layers[-1] @ w[:-1] + w[-1]))
    z = layers[-1] @ weights[-1][:-1] + weights[-1][-1]
    z -= z.max(1, keepdims=True)
    e = np.exp(z)
    whole, rows = e.sum(1), np.arange(len(y))
    loss = float((times * (np.log(whole) - z[rows, y])).sum())
    delta = e / whole[:, None]
    delta[rows, y] -= 1
    delta *= times[:, None]
    grads = []
    for i in range(len(weights) - 1, -1, -1):
        grads.append(np.vstack([layers[i].T @ delta, delta.sum(0)]).ravel())
        if i:
            delta = (delta @ weights[i][:-1].T) * layers[i] * (1 - layers[i])
    return loss, np.concatenate(grads[::-1])


def expit(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def minimise(evaluate, start: np.ndarray, max_iter: int = 200, tol: float = 1e-4, memory: int = 10,
             flat: float | None = None) -> tuple[np.ndarray, int]:
    """L-BFGS with a backtracking line search; (where it ends, iterations).

    Ends when the largest component of the gradient is below ``tol``, no step lowers the value, or
    20 steps together lower it by at most ``flat`` times the first value.
    """
    at, (value, grad), kept = start, evaluate(start), []
    seen = [value]
    for step in range(max_iter):
        if np.abs(grad).max(initial=0) < tol:
            return at, step
        if flat is not None and step >= 20 and seen[-20] - value <= flat * seen[0]:
            return at, step
        d, alphas = grad.copy(), []
        for s, y, r in reversed(kept):
            a = r * (s @ d)
            alphas.append(a)
            d -= a * y
        if kept:
            s, y, _ = kept[-1]
            d *= (s @ y) / (y @ y)
        else:
            d /= max(1.0, np.linalg.norm(grad))
        for (s, y, r), a in zip(kept, reversed(alphas)):
            d += s * (a - r * (y @ d))
        slope, length = -(grad @ d), 1.0
        if slope >= 0:
            d, slope, kept = grad.copy(), -(grad @ grad), []
        for _ in range(30):
            new = at - length * d
            got, slope_at = evaluate(new)
            if got <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            return at, step
        s, y = new - at, slope_at - grad
        if s @ y > 1e-12:
            kept = [*kept[-memory + 1:], (s, y, 1 / (s @ y))]
        at, value, grad = new, got, slope_at
        seen.append(value)
    return at, max_iter


class MLPRegressor:
    """Hidden layers of rectified units; loss: mean of half the squared errors plus alpha / (2 n) times the squared weights."""

    def __init__(self, hidden=(5, 5), alpha: float = 1e-5, max_iter: int = 200, tol: float = 1e-4, seed: int = 1,
                 features: str = "features", label: str = "label"):
        self.hidden, self.alpha, self.max_iter, self.tol, self.seed, self.features, self.label = (
            tuple(hidden), alpha, max_iter, tol, seed, features, label)

    def fit(self, df: DataFrame) -> MLPModel:
        """Rows with a null label or features are not learnt from; without rows the model predicts 0."""
        ship_sources(df.sparkSession)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    yield pa.record_batch([pa.array([b.column(i).flatten().to_numpy().tobytes() if i == 0 else b.column(1).to_numpy().tobytes()],
                                                    pa.binary()) for i in (0, 1)], ["x", "y"])

        def unpack(r) -> tuple[np.ndarray, np.ndarray]:
            y = np.frombuffer(r["y"])
            return np.frombuffer(r["x"]).reshape(len(y), -1), y

        rows = df.select(vector_to_array(F.col(self.features)).alias("x"), F.col(self.label).cast("double").alias("y")).dropna()
        blocks = rows.mapInArrow(pack, "x binary, y binary").rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
        counts = total(blocks, lambda part: _size(part))
        n, d = (int(counts[0][0]), int(counts[0][1] / max(1, counts[0][2]))) if counts else (0, 0)
        sizes = [d, *self.hidden, 1]
        rng = np.random.default_rng(self.seed)
        start = []
        for a, b in shapes(sizes):
            bound = (6 / (a - 1 + b)) ** 0.5
            start.append(rng.uniform(-bound, bound, a * b))
        decay = np.concatenate([np.vstack([np.ones((a - 1, b)), np.zeros((1, b))]).ravel() for a, b in shapes(sizes)])
        if not n:
            return MLPModel([np.zeros(s) for s in shapes([0, 1])], 0, self.features)

        def evaluate(flat: np.ndarray) -> tuple[float, np.ndarray]:
            loss, grad = total(blocks, lambda part: _sums(part, flat, sizes))
            own = decay * flat
            return (loss[0] + 0.5 * self.alpha * own @ flat) / n, (grad + self.alpha * own) / n

        flat, steps = minimise(evaluate, np.concatenate(start), self.max_iter, self.tol)
        blocks.unpersist()
        return MLPModel(split(flat, sizes), steps, self.features)


def _size(part) -> list[np.ndarray]:
    out = np.zeros(3)
    for x, _ in part:
        out += (len(x), x.shape[1], 1)
    return [out]


def _sums(part, flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    loss, grad = np.zeros(1), np.zeros(len(flat))
    for x, y in part:
        a, b = loss_and_gradient(x, y, flat, sizes)
        loss, grad = loss + a, grad + b
    return [loss, grad]


class MLPModel:
    def __init__(self, weights: list[np.ndarray], iterations: int, features: str):
        self.weights, self.iterations, self.features = weights, iterations, features

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        ship_sources(df.sparkSession)
        weights = self.weights

        @F.arrow_udf("double")
        def predict(x: pa.Array) -> pa.Array:
            n = len(x)
            given = x.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)[:, :len(weights[0]) - 1] if n else np.zeros((0, len(weights[0]) - 1))
            return pa.array(forward(given, weights)[-1].ravel(), pa.float64())

        return df.withColumn(out, predict(vector_to_array(F.col(self.features))))


class Perceptron(MultilayerPerceptronClassifier):
    """Spark's perceptron classifier (its layers, first weights, loss and model), fitted over blocks of rows.

    Spark passes over every row for each of the steps, in plain loops of the JVM. Here equal rows of a
    batch are one row with a count (pairs of a user share their features), and a pass is a few matrix
    products a block. Spark's tolerance holds: the steps end when 20 of them lower the loss by at most
    ``tol`` times the first loss.
    """

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        ship_sources(dataset.sparkSession)
        sizes = self.getLayers()
        start = self._spark_model(dataset.sparkSession).weights.toArray()
        blocks = class_blocks(dataset, sizes, self.getFeaturesCol(), self.getLabelCol()).persist(StorageLevel.MEMORY_AND_DISK)
        n = sum(blocks.map(lambda b: int(b[2].sum())).collect())  # a number a block

        def evaluate(flat: np.ndarray) -> tuple[float, np.ndarray]:
            loss, grad = total(blocks, lambda part: _class_sums(part, flat, sizes))
            return loss[0] / n, grad / n

        if n:
            start, _ = minimise(evaluate, start, self.getMaxIter(), 1e-8, flat=self.getTol())
        blocks.unpersist()
        return self._spark_model(dataset.sparkSession, start)

    def _spark_model(self, spark, weights: np.ndarray | None = None) -> MultilayerPerceptronClassificationModel:
        """Spark's model with these weights, or with those that its fit starts from."""
        own = {self.maxIter: 0} | ({} if weights is None else {self.initialWeights: Vectors.dense(weights)})
        row = spark.createDataFrame([(Vectors.dense([0.0] * self.getLayers()[0]), 0.0)], [self.getFeaturesCol(), self.getLabelCol()])
        return MultilayerPerceptronClassifier._fit(self.copy(own), row)


def class_blocks(df: DataFrame, sizes: list[int], features: str, label: str) -> RDD:
    """(features, class, count) of the distinct rows of each batch; null or unknown classes and features that are no numbers are errors."""
    width, classes = sizes[0], sizes[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            y = b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            x = b.column(0).flatten().to_numpy(zero_copy_only=False)
            if not np.isin(y, np.arange(classes)).all():
                raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
            if b.column(0).null_count or len(x) != n * width or np.isnan(x).any():
                raise ValueError(f"features must be {width} numbers")
            rows = np.ascontiguousarray(np.column_stack([x.reshape(n, width), y]))
            _, first, times = np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * (width + 1)))).ravel(), return_index=True, return_counts=True)
            rows = rows[first]
            yield pa.record_batch([pa.array([v.tobytes()], pa.binary()) for v in (np.ascontiguousarray(rows[:, :-1]), rows[:, -1].astype(np.int64), times.astype(np.float64))],
                                  ["x", "y", "times"])

    def unpack(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(r["x"]).reshape(-1, width), np.frombuffer(r["y"], np.int64), np.frombuffer(r["times"])

    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))
    return rows.mapInArrow(run, "x binary, y binary, times binary").rdd.map(unpack)


def _class_sums(part, flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    loss, grad = np.zeros(1), np.zeros(len(flat))
    for x, y, times in part:
        a, b = class_loss_and_gradient(x, y, times, flat, sizes)
        loss, grad = loss + a, grad + b
    return [loss, grad]
