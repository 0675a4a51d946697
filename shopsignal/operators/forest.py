"""Deep forests (M2 random forest, M5 extremely randomised trees): many trees of many models in one job.

Forests are fitted on all rows. Rows with equal features are one row with its numbers of rows and of
positives, so a tree works on the distinct rows; of the others a task holds four bytes each, which
bootstraps draw from. Each task gets the rows through a shuffle (none pass through the driver) and grows
its share of the (model, tree) units. A tree grows level by level, all its open nodes in common vector
operations. Trees are written to the shared folder, one row per tree with its nodes as arrays; a lost
task grows its trees again from their seeds. Scores are sums over groups of trees of bounded size, so a
task holds one group.

* Random forest: bootstrap rows, the best Gini split over the bins of sqrt(d) random features.
* Extra trees: all rows, for each of sqrt(d) random features one uniform threshold between its
  least and greatest value in the node, the best of these.

A node none of whose drawn features can be split tries all features once.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignal.operators.trees import BLOCK_ROWS, MAX_BINS, Binning, distinct_rows, of_distinct
from shopsignal.session import ensure_checkpoint_dir, ship_sources

#: Nodes (14 bytes each) that a scoring task holds at a time.
GROUP_NODES = 8_000_000

_TREES = "model int, tree int, nodes int, feature binary, value binary, left binary"
_TYPES = {"feature": np.int16, "value": np.float64, "left": np.int32}


@dataclass(frozen=True)
class Forest:
    trees: int = 100
    depth: int = 20
    bootstrap: bool = True
    random_thresholds: bool = False
    seed: int = 0


def grow(x: np.ndarray, bins: np.ndarray, borders: tuple[np.ndarray, ...], y: np.ndarray, rows: np.ndarray, c: Forest,
         rng: np.random.Generator, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree: feature (-1: leaf), value (threshold, or share of positives), left child (right: the next).

    ``rows``: places in ``x``; each stands for ``times`` rows (one), ``y`` of them positive.
    """
    d = x.shape[1]
    k = max(1, int(d ** 0.5))
    times = np.ones(len(x)) if times is None else times
    cuts = np.full((d + 1, 1 + max((len(b) for b in borders), default=0)), np.inf)  # a last row for no feature
    for i, own in enumerate(borders):
        cuts[i, :len(own)] = own
    feature, value, left = [np.array([-1], np.int16)], [np.array([y[rows].sum() / times[rows].sum() if len(rows) else 0.5])], [np.zeros(1, np.int32)]
    nodes, sizes, made = np.zeros(1, np.int64), np.array([len(rows)]), 1
    for _ in range(c.depth):
        starts = np.cumsum(sizes) - sizes
        pos = np.add.reduceat(y[rows], starts)
        open_ = (pos > 0) & (pos < np.add.reduceat(times[rows], starts))
        if not open_.any():
            break
        rows = rows[np.repeat(open_, sizes)]
        nodes, sizes = nodes[open_], sizes[open_]
        m = len(nodes)
        drawn = np.argpartition(rng.random((m, d)), k - 1, axis=1)[:, :k] if k < d else np.tile(np.arange(d), (m, 1))
        f, t = _choose(x, bins, cuts, y, times, rows, sizes, drawn, c, rng)
        none = f < 0
        if none.any() and k < d:
            again = rows[np.repeat(none, sizes)]
            every = np.tile(np.arange(d), (int(none.sum()), 1))
            f[none], t[none] = _choose(x, bins, cuts, y, times, again, sizes[none], every, c, rng)
        split = f >= 0
        if not split.any():
            break
        rows = rows[np.repeat(split, sizes)]
        nodes, sizes, f, t = nodes[split], sizes[split], f[split], t[split]
        m = len(nodes)
        of = np.repeat(np.arange(m), sizes)
        right = x[rows, f[of]] > t[of]
        side = 2 * of + right
        rows = rows[np.argsort(side, kind="stable")]
        sizes = np.bincount(side, minlength=2 * m)
        flat = np.concatenate(feature), np.concatenate(value), np.concatenate(left)
        flat[0][nodes], flat[1][nodes], flat[2][nodes] = f, t, made + 2 * np.arange(m)
        starts = np.cumsum(sizes) - sizes
        feature, value = [flat[0], np.full(2 * m, -1, np.int16)], [flat[1], np.add.reduceat(y[rows], starts) / np.add.reduceat(times[rows], starts)]
        left = [flat[2], np.zeros(2 * m, np.int32)]
        nodes, made = made + np.arange(2 * m), made + 2 * m
    return np.concatenate(feature), np.concatenate(value), np.concatenate(left)


def _choose(x, bins, cuts, y, times, rows, sizes, drawn, c: Forest, rng) -> tuple[np.ndarray, np.ndarray]:
    """Per node the best feature among its drawn ones and its threshold; -1 where none can be split."""
    m, k = drawn.shape
    of = np.repeat(np.arange(m), sizes)
    starts = np.cumsum(sizes) - sizes
    many, ones = times[rows], y[rows]
    n, p = (np.add.reduceat(v, starts)[:, None] for v in (many, ones))
    if c.random_thresholds:
        v = x[rows[:, None], drawn[of]]
        low, high = np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)
        at = low + rng.random((m, k)) * (high - low)
        go = v <= at[of]
        nl, pl = np.add.reduceat(go * many[:, None], starts), np.add.reduceat(go * ones[:, None], starts)
        score = np.where((nl > 0) & (nl < n), _purity(nl, pl) + _purity(n - nl, p - pl), -np.inf)
        best = np.argmax(score, axis=1)
        i = np.arange(m)
        return np.where(score[i, best] > -np.inf, drawn[i, best], -1), at[i, best]
    width = cuts.shape[1]
    cell = ((of[:, None] * k + np.arange(k)) * width + bins[rows[:, None], drawn[of]]).ravel()
    many, ones = np.repeat(many, k), np.repeat(ones, k)
    # cells (node, drawn feature, bin) that hold rows, in order, with running numbers of rows and positives
    if m * k * width <= 2 * len(cell):
        held = np.bincount(cell, many, m * k * width)
        filled = np.flatnonzero(held)
        count, ones = np.cumsum(held[filled]), np.cumsum(np.bincount(cell, ones, m * k * width)[filled])
    else:
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        last = np.flatnonzero(np.append(cell[1:] != cell[:-1], True))
        filled, count, ones = cell[last], np.cumsum(many[order])[last], np.cumsum(ones[order])[last]
    part, value = filled // width, filled % width
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    runs = np.diff(np.append(first, len(part)))
    before = np.append(0, count)[first], np.append(0, ones)[first]
    nl, pl = count - np.repeat(before[0], runs), ones - np.repeat(before[1], runs)
    whole = np.repeat(n.repeat(k, 1).ravel(), runs), np.repeat(p.repeat(k, 1).ravel(), runs)
    score = np.where(nl < whole[0], _purity(nl, pl) + _purity(whole[0] - nl, whole[1] - pl), -np.inf)
    top = np.maximum.reduceat(score, first).reshape(m, k)
    best = np.argmax(top, axis=1)
    i = np.arange(m)
    f = np.where(top[i, best] > -np.inf, drawn[i, best], -1)
    # the first run of the chosen (node, feature) that reaches its best score
    hit = np.flatnonzero(score == np.repeat(top.ravel(), runs))
    where = np.full(m * k, len(part))
    np.minimum.at(where, part[hit], hit)
    cut = value[np.minimum(where[i * k + best], len(value) - 1)]
    return f, cuts[f, cut]


def _purity(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """n times (1 - Gini impurity) of a side with p positives."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (p * p + (n - p) * (n - p)) / n, 0.0)


class ForestModel:
    """A model of ``fit_forests``: its trees are rows of a table in the shared folder."""

    def __init__(self, spark: SparkSession, path: str, model: int, trees: int, features: str = "features",
                 group_nodes: int = GROUP_NODES):
        self.spark, self.path, self.model, self.trees, self.features, self.group_nodes = spark, path, model, trees, features, group_nodes
        self.columns = {"probability": "probability", "prediction": "prediction", "raw": "rawPrediction"}

    setProbabilityCol = lambda self, name: self._named("probability", name)
    setPredictionCol = lambda self, name: self._named("prediction", name)
    setRawPredictionCol = lambda self, name: self._named("raw", name)

    def _named(self, kind: str, name: str):
        self.columns[kind] = name
        return self

    def nodes(self) -> DataFrame:
        """One row per tree."""
        return self.spark.read.schema(_TREES).parquet(self.path).where(F.col("model") == self.model)

    def _groups(self) -> list[tuple[int, int]]:
        """Ranges of trees with at most ``group_nodes`` nodes (a tree of more is a group of its own)."""
        out, held = [], 0
        for r in self.nodes().select("tree", F.col("nodes").alias("n")).orderBy("tree").collect():  # a number per tree
            if not out or held + r["n"] > self.group_nodes:
                out.append((r["tree"], r["tree"]))
                held = 0
            out[-1] = (out[-1][0], r["tree"])
            held += r["n"]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds raw prediction, probability (vectors; the mean share of positives) and prediction."""
        ship_sources(self.spark)
        out = df.withColumn("_sum", F.lit(0.0))
        groups = self._groups()
        for i, (a, b) in enumerate(groups):
            got = self.nodes().where(F.col("tree").between(a, b)).orderBy("tree").toArrow()
            held = self.spark.sparkContext.broadcast(
                [tuple(np.frombuffer(got.column(c)[j].as_buffer(), t) for c, t in _TYPES.items()) for j in range(got.num_rows)])
            out = out.withColumn("_sum", F.col("_sum") + _group_score(held)(vector_to_array(F.col(self.features))))
            if i + 1 < len(groups):  # the next group is held by tasks of another job
                path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/forest-sums-{uuid.uuid4().hex}"
                out.write.parquet(path)
                out = self.spark.read.schema(out.schema).parquet(path)
        p = F.col("_sum") / max(1, self.trees) if self.trees else F.lit(0.5)
        c = self.columns
        return (out.withColumn(c["raw"], array_to_vector(F.array(self.trees - F.col("_sum"), F.col("_sum"))))
                .withColumn(c["probability"], array_to_vector(F.array(1 - p, p)))
                .withColumn(c["prediction"], (p > 0.5).cast("double")).drop("_sum"))


def leaf_value(tree: tuple, x: np.ndarray) -> np.ndarray:
    feature, value, left = tree
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        now = node[rows]
        f = feature[now]
        inner = f >= 0
        rows, now, f = rows[inner], now[inner], f[inner]
        node[rows] = left[now] + (x[rows, f] > value[now])
    return value[node]


def _group_score(held):
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        n = len(x)
        if not n:
            return pa.array([], pa.float64())
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        return pa.array(of_distinct(values, lambda v: sum((leaf_value(t, v) for t in held.value), np.zeros(len(v)))))
    return score


@dataclass
class Rows:
    """Rows of a forest: distinct features, and by row twice their place plus the label, the keys' hash and the models that train on it."""

    x: np.ndarray
    code: np.ndarray
    key: np.ndarray
    on: np.ndarray

    @classmethod
    def joined(cls, parts: list[Rows]) -> Rows:
        """All rows by their keys' hashes: what is drawn does not depend on partitions."""
        x, place = distinct_rows(np.concatenate([r.x for r in parts]))
        start = np.cumsum([len(r.x) for r in parts]) - [len(r.x) for r in parts]
        code = np.concatenate([2 * place[s + (r.code >> 1)] + (r.code & 1) for r, s in zip(parts, start)]).astype(np.int32)
        key, on = (np.concatenate([getattr(r, c) for r in parts]) for c in ("key", "on"))
        order = np.lexsort((code, key))
        return cls(x, code[order], key[:0], on[order])


def fit_forests(df: DataFrame, settings: list[Forest], weights: list[Column], keys: list[str], features: str = "features",
                label: str = "label", sample: int | None = None, max_bins: int = MAX_BINS) -> list[ForestModel]:
    """Fit one forest per entry of ``settings``; ``weights[m]`` > 0 marks the rows that model m trains on.

    All rows are read; with ``sample`` more than so many are an error. Labels are 0 or 1. The result depends on keys and
    seeds only, not on partitioning. No rows: a model that scores 0.5.
    """
    spark = df.sparkSession
    ship_sources(spark)
    binning = Binning.fit(df, features, max_bins)
    width, models = len(binning.borders), len(settings)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, rows = [], 0

        def block():
            x, y, key, on = (np.concatenate(v) for v in zip(*got))
            if not np.isin(y, (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            x, place = distinct_rows(x)
            made = Rows(x, (2 * place + y.astype(np.int64)).astype(np.int32), key, on)
            return pa.record_batch([pa.array([len(y)], pa.int64()), pa.array([pickle.dumps(made, 5)], pa.binary())], ["n", "block"])

        for b in batches:
            n = b.num_rows
            if n:
                x, on = (b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in (1, 3))
                got.append((x, b.column(2).to_numpy(), b.column(0).to_numpy(), on))
                rows += n
            if rows >= BLOCK_ROWS:
                yield block()
                got, rows = [], 0
        if got:
            yield block()

    rows = df.select(F.xxhash64(*[F.col(k) for k in keys]).alias("k"), vector_to_array(F.col(features)).alias("x"),
                     F.col(label).cast("double").alias("y"), F.array(*[F.coalesce(w.cast("double"), F.lit(0.0)) > 0 for w in weights]).alias("on"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    rows.mapInArrow(pack, "n long, block binary").write.parquet(f"{folder}/rows")
    blocks, path = spark.read.schema("n long, block binary").parquet(f"{folder}/rows"), f"{folder}/trees"
    n = blocks.agg(F.sum("n")).first()[0] or 0
    if sample is not None and n > sample:
        raise ValueError(f"a forest is fitted on at most {sample} rows")
    if not n or not width:
        spark.createDataFrame([], _TREES).write.parquet(path)
        return [ForestModel(spark, path, m, 0, features) for m in range(models)]
    used = blocks.select("block").rdd.map(lambda r: pickle.loads(r["block"]).on.any(0)).collect()  # a flag a model and block
    used = np.any(used, axis=0)
    units = [(m, t) for t in range(max(c.trees for c in settings)) for m, c in enumerate(settings) if t < c.trees and used[m]]
    tasks = max(1, min(len(units), spark.sparkContext.defaultParallelism))

    def run(part) -> Iterator[tuple]:
        part = list(part)
        if not part:
            return
        task, r = part[0][0], Rows.joined([pickle.loads(block) for _, block in part])
        part.clear()
        bins, own = binning.apply(r.x), {}
        for m, t in units[task::tasks]:
            c = settings[m]
            rng = np.random.default_rng([c.seed, m, t])
            if m not in own:
                own.clear()
                own[m] = r.code[r.on[:, m]]
            code = own[m][rng.integers(0, len(own[m]), len(own[m]))] if c.bootstrap else own[m]
            counts = np.bincount(code, minlength=2 * len(r.x)).reshape(-1, 2).astype(np.float64)
            times, y = counts.sum(1), counts[:, 1].copy()
            arrays = grow(r.x, bins, binning.borders, y, np.flatnonzero(times), c, rng, times)
            yield (m, t, len(arrays[0]), *(bytearray(v.astype(k).tobytes()) for v, k in zip(arrays, _TYPES.values())))

    units.sort()  # a task's trees of one model follow each other
    dealt = blocks.select("block").rdd.flatMap(lambda r: [(i, bytes(r["block"])) for i in range(tasks)]).partitionBy(tasks, int)
    spark.createDataFrame(dealt.mapPartitions(run), _TREES, verifySchema=False).write.parquet(path)
    return [ForestModel(spark, path, m, c.trees if used[m] else 0, features) for m, c in enumerate(settings)]


class ForestLearner:
    """One forest as a learner, fitted on all rows."""

    def __init__(self, settings: Forest, features: str = "features", label: str = "label", keys=("user_id", "merchant_id")):
        self.settings, self.features, self.label, self.keys = settings, features, label, list(keys)

    def fit(self, df: DataFrame) -> ForestModel:
        return fit_forests(df, [self.settings], [F.lit(1.0)], self.keys, self.features, self.label)[0]
