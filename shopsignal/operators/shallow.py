"""Forests of shallow trees fitted on all rows, one per fold side by side.

Each row is packed once: its binned features, class, fold, and how often each tree's bootstrap
draws it (the Poisson law at a number made of the row's keys, as in K6). Rows of a batch that are
equal in bins, class and fold are one row with summed draws, so nothing is lost. A level of all
trees of all folds is then one pass that adds histograms; their sizes depend on folds, trees and
features only. One more pass counts the held-out rows that are predicted right. The bins' borders are
quantiles of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.operators.folds import KEYS, POISSON_CDF
from shopsignal.operators.trees import Binning, total, uniform
from shopsignal.session import ship_sources

#: Bins of a feature, as Spark's tree learners have by default.
BINS = 32


@dataclass
class Rows:
    bins: np.ndarray  # rows x features
    y: np.ndarray
    fold: np.ndarray
    times: np.ndarray  # rows of the table
    draws: np.ndarray  # rows x trees


@dataclass
class Trees:
    """Nodes of (model, tree) in heap order; the children of node i are 2 i + 1 and 2 i + 2. ``feature`` is -1 at leaves."""

    feature: np.ndarray  # models x trees x nodes
    cut: np.ndarray  # the last bin that goes left
    counts: np.ndarray  # models x trees x nodes x classes

    def node_of(self, model: int, tree: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """The nodes that rows reach within ``levels`` steps."""
        feature, cut = self.feature[model, tree], self.cut[model, tree]
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            f = feature[node]
            node = np.where(f >= 0, 2 * node + 1 + (bins[rows, f] > cut[node]), node)
        return node


def borders(df: DataFrame, features: str) -> Binning:
    """Borders at quantiles of all rows; a feature with few values has one between any two of them, however rare, as in Spark's forests."""
    binning = Binning.fit(df, features, BINS, exact=False)
    x, d = vector_to_array(F.col(features)), len(binning.borders)
    about = df.agg(*[F.approx_count_distinct(x[i]).alias(f"n{i}") for i in range(d)]).first() if d else []
    some = [i for i in range(d) if about[i] <= 2 * BINS]  # the sets of others are not bounded
    sets = dict(zip(some, df.agg(*[F.sort_array(F.collect_set(x[i])).alias(f"v{i}") for i in some]).first())) if some else {}
    few = {i: np.array(v, np.float64) for i, v in sets.items() if len(v) <= BINS}
    return Binning(tuple((few[i][1:] + few[i][:-1]) / 2 if i in few else b for i, b in enumerate(binning.borders)))


def pack(df: DataFrame, binning: Binning, trees: int, seed: int, fold: str, features: str, label: str, keys=KEYS) -> RDD:
    width = len(binning.borders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = b.column(0).flatten().to_numpy(zero_copy_only=False)
            y, own, key = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            if b.column(0).null_count or len(x) != n * width or np.isnan(x).any():
                raise ValueError(f"features must be {width} numbers")
            if not np.isin(y, np.arange(256)).all():
                raise ValueError("labels must be whole numbers from 0 to 255")
            rows = np.column_stack([binning.apply(x.reshape(n, width)), y.astype(np.uint8), own.astype(np.uint8)])
            _, first, back, times = np.unique(np.ascontiguousarray(rows).view(np.dtype((np.void, width + 2))).ravel(),
                                              return_index=True, return_inverse=True, return_counts=True)
            order, starts = np.argsort(back, kind="stable"), np.cumsum(times) - times
            draws = np.empty((len(first), trees), np.int64)
            for t in range(trees):
                drawn = np.searchsorted(POISSON_CDF, uniform(key, seed, t), side="right")
                draws[:, t] = np.add.reduceat(drawn[order], starts)
            draws = draws.astype(np.min_scalar_type(int(draws.max(initial=0))))
            yield pa.record_batch([*(pa.array([v.tobytes()], pa.binary()) for v in (rows[first], times, draws)), pa.array([draws.dtype.str])],
                                  ["rows", "times", "draws", "type"])

    def unpack(r) -> Rows:
        rows = np.frombuffer(r["rows"], np.uint8).reshape(-1, width + 2)
        return Rows(rows[:, :-2], rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64), np.frombuffer(r["times"], np.int64),
                    np.frombuffer(r["draws"], r["type"]).reshape(-1, trees))

    rows = df.where(F.col(fold).isNotNull()).select(
        vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"),
        F.xxhash64(*[F.col(k) for k in keys]).alias("key"))
    return rows.mapInArrow(run, "rows binary, times binary, draws binary, type string").rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)


def _histograms(part, model: Trees, level: int, columns: np.ndarray, n_bins: int, classes: int) -> list[np.ndarray]:
    """Drawn rows by (model, tree, node of the level, drawn feature, bin, class); a model does not see its own fold.

    Models whose tree is the same so far (all at the root, most below it) share one count by fold.
    """
    k, trees, _ = model.feature.shape
    nodes, m = columns.shape[1:]
    size = nodes * m * n_bins * classes
    same = [{} for _ in range(trees)]
    for t, i in np.ndindex(trees, k):
        same[t].setdefault(model.feature[i, t].tobytes() + model.cut[i, t].tobytes(), []).append(i)
    out = np.zeros((k, trees, size))
    for r in part:
        for t in range(trees):
            drawn = np.flatnonzero(r.draws[:, t])
            for models in same[t].values():
                node = model.node_of(models[0], t, r.bins[drawn], level) - (nodes - 1)  # below 0: it ended in a leaf above
                rows, node = drawn[node >= 0], node[node >= 0]
                cell = ((r.fold[rows, None] * nodes + node[:, None]) * m + np.arange(m)) * n_bins + r.bins[rows[:, None], columns[t, node]]
                cell = cell * classes + r.y[rows, None]
                own = np.bincount(cell.ravel(), np.repeat(r.draws[rows, t].astype(np.float64), m), k * size).reshape(k, size)
                out[models, t] += own.sum(0) - own[models]
    return [out.reshape(k, trees, nodes, m, n_bins, classes)]


def _gini(c: np.ndarray) -> np.ndarray:
    """Rows times impurity."""
    n = c.sum(-1)
    return n - np.divide((c * c).sum(-1), n, out=np.zeros_like(n), where=n > 0)


def _split(model: Trees, hist: np.ndarray, level: int, columns: np.ndarray) -> None:
    """Gives the level's nodes their best split of falling impurity; ties go to the lower feature, then bin."""
    left = np.cumsum(hist, axis=4)
    whole = left[:, :, :, :, -1:]
    right = whole - left
    gain = _gini(whole) - _gini(left) - _gini(right)
    gain[(left.sum(-1) < 1) | (right.sum(-1) < 1)] = -np.inf
    k, trees, nodes, m, n_bins, _ = hist.shape
    best = gain.reshape(k, trees, nodes, m * n_bins).argmax(-1)
    at, cut = np.divmod(best, n_bins)
    for i, t, node in np.ndindex(k, trees, nodes):
        a, b, place = at[i, t, node], cut[i, t, node], nodes - 1 + node
        model.counts[i, t, place] = whole[i, t, node, 0, 0]
        if gain[i, t, node, a, b] > 1e-9:
            model.feature[i, t, place], model.cut[i, t, place] = columns[t, node, a], b
            model.counts[i, t, 2 * place + 1], model.counts[i, t, 2 * place + 2] = left[i, t, node, a, b], right[i, t, node, a, b]


def _merge(model: Trees) -> None:
    """Two leaves of one parent with the same prediction become that parent, as in Spark's forests."""
    said = model.counts.argmax(-1)
    for place in reversed(range((model.feature.shape[2] - 1) // 2)):
        a, b = 2 * place + 1, 2 * place + 2
        same = (model.feature[:, :, a] < 0) & (model.feature[:, :, b] < 0) & (said[:, :, a] == said[:, :, b])
        model.feature[:, :, place][same] = -1


def _right(part, model: Trees, depth: int) -> list[np.ndarray]:
    """Per model the rows of its fold, and those whose class has the largest sum of the trees' shares."""
    k, trees, _ = model.feature.shape
    whole = model.counts.sum(-1, keepdims=True)
    share = np.divide(model.counts, whole, out=np.zeros_like(model.counts), where=whole > 0)
    out = np.zeros((k, 2), np.int64)
    for r in part:
        for i in range(k):
            own = np.flatnonzero(r.fold == i)
            bins, votes = r.bins[own], np.zeros((len(own), share.shape[-1]))
            for t in range(trees):
                votes += share[i, t, 0 if model.feature[i, t, 0] < 0 else model.node_of(i, t, bins, depth)]
            hit = votes.argmax(1) == r.y[own]
            out[i] += r.times[own].sum(), r.times[own][hit].sum()
    return [out]


def fit_folds(blocks: RDD, k: int, trees: int, depth: int, seed: int, d: int, n_bins: int, classes: int) -> Trees:
    """One forest per fold on the rows of the other folds; each node tries the root of ``d`` random features."""
    nodes, m = 2 ** (depth + 1) - 1, min(d, int(np.ceil(d ** 0.5)))
    model = Trees(np.full((k, trees, nodes), -1), np.zeros((k, trees, nodes), np.int64), np.zeros((k, trees, nodes, classes)))
    for level in range(depth):
        places = range(2 ** level - 1, 2 ** (level + 1) - 1)
        columns = np.array([[np.sort(np.random.default_rng([seed, t, p]).permutation(d)[:m]) for p in places] for t in range(trees)])
        (hist,) = total(blocks, lambda part: _histograms(part, model, level, columns, n_bins, classes))  # noqa: B023
        _split(model, hist, level, columns)
    _merge(model)
    return model


def fold_accuracy(df: DataFrame, k: int, trees: int = 100, depth: int = 2, seed: int = 0, fold: str = "fold",
                  features: str = "features", label: str = "label") -> list[tuple[int, float | None]]:
    """Per fold the accuracy, on its rows, of a forest fitted on all rows of the other folds (None: no rows)."""
    ship_sources(df.sparkSession)
    binning = borders(df, features)
    blocks = pack(df, binning, trees, seed, fold, features, label)
    classes = 1 + max(blocks.map(lambda r: int(r.y.max())).collect(), default=0)  # a number a block
    model = fit_folds(blocks, k, trees, depth, seed, len(binning.borders), binning.bins, classes)
    ((counts),) = total(blocks, lambda part: _right(part, model, depth))
    blocks.unpersist()
    return [(i, float(hit / n) if n else None) for i, (n, hit) in enumerate(counts)]
