"""Histogram boosters against plain split search, hand-made trees, and themselves under other layouts."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shopsignal.operators import trees as T
from shopsignal.operators.boosting import Boosting, BoostedModel, auc_of, fit_boosters

KEYS = ["k"]


def frame(spark, x, y, extra=None, parts=4):
    rows = [(i, [float(v) for v in r], float(t), *(e[i] for e in (extra or []))) for i, (r, t) in enumerate(zip(x, y))]
    names = "k long, x array<double>, label double" + "".join(f", e{j} boolean" for j in range(len(extra or [])))
    return spark.createDataFrame(rows, names).withColumn("features", array_to_vector("x")).repartition(parts)


def planted(n=600, d=4, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 1)
    odds = 2 * (x[:, 0] > 0.3) + 1.5 * (x[:, 1] < -0.2) * (x[:, 2] > 0) - 1
    y = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(float)
    return x, y


def grow_by_hand(x, y, margin, c, lowest):
    """One tree, one split at a time, thresholds tried one by one."""
    k = c.steepness
    p = 1 / (1 + np.exp(-k * margin))
    unit = T.GRADIENT_UNIT
    g, h = np.rint((p - y) * unit) / unit, np.rint(k * p * (1 - p) * unit) / unit

    def search(rows):
        best = (0.0, None)
        for f in range(x.shape[1]):
            miss = x[rows, f] <= lowest[f]
            for t in np.unique(x[rows, f])[:-1]:
                for default in ((True, False) if miss.any() and lowest[f] > -np.inf else (True,)):
                    go = np.where(miss, default, x[rows, f] <= t)
                    a, b = rows[go], rows[~go]
                    if min(len(a), len(b)) < max(1, c.min_rows) or min(h[a].sum(), h[b].sum()) < c.min_hessian:
                        continue
                    part = lambda r: g[r].sum() ** 2 / (h[r].sum() + c.l2)
                    gain = part(a) + part(b) - part(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (a, b))
        return best

    leaves, splits = [(np.arange(len(x)), 0, search(np.arange(len(x))))], []
    while len(leaves) < (c.leaves or 10**6):
        ready = [i for i, l in enumerate(leaves) if l[2][1] is not None and (not c.depth or l[1] < c.depth)]
        if not ready:
            break
        i = max(ready, key=lambda i: leaves[i][2][0])
        _, depth, (gain, (a, b)) = leaves.pop(i)
        splits.append(gain)
        leaves += [(r, depth + 1, search(r)) for r in (a, b)]
    out = np.zeros(len(x))
    for rows, _, _ in leaves:
        out[rows] = -g[rows].sum() / (h[rows].sum() + c.l2) * c.rate
    return out, splits


@pytest.mark.parametrize("c", [
    Boosting(rounds=3, rate=0.3, leaves=7, l2=1.0, min_rows=5),
    Boosting(rounds=3, rate=0.1, leaves=12, depth=3, both_classes=True, min_hessian=1.5),
    Boosting(rounds=2, rate=0.3, depth=3, l2=10.0, min_hessian=1.5, both_classes=True, from_prior=False, missing=True)])
def test_trees_equal_a_plain_search(spark, c):
    x, y = planted()
    x[::7, 3] = -9.0
    lowest = np.full(4, -np.inf)
    if c.missing:
        lowest[3] = -9.0
    model, = fit_boosters(frame(spark, x, y), [c], [F.lit(1.0)], [F.lit(False)], KEYS, marker=-9.0, marked=(3,), max_bins=200)
    margin = np.full(len(x), np.log(y.mean() / (1 - y.mean())) / c.steepness if c.from_prior else 0.0)
    assert model.getNumTrees == c.rounds and np.isclose(model.start, margin[0])
    for tree in model.trees:
        step, gains = grow_by_hand(x, y, margin, c, lowest)
        got = tree.value[tree.leaf_of_values(x, lowest)]
        assert np.allclose(got, step, atol=1e-7)
        assert np.allclose(sorted(tree.gain[tree.feature >= 0]), sorted(gains), atol=1e-5)
        margin += step
    assert np.allclose(model.margins(x), margin, atol=1e-6)


def test_hand_made_split_gain_and_leaves():
    # two bins: rows with gradients -2, 1 and hessians 3, 5 in sum; a third bin holds missing rows
    hist = np.zeros((3, 1, 3))
    hist[0, 0] = np.array([0.5, -2.0, 1.0]) * T.GRADIENT_UNIT
    hist[1, 0] = np.array([2.0, 3.0, 5.0]) * T.GRADIENT_UNIT
    hist[2, 0] = [8, 12, 20]
    s = T.best_split(hist, np.ones(1, bool), np.ones(1, bool), l2=10.0, min_hessian=1.5)
    whole = (-0.5) ** 2 / 20
    options = {(True, 0): 0.25 / 12 + 1 / 18 - whole, (True, 1): 1.5 ** 2 / 15 + 1 / 15 - whole,
               (False, 1): 4 / 13 + 1.5 ** 2 / 17 - whole}
    assert max(options, key=options.get) == (False, 1) == (s.default_left, s.bin)
    assert np.isclose(s.gain, options[False, 1]) and np.allclose(s.left, (-2, 3, 12)) and np.allclose(s.right, (1.5, 7, 28))
    assert T.best_split(hist, np.ones(1, bool), np.ones(1, bool), l2=10.0, min_hessian=8.0).gain == 0
    assert T.best_split(hist, np.zeros(1, bool), np.ones(1, bool)).gain == 0


def test_gamma_cuts_back_from_the_leaves(spark):
    x, y = planted()
    low, high = fit_boosters(frame(spark, x, y), [Boosting(rounds=1, depth=4, gamma=g) for g in (0.0, 4.0)],
                             [F.lit(1.0)] * 2, [F.lit(False)] * 2, KEYS)
    a, b = low.trees[0], high.trees[0]
    assert len(b.feature) < len(a.feature)
    # a split below gamma stays only above one that is not
    for i in np.flatnonzero((b.feature >= 0) & (b.gain < 4.0)):
        assert max(b.gain[b.left[i]], b.gain[b.right[i]]) > 0


def test_early_stopping_keeps_the_best_round_on_held_out_rows(spark):
    x, y = planted(1500)
    held = np.arange(1500) % 3 == 0
    df = frame(spark, x, y, [[bool(h) for h in held]])
    for metric in ("log_loss", "auc"):
        c = Boosting(rounds=200, patience=8, rate=0.5, leaves=8, metric=metric, row_share=0.8, column_share=0.75, seed=5)
        model, = fit_boosters(df, [c], [(~F.col("e0")).cast("double")], [F.col("e0")], KEYS)
        best = model.getNumTrees
        assert 0 < best and len(model.history) == best + 8 and max(model.history) == model.history[best - 1]
        m, start = model.margins(x[held]), model.start
        if metric == "log_loss":
            assert np.isclose(-(np.logaddexp(0, m) - y[held] * m).mean() * T.GRADIENT_UNIT, model.history[best - 1], rtol=1e-5)
        else:
            order = np.argsort(m)
            rank = np.empty(len(m))
            for v in np.unique(m):
                rank[m == v] = np.flatnonzero(m[order] == v).mean() + 1
            pos = y[held] == 1
            exact = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
            assert abs(exact - model.history[best - 1]) < 1e-3
        assert np.isfinite(start)


def test_same_model_for_any_partitioning_and_side_by_side(spark):
    x, y = planted()
    fold = np.arange(600) % 3
    settings = [Boosting(rounds=30, patience=6, rate=0.3, leaves=6, row_share=0.7, column_share=0.7, level_share=0.7, seed=2, metric=m)
                for m in ("auc", "log_loss", "auc")]
    extra = [[bool(fold[i] == f) for i in range(600)] for f in range(3)]
    args = ([(~F.col(f"e{f}")).cast("double") for f in range(3)], [F.col(f"e{f}") for f in range(3)], KEYS)
    settings = [replace(c, rounds=8) for c in settings]
    one, four = (fit_boosters(frame(spark, x, y, extra, p), settings, *args) for p in (1, 4))
    jobs = [fit_boosters(frame(spark, x, y, extra, p), settings, *args, local_rows=0) for p in (1, 40)]  # passes as Spark jobs
    assert [m.history for m in one] == [m.history for m in jobs[0]] == [m.history for m in jobs[1]]
    for a, b, c in [*zip(one, four, jobs[0]), *zip(one, four, jobs[1])]:
        assert a.getNumTrees == b.getNumTrees == c.getNumTrees > 0
        for s, t, u in zip(a.trees, b.trees, c.trees):
            for name in T.Tree.NAMES:
                assert np.array_equal(getattr(s, name), getattr(t, name)) and np.array_equal(getattr(s, name), getattr(u, name))


def test_scores_save_load_and_importance(spark, tmp_path):
    x, y = planted()
    df = frame(spark, x, y)
    model, = fit_boosters(df, [Boosting(rounds=5, leaves=5, both_classes=True)], [F.lit(1.0)], [F.lit(False)], KEYS)
    model.save(spark, str(tmp_path / "m"))
    again = BoostedModel.load(spark, str(tmp_path / "m"))
    rows = {r["k"]: r for r in again.transform(df).collect()}
    want = 1 / (1 + np.exp(-2 * model.margins(x)))
    assert all(np.isclose(rows[i]["probability"][1], want[i]) and rows[i]["prediction"] == float(want[i] > 0.5) for i in range(600))
    nodes = model.nodes(spark)
    for by in ("split", "gain"):
        got = {r["feature"]: r["importance"] for r in T.importance(nodes, by).collect()}
        for f in range(4):
            own = [t.gain[t.feature == f] for t in model.trees]
            assert np.isclose(got.get(f, 0.0), sum(len(g) if by == "split" else g.sum() for g in own))


def test_weights_and_empty_tables(spark):
    x, y = planted(200)
    doubled = frame(spark, np.concatenate([x, x[:50]]), np.concatenate([y, y[:50]]))
    weighted = frame(spark, x, y).withColumn("w", F.when(F.col("k") < 50, 2.0).otherwise(1.0))
    c = Boosting(rounds=4, leaves=5)
    a, = fit_boosters(doubled, [c], [F.lit(1.0)], [F.lit(False)], KEYS, max_bins=250)
    b, = fit_boosters(weighted, [c], [F.col("w")], [F.lit(False)], KEYS, max_bins=250)
    assert np.allclose(a.margins(x), b.margins(x))
    none, unused = fit_boosters(doubled, [c, c], [F.lit(0.0), F.lit(None)], [F.lit(False)] * 2, KEYS)
    assert none.getNumTrees == unused.getNumTrees == 0
    empty, = fit_boosters(doubled.limit(0), [c], [F.lit(1.0)], [F.lit(False)], KEYS)
    assert {r["probability"][1] for r in empty.transform(doubled).collect()} == {0.5}


def test_auc_of_cells():
    assert auc_of(np.array([[1.0, 1, 0], [0, 1, 1]])) == (0.5 + 1 + 1 + 1) / 4
    assert auc_of(np.zeros((2, 3))) == 0.5
