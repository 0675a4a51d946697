"""Deep forests and exact nearest neighbours against plain versions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shopsignal.operators import forest as fo
from shopsignal.operators import knn
from shopsignal.operators.trees import Binning
from tests.test_boosting import frame, planted


def gini_by_hand(x, y, rows, feature, t):
    out = 0.0
    for side in (rows[x[rows, feature] <= t], rows[x[rows, feature] > t]):
        if not len(side):
            return -np.inf
        p = y[side].sum()
        out += (p * p + (len(side) - p) ** 2) / len(side)
    return out


def walk(tree, x):
    """(rows of each inner node, feature, threshold), and the leaf of every row."""
    feature, value, left = tree
    todo, inner, leaf = [(0, np.arange(len(x)))], [], np.zeros(len(x), int)
    while todo:
        node, rows = todo.pop()
        if feature[node] < 0:
            leaf[rows] = node
            continue
        inner.append((rows, feature[node], value[node]))
        go = x[rows, feature[node]] <= value[node]
        todo += [(left[node], rows[go]), (left[node] + 1, rows[~go])]
    return inner, leaf


def test_best_splits_of_all_features():
    x, y = planted(300)  # each node draws two of four features
    borders = tuple(np.unique(c)[:-1] for c in x.T)
    bins = Binning(borders).apply(x)
    tree = fo.grow(x, bins, borders, y, np.arange(300), fo.Forest(depth=4), np.random.default_rng(1))
    inner, leaf = walk(tree, x)
    assert len(inner) > 5
    for rows, f, t in inner:
        best = max(gini_by_hand(x, y, rows, f, b) for b in borders[f])
        assert np.isclose(gini_by_hand(x, y, rows, f, t), best)
    for node in np.unique(leaf):
        assert np.isclose(tree[1][node], y[leaf == node].mean())
    assert np.allclose(fo.leaf_value(tree, x), tree[1][leaf])


def test_random_thresholds_are_not_best_and_lie_inside():
    x, y = planted(400)
    borders = tuple(np.unique(c)[:-1] for c in x.T)
    c = fo.Forest(depth=35, bootstrap=False, random_thresholds=True)
    tree = fo.grow(x, Binning(borders).apply(x), borders, y, np.arange(400), c, np.random.default_rng(1))
    inner, leaf = walk(tree, x)
    worse = 0
    for rows, f, t in inner:
        assert x[rows, f].min() <= t < x[rows, f].max()
        worse += gini_by_hand(x, y, rows, f, t) < max(gini_by_hand(x, y, rows, f, b) for b in borders[f]) - 1e-9
    assert worse > len(inner) / 2
    # grown out: a leaf is pure, or its rows cannot be told apart
    for node in np.unique(leaf):
        rows = np.flatnonzero(leaf == node)
        assert len(set(y[rows])) == 1 or (x[rows] == x[rows[0]]).all()


def test_forests_same_for_any_partitioning_and_by_groups(spark):
    x, y = planted(500)
    part = [[bool(i % 3) for i in range(500)]]
    settings = [fo.Forest(trees=12, depth=5, seed=3), fo.Forest(trees=9, depth=9, bootstrap=False, random_thresholds=True, seed=3)]
    scores = []
    for p in (1, 5):
        df = frame(spark, x, y, part, p)
        models = fo.fit_forests(df, settings, [F.col("e0").cast("double"), F.lit(1.0)], ["k"])
        for m in models:
            got = {r["k"]: r["p"] for r in m.transform(df).select("k", vector_to_array("probability")[1].alias("p")).collect()}
            m.group_nodes = 1  # every tree a group of its own
            again = {r["k"]: r["p"] for r in m.transform(df).select("k", vector_to_array("probability")[1].alias("p")).collect()}
            assert got == pytest.approx(again)
            scores.append(got)
            assert m.nodes().count() == m.trees
    assert scores[0] == pytest.approx(scores[2]) and scores[1] == pytest.approx(scores[3])
    pos = [scores[0][i] for i in range(500) if y[i] == 1]
    assert np.mean(pos) > np.mean([scores[0][i] for i in range(500) if y[i] == 0]) + 0.1


def test_forest_bound_and_empty_tables(spark):
    x, y = planted(50)
    df = frame(spark, x, y)
    with pytest.raises(ValueError):
        fo.fit_forests(df, [fo.Forest(trees=1)], [F.lit(1.0)], ["k"], sample=49)
    empty, = fo.fit_forests(df.limit(0), [fo.Forest(trees=1)], [F.lit(1.0)], ["k"])
    unused, = fo.fit_forests(df, [fo.Forest(trees=1)], [F.lit(0.0)], ["k"])
    for m in (empty, unused):
        assert {r["probability"][1] for r in m.transform(df).collect()} == {0.5}


def nearest_by_hand(ask, rows, k):
    out = []
    for i, q in ask:
        far = sorted((float(np.sqrt(((np.array(q) - np.array(r)) ** 2).sum())), j) for j, r in rows)
        out += [(i, n + 1, j, round(f, 9)) for n, (f, j) in enumerate(far[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 7, 500])
def test_nearest_against_all_pairs(spark, monkeypatch, k):
    """Clusters, copies at equal distances, far outliers; small tiles so that many pairs are skipped."""
    monkeypatch.setattr(knn, "TILE_ROWS", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 5)) * 30
    rows = [(i, [float(v) for v in np.round(centres[i % 8] + rng.normal(size=5), 3)]) for i in range(240)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(5000, [1e4] * 5), (5001, [0.0] * 5)]
    ask = rows[::9] + [(9000, [float(v) for v in centres[3]])]
    schema = "id long, x array<double>"
    bad = [(None, [1.0] * 5), (7000, None), (7001, [1.0, None, 1.0, 1.0, 1.0]), (7002, [1.0, float("nan"), 1.0, 1.0, 1.0])]
    tables = [spark.createDataFrame(r + bad, schema).repartition(5) for r in (ask, rows)]
    got = sorted((r["query"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in knn.nearest(*tables, k).collect())
    assert got == nearest_by_hand(ask, rows, k)
    assert knn.nearest(tables[0], tables[1].limit(0), k).collect() == []
    assert knn.nearest(tables[0].limit(0), tables[1], k).collect() == []


def test_far_pairs_of_tiles_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(knn, "TILE_ROWS", 20)
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, [float(1000 * (i % 10) + v) for v in rng.normal(size=3)]) for i in range(1000)], "id long, x array<double>")
    usable = knn._usable(rows, "id", F.col("x"), F.lit(0.0), 3)
    pivots = np.array([[1000.0 * i] * 3 for i in range(10)])
    tiles = knn._tiles(usable, pivots, "t")
    n = tiles.count()
    assert n >= 50 and knn._pairs(tiles, tiles, 5).count() <= n * n / 5


def test_neighbours_learner(spark):
    x, y = planted(300)
    df = frame(spark, x, y).withColumn("user_id", F.col("k")).withColumn("merchant_id", F.lit(1))
    model = knn.KNeighbors(15).fit(df.where("k % 3 <> 0"))
    got = {r["k"]: r["probability"][1] for r in model.transform(df.where("k % 3 = 0")).collect()}
    train = np.array([i for i in range(300) if i % 3])
    for i, p in got.items():
        far = np.sort(((x[train] - x[i]) ** 2).sum(1))
        sure = train[((x[train] - x[i]) ** 2).sum(1) < far[14]]  # those tied with the last may differ
        assert y[sure].sum() / 15 - 1e-9 <= p <= (y[sure].sum() + 15 - len(sure)) / 15 + 1e-9
    assert len(got) == 100
    empty = knn.KNeighbors(15).fit(df.limit(0)).transform(df)
    assert {r["probability"][1] for r in empty.collect()} == {0.5}
    assert df.select(array_to_vector("x")).count() == 300


def test_copies_and_groups_are_sent_once(spark, monkeypatch):
    """Equal vectors are one of a tile, and a tile goes to a group of query tiles once; results as of all pairs."""
    monkeypatch.setattr(knn, "TILE_ROWS", 4)
    monkeypatch.setattr(knn, "COPIES", 6)
    monkeypatch.setattr(knn, "MERGED", 10)
    monkeypatch.setattr(knn, "EMITTED", 50)
    rng = np.random.default_rng(6)
    kinds = [[float(v) for v in rng.normal(size=3)] for _ in range(30)]
    rows = [(i, kinds[i % 30 if i < 260 else 0]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x array<double>").repartition(3)
    pivots = np.array(kinds[:2])
    tiles = knn._tiles(knn._usable(df, "id", F.col("x"), F.lit(0.0), 3), pivots, "t").collect()
    assert sum(r["n"] for r in tiles) == 300 and sum(len(r["x"]) // 24 for r in tiles) < 300 / 3
    for k in (5, 40):
        got = sorted((r["query"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in knn.nearest(df, df, k).collect())
        assert got == nearest_by_hand(rows, rows, k)
