"""Forests of shallow trees fitted on all rows of the other folds."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shopsignal.operators import evaluate as ev
from shopsignal.operators import shallow
from shopsignal.operators.folds import stratified_kfold
from shopsignal.operators.select import cv_accuracy
from tests.test_perceptron import pairs


def test_fold_forests_near_sparks_and_same_for_any_layout(spark):
    df = pairs(spark).cache()
    got, other = ([r["accuracy"] for r in cv_accuracy(d, "features", trees=40).orderBy("fold").collect()] for d in (df, df.repartition(5)))
    assert got == other
    f = stratified_kfold(df, 5, shuffle=False).cache()
    for i in (0, 3):
        rf = RandomForestClassifier(numTrees=40, maxDepth=2, seed=0).fit(f.where(F.col("fold") != i))
        assert got[i] == pytest.approx(ev.accuracy(rf.transform(f.where(F.col("fold") == i))).first()["accuracy"], abs=0.04)


def test_fold_forests_count_every_row_and_not_their_own_fold(spark):
    f = stratified_kfold(pairs(spark, 600), 3, shuffle=False)
    binning = shallow.Binning.fit(f, "features", shallow.BINS, exact=False)
    blocks = shallow.pack(f, binning, 5, 0, "fold", "features", "label")
    rows = blocks.collect()
    assert sum(int(r.times.sum()) for r in rows) == 600
    model = shallow.fit_folds(blocks, 3, 5, 2, 0, 6, binning.bins, 2)
    for i, t in np.ndindex(3, 5):
        assert model.counts[i, t, 0].sum() == sum(int(r.draws[r.fold != i, t].sum()) for r in rows)
        node = [model.node_of(i, t, r.bins, 2) for r in rows]
        for leaf in range(7):  # the shares of the leaves are those of the rows that reach them
            want = [sum(int(r.draws[(r.fold != i) & (r.y == c) & (at == leaf), t].sum()) for r, at in zip(rows, node)) for c in (0, 1)]
            if sum(want):
                assert list(model.counts[i, t, leaf]) == want


def test_a_rare_value_can_be_split_off(spark):
    """One row in 50 has a value of its own that decides the label: all of them are predicted right."""
    rare = (F.col("merchant_id") % 50 == 0).cast("double")
    df = pairs(spark, 2000).withColumn("features", array_to_vector(F.array(rare))).withColumn("label", rare)
    assert [r["accuracy"] for r in cv_accuracy(df, "features", trees=10).collect()] == [1.0] * 5
