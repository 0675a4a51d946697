"""What must hold whatever the size: plans without needless sorts, ties, hot users, cluster settings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopsignal.operators import features as feat
from shopsignal.operators import folds as fo
from shopsignal.operators import profile as pr
from shopsignal.operators import text as tx
from shopsignal.plans import ranking, registry
from tests.conftest import SF_SMALL

registry.load_all()


@pytest.mark.parametrize("name", ["user_cnt", "user_action_cnt", "user_time_stats"])
def test_base_statistics_neither_sort_nor_explode(spark, name):
    plan = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Generate" not in plan


def test_folds_move_no_rows(spark):
    df = spark.range(2000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("merchant_id"),
                                  (F.col("id") % 3 == 0).cast("int").alias("label"), F.array(F.rand()).alias("features"))
    for out in (fo.kfold(df, 5), fo.stratified_kfold(df, 5), fo.train_test_split(df, 0.3), fo.kfold(df, 4, shuffle=False)):
        assert "Exchange" not in out._jdf.queryExecution().toString()
    sizes = [r["count"] for r in fo.kfold(df, 7).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [286] * 5 + [285] * 2
    assert fo.train_test_split(df, 0.3).where("is_test").count() == 600
    tiny = df.limit(3)
    assert sorted(r["fold"] for r in fo.kfold(tiny, 5).collect()) == [0, 1, 2]
    assert fo.kfold(df.limit(0), 5).count() == 0


def test_order_cuts_descend_into_buckets(spark):
    df = spark.range(3000).select("id")
    key = F.md5(F.col("id").cast("string"))
    want = sorted(r[0] for r in df.select(key).collect())
    assert ranking.order_cuts(df, key, [0, 1499, 2999, 3000], step=1, most=20) == [want[0], want[1499], want[2999], None]


def test_ties_are_combined_before_the_sort(spark):
    df = spark.range(300_000).select((F.col("id") % 2).cast("double").alias("x"))
    assert ranking.value_positions(df, "x").count() == 2
    q = ranking.exact_quantiles(df, "x", [0.25, 0.5, 0.75]).first()
    assert (q["q0"], q["q1"], q["q2"]) == (0.0, 0.5, 1.0)
    points = pr.probplot_points(df.limit(30_000))
    assert points.count() == 30_000
    ranks = points.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()
    assert tuple(ranks) == (1, 30_000, 30_000)


def test_long_history_gives_one_word2vec_row(spark):
    """A user of 2,500 events: the mean over all tokens, not one row for each chunk."""
    log = spark.range(2600).select(
        F.when(F.col("id") < 2500, 1).otherwise(2).cast("long").alias("user_id"), (F.col("id") % 5).alias("item_id"),
        F.lit("c").alias("cat_id"), (F.col("id") % 6).alias("seller_id"), F.lit("b").alias("brand_id"),
        F.col("id").cast("int").alias("time_stamp"), F.lit("0").alias("action_type"))
    model, sents = tx.fit_word2vec(log, "seller_id", vector_size=4, partitions=1)
    assert sents.where("user_id = 1").count() == 3
    got = {r["user_id"]: r for r in tx.w2v_user_vectors(model, sents).collect()}
    assert set(got) == {1, 2} and got[1]["n_events"] == 2500
    vec = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    n = {r["s"]: r["n"] for r in log.where("user_id = 1").groupBy(F.col("seller_id").cast("string").alias("s")).agg(
        F.count("*").alias("n")).collect()}
    want = sum(vec[w] * n[w] for w in vec) / 2500
    assert got[1]["w2v"].toArray() == pytest.approx(want, abs=1e-6)


def test_fractional_and_large_times(spark):
    rows = [(1, 15.5, "0"), (1, 16.0, "1"), (2, 1.7e15 + 1, "2"), (2, 1.7e15 + 3, "2")]
    log = spark.createDataFrame(rows, "user_id long, time_stamp double, action_type string")
    got = {r["user_id"]: r for r in feat.user_base_stats(log).collect()}
    assert got[1]["time_stamp_max"] == 16.0 and got[1]["time_stamp_std"] == pytest.approx(0.25)
    assert got[2]["time_stamp_std"] == pytest.approx(1.0)


def test_cluster_session_settings():
    """Without a local master neither master nor checkpoint folder is set, and a missing folder is an error."""
    from types import SimpleNamespace

    from shopsignal import session

    class Conf(dict):
        def contains(self, k):
            return k in self

        def set(self, k, v):
            self[k] = v

    def fake(conf, master="yarn"):
        sc = SimpleNamespace(getConf=lambda: Conf(conf), master=master, getCheckpointDir=lambda: None, done=[])
        sc.setCheckpointDir = sc.done.append
        return SimpleNamespace(sparkContext=sc, conf=Conf())

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake({}))
    s = fake({"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.ensure_checkpoint_dir(s) == "hdfs:///shared" and s.sparkContext.done == ["hdfs:///shared"]
    s = fake({"spark.sql.shuffle.partitions": "77"})
    session.apply_cluster_conf(s)
    assert "spark.sql.shuffle.partitions" not in s.conf and s.conf["spark.sql.files.maxPartitionBytes"] == "256m"


@pytest.mark.parametrize("name", ["kfold", "stratified_kfold", "shuffle_split", "log_loss", "confusion_matrix", "auc", "r2_score"])
def test_pairs_are_computed_once(spark, name):
    """The many passes of a split read the checkpointed pairs, not the fact tables again."""
    assert "l_orderkey" not in registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()


def _orders_and_lines(spark, folder, n=60):
    i = F.col("id")
    day = F.when(i % 3 == 0, F.lit("2000-02-03 00:00:00")).otherwise(F.lit("1997-05-06 00:00:00"))
    spark.range(n).select(i.alias("o_orderkey"), (i % 13).alias("o_custkey"), F.to_timestamp_ntz(day).alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    spark.range(4 * n).select((i % n).alias("l_orderkey"), (i % 7).alias("l_suppkey")).write.parquet(f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("name", ["confusion_matrix", "auc", "accuracy_by_fold", "log_loss", "fold_score_summary"])
def test_metrics_join_the_fact_tables_once(spark, tmp_path, monkeypatch, name):
    """Counts, fold borders, scores and the result all read the checkpointed pairs: the cost of one join, at any size."""
    from shopsignal.sources import fixtures as fx
    _orders_and_lines(spark, tmp_path)
    read, cuts, seen = fx.read_table, fo.order_cuts, []
    scans = []
    monkeypatch.setattr(fx, "read_table", lambda s, d, table, *cols: scans.append(table) or read(s, d, table, *cols))
    monkeypatch.setattr(fo, "order_cuts", lambda df, *a, **k: seen.append(df) or cuts(df, *a, **k))
    out = registry.QUERIES[name](spark, str(tmp_path))
    assert sorted(scans) == ["lineitem", "orders"] and len(seen) == 1
    for df in (*seen, out):
        assert "l_orderkey" not in df._jdf.queryExecution().analyzed().toString()
    assert out.count() > 0


def test_bootstrap_digests_once_a_row(spark):
    plan = registry.QUERIES["bootstrap_counts"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


def test_samples_are_read_not_filtered_again(spark):
    from shopsignal.operators.learners import fit_sample
    df = spark.range(500).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("merchant_id"))
    got = fit_sample(df, 100)
    assert "Filter" not in got._jdf.queryExecution().analyzed().toString()
    h = F.md5(F.concat_ws("_", F.lit("fit"), "user_id", "merchant_id"))
    want = {r["user_id"] for r in df.orderBy(h).limit(100).collect()}
    assert {r["user_id"] for r in got.collect()} == want and len(want) == 100
    assert fit_sample(df, 500) is df


def test_numbered_events_hold_what_is_kept(spark):
    from shopsignal.operators.history import event_positions
    log = spark.range(50).select((F.col("id") % 3).alias("user_id"), *[(F.col("id") % 11).cast("string").alias(c) for c in
                                 ("item_id", "seller_id", "action_type", "cat_id", "brand_id")], F.col("id").cast("int").alias("time_stamp"))
    got = event_positions(log, keep=["item_id"])
    assert set(got.columns) == {"user_id", "item_id", "pos"}
    every = {tuple(r) for r in event_positions(log).select("user_id", "item_id", "pos").collect()}
    assert {tuple(r) for r in got.select("user_id", "item_id", "pos").collect()} == every and len(every) == 50


def test_sentences_are_built_once(spark):
    from shopsignal.sources import fixtures as fx
    sents = tx.fit_word2vec(fx.user_log(spark, SF_SMALL), "seller_id", vector_size=4, partitions=1)[1]
    assert "Aggregate" not in sents._jdf.queryExecution().analyzed().toString()


def test_stumps_are_scored_by_expressions(spark):
    from pyspark.ml.functions import vector_to_array
    from shopsignal.operators.learners import AdaBoostSAMME
    from tests.test_boosting import frame, planted
    x, y = planted(300)
    df = frame(spark, x, y)
    label = df.columns[[c.lower() for c in df.columns].index("label")]
    model = AdaBoostSAMME(6, 0.5, "features", label).fit(df)
    out = model.transform(df)
    assert "UDF" not in out.drop("features")._jdf.queryExecution().analyzed().toString().replace("vector_to_array", "").split("Project")[1]
    cur, dec = df, F.lit(0.0)
    for i, (s, a) in enumerate(zip(model.stumps, model.alphas)):
        cur = s.setPredictionCol(f"p{i}").setProbabilityCol(f"pp{i}").setRawPredictionCol(f"rp{i}").transform(cur)
        dec = dec + F.lit(a) * F.when(F.col(f"p{i}") == 1, 1.0).otherwise(-1.0)
    want = {r["k"]: r["p"] for r in cur.select("k", (1 / (1 + F.exp(-2 * dec / sum(model.alphas)))).alias("p")).collect()}
    got = {r["k"]: r["p"] for r in out.select("k", vector_to_array("probability")[1].alias("p")).collect()}
    assert got == pytest.approx(want) and len(set(want.values())) > 1


def test_equal_rows_are_scored_once():
    import numpy as np
    from shopsignal.operators.trees import of_distinct
    x, seen = np.random.default_rng(0).normal(size=(6, 3))[[0, 1, 0, 5, 1, 0, 2]], []

    def score(v):
        seen.append(len(v))
        return v.sum(1)

    assert (of_distinct(x, score) == x.sum(1)).all() and seen == [4]
    assert len(of_distinct(x[:0], score)) == 0


def _events(spark, n=4000):
    i = F.col("id")
    return spark.range(n).select((i % 37).alias("user_id"), (i * 7 % 11).alias("item_id"), (i * 5 % 6).cast("string").alias("cat_id"),
                                 (i * 3 % 8).alias("seller_id"), F.when(i % 4 > 0, (i % 9).cast("string")).alias("brand_id"),
                                 (i * 13 % 101).cast("int").alias("time_stamp"), (i % 4).cast("string").alias("action_type")).repartition(5)


@pytest.mark.parametrize("n", [1, 2])
def test_whole_histories_move_once(spark, n):
    """Dealt by user, tokens and favourites need no exchange beyond the log's own; same rows as range-sorted."""
    log = _events(spark)
    dealt = feat.token_stats(log, n=n, tasks=3)
    assert "ENSURE_REQUIREMENTS" not in dealt._jdf.queryExecution().executedPlan().toString()
    want = {r["user_id"]: r.asDict() for r in feat.token_stats(log, n=n).collect()}
    assert {r["user_id"]: r.asDict() for r in dealt.collect()} == want and len(want) == 37


def test_long_histories_are_split(spark, monkeypatch):
    log = _events(spark)
    assert feat.task_count(log) == 1 and feat.task_count(log.limit(0)) == 1
    monkeypatch.setattr(feat, "TASK_EVENTS", 200)
    assert feat.task_count(log) == 20
    monkeypatch.setattr(feat, "TASK_EVENTS", 100)  # a user has 108 or 109 events
    assert feat.task_count(log) is None


def test_stacked_tables_move_rows_once(spark):
    from shopsignal.operators.ensemble import stack_tables
    long = spark.createDataFrame([(u, 1, float(u % 2), n, f, (u + f) / 9 + (n == "b") / 10) for u in range(4) for n in "ab" for f in range(2)],
                                 "user_id long, merchant_id long, label double, learner string, fold int, p double")
    tm, sm, _ = stack_tables(long.where("fold = user_id % 2"), long.drop("label"), ["a", "b"])
    for df in (tm, sm):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["user_id"]: r["a"] for r in tm.collect()} == pytest.approx({u: (u + u % 2) / 9 for u in range(4)})
    assert {r["user_id"]: r["b"] for r in tm.collect()} == pytest.approx({u: (u + u % 2) / 9 + 0.1 for u in range(4)})
    assert {r["user_id"]: r["b"] for r in sm.collect()} == pytest.approx({u: (u + 0.5) / 9 + 0.1 for u in range(4)})


def _many_pairs(spark, n=120_000):
    """More rows than the fits of earlier versions read."""
    from pyspark.ml.functions import array_to_vector
    i = F.col("id")
    x = array_to_vector(F.array((i % 7).cast("double"), (i % 3).cast("double")))
    return spark.range(n).select(i.alias("user_id"), (i % 11).alias("merchant_id"), (i % 4 == 0).cast("double").alias("label"), x.alias("features"))


def test_oof_boosters_read_all_rows(spark, monkeypatch):
    from shopsignal.operators import ensemble as en
    read, fit = [], en.fit_boosters
    monkeypatch.setattr(en, "fit_boosters", lambda df, *a, **k: read.append(df.count()) or fit(df, *a, **k))
    df = _many_pairs(spark)
    oof, _ = en.oof_scores(df, df.drop("label").limit(10), ["gb"], k=2, preset="small")
    assert read == [120_000] and oof.count() == 120_000


def test_bags_read_all_rows(spark):
    from shopsignal.operators.ensemble import StackedBagging
    m = StackedBagging(stacking_num=1, bagging_num=1, preset="small").fit(_many_pairs(spark))
    # the root's hessians: p (1 - p) of every row of the training part that the first bag draws
    assert m.bagging_models[0].trees[0].cover[0] == pytest.approx(120_000 * 0.67 * 0.8 * 0.25 * 0.75, rel=0.02)


def test_importance_booster_reads_all_rows(spark):
    from shopsignal.operators.select import fit_importance_model
    model, _ = fit_importance_model(_many_pairs(spark), "small")
    assert model.trees[0].cover[0] == pytest.approx(120_000 * 0.6 * 0.8 * 0.25 * 0.75, rel=0.02)


def test_quantiles_of_many_values_equal_those_of_a_map(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector
    from shopsignal.operators import trees
    v = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / 1000.0
    df = spark.range(5000).select(array_to_vector(F.array(v, (F.col("id") % 5).cast("double"), v * v)).alias("features"))
    want = trees.Binning.fit(df)
    monkeypatch.setattr(trees, "MAP_VALUES", 100)
    got = trees.Binning.fit(df)
    assert [list(b) for b in got.borders] == [list(b) for b in want.borders] and len(got.borders[0]) == 63


def test_equal_rows_are_one_cell_and_none_is_lost(spark):
    from shopsignal.operators import trees
    rng = np.random.default_rng(1)
    bins, y, weight = rng.integers(0, 3, (2000, 2)).astype(np.uint8), rng.integers(0, 2, 2000).astype(float), rng.integers(0, 3, (2000, 1)).astype(float)
    key = rng.integers(0, 1 << 62, 2000).astype(np.uint64)
    block = trees.block_of(bins, y, key, weight, weight == 0, [(5, 0)])
    c = block.cells[0]
    assert len(block.bins) == 9 and c.rows.sum() == (weight > 0).sum() and c.held_rows.sum() == (weight == 0).sum()
    on = (weight[:, 0] > 0) & (trees.uniform(key, 5, 0, 7) < 0.3)
    drawn = c.drawn(0.3, 7)
    for i in range(len(c.rows)):
        same = (bins == block.bins[c.at[i]]).all(1) & (y == c.y[i]) & (weight[:, 0] == c.weight[i])
        assert c.rows[i] == same.sum() and drawn[i] == (on & same).sum()


def test_forests_read_all_rows(spark, monkeypatch):
    from shopsignal.operators import ensemble as en
    read, fit = [], en.fit_forests
    monkeypatch.setattr(en, "fit_forests", lambda df, *a, **k: read.append(df.count()) or fit(df, *a, **k))
    df = _many_pairs(spark)
    oof, _ = en.oof_scores(df, df.drop("label").limit(10), ["rf", "et"], k=2, preset="small")
    assert read == [120_000] * 2 and oof.count() == 240_000


def test_a_tree_of_counted_rows_is_that_of_the_rows():
    from shopsignal.operators import forest
    from shopsignal.operators.trees import Binning
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (60, 5)).astype(float)
    borders = tuple(np.arange(8.0) for _ in range(5))
    times = rng.integers(1, 6, 60)
    many = np.repeat(np.arange(60), times)
    y = rng.integers(0, 2, len(many)).astype(float)
    bins = Binning(borders).apply(x)
    for c in (forest.Forest(depth=9), forest.Forest(depth=20, random_thresholds=True)):
        one = forest.grow(x[many], bins[many], borders, y, np.arange(len(many)), c, np.random.default_rng(3))
        two = forest.grow(x, bins, borders, np.bincount(many, y), np.arange(60), c, np.random.default_rng(3), times.astype(float))
        assert len(one[0]) > 9 and all(np.array_equal(a, b) for a, b in zip(one, two))


def test_trained_vectors_are_joined_as_a_table(spark):
    from shopsignal.operators import text as tx
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.feature import Word2Vec
    sents = spark.createDataFrame([(["a", "b", "c", "b"] * 3,)] * 20, "s array<string>")
    model = Word2Vec(inputCol="s", outputCol="o", vectorSize=4, minCount=1, numPartitions=1, seed=1).fit(sents)
    table = tx.w2v_table(model)
    rows = lambda df: {r["word"]: r["v"] for r in df.select("word", vector_to_array("vector").alias("v")).collect()}
    assert rows(table) == rows(model.getVectors()) and len(rows(table)) == 3
    toks = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "user_id long, token string")
    plan = tx.mean_vectors(toks, table.hint("merge"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "LocalTableScan" not in plan.split("SortMergeJoin")[1].split("FileScan")[1]


def test_w2v_mean_keeps_vectors_off_the_driver(spark):
    plan = registry.QUERIES["w2v_mean"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD [word" not in plan


def test_neighbours_put_out_totals(spark):
    from shopsignal.operators import knn
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(0, 5, 3)], float(rng.integers(0, 2))) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double")
    every = knn.nearest(df, df, 20, pay=F.col("y")).groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.sum("pay").alias("total"))
    got = knn.nearest(df, df, 20, pay=F.col("y"), totals=True)
    assert sorted(got.collect()) == sorted(every.collect()) and got.count() == 900


def test_borders_are_taken_from_all_rows(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector
    from shopsignal.operators import shallow
    n, read, make = 240_000, [], shallow.borders
    monkeypatch.setattr(shallow, "borders", lambda df, *a: read.append((df.count(), make(df, *a))) or read[-1][1])
    x = F.array(F.col("id").cast("double"), F.greatest(F.col("id") - (n - 3), F.lit(0)).cast("double"))  # 1 and 2 are in one row each
    df = spark.range(n).select(F.col("id").alias("user_id"), (F.col("id") % 11).alias("merchant_id"), array_to_vector(x).alias("features"),
                               (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 2).alias("fold"))
    assert len(shallow.fold_accuracy(df, 2, trees=2)) == 2
    rows, binning = read[0]
    assert rows == n and list(binning.borders[1]) == [0.5, 1.5]
    assert np.allclose(binning.borders[0], np.arange(1, 32) * n / 32, atol=n / 1000)


def test_small_vocabularies_are_dealt_to_several_tasks():
    from shopsignal.operators import skipgram
    assert [skipgram.block_count(n) for n in (0, 1, 7_500, 7_501, 120_000, 800_000, 800_001, 7_200_000)] == [1, 1, 1, 2, 16, 16, 17, 144]
