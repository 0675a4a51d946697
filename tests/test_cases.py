"""Hand-built cases (FIXTURES.md section 4) for the reference's quirks and defects."""

import pytest
from pyspark.sql import functions as F

from shopsignal.functions.narrowing import narrow_plan
from shopsignal.functions.stats import sanitize
from shopsignal.operators import features as feat
from shopsignal.operators import profile as pr
from shopsignal.operators import text as tx

LOG_SCHEMA = "user_id long, item_id long, cat_id string, seller_id long, brand_id string, time_stamp int, action_type string"


def _log(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def _events(spark, sellers, actions=None, items=None, user=1):
    actions = actions or ["0"] * len(sellers)
    items = items or list(range(100, 100 + len(sellers)))
    return _log(spark, [(user, items[i], "c", sellers[i], "b", i + 1, actions[i]) for i in range(len(sellers))])


def test_most_n_ties_first_seen(spark):
    # path b a a b c -> most 1 = b (first seen), count 2; most 3 = c; most 4 = -1
    sellers = [2, 1, 1, 2, 3]
    log = _events(spark, sellers)
    one = feat.token_stats(log, n=1).first()
    assert one["seller_most_1"] == "2" and one["seller_most_cnt_1"] == 2
    three = feat.token_stats(log, n=3).first()
    assert three["seller_most_3"] == "3" and three["seller_most_cnt_3"] == 1
    users = spark.createDataFrame([(1,)], "user_id long")
    four = feat.with_missing_defaults(users.join(feat.token_stats(log, n=4), "user_id", "left"), n=4).first()
    assert four["seller_most_4"] == "-1" and four["seller_most_cnt_4"] == -1


def test_missing_history_defaults(spark):
    log = _events(spark, [5, 6], user=1)
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    out = feat.with_missing_defaults(users.join(feat.user_stats(log), "user_id", "left"))
    r = {x["user_id"]: x for x in out.collect()}[2]
    for c in ("user_cnt", "seller_nunique", "time_stamp_max", "time_stamp_min", "seller_most_cnt_1"):
        assert r[c] == -1
    assert r["time_stamp_std"] == -1.0 and r["seller_most_1"] == "-1" and r["time_stamp_range"] == 0


def test_population_std(spark):
    log = _log(spark, [(1, 1, "c", 1, "b", 1, "0"), (1, 2, "c", 1, "b", 3, "0")])
    assert feat.user_base_stats(log).first()["time_stamp_std"] == pytest.approx(1.0)


def test_action_count_and_compat(spark):
    log = _events(spark, [7, 7, 7, 8], actions=["0", "2", "2", "3"])
    assert feat.user_base_stats(log).first()["buy_cnt"] == 2
    assert feat.user_base_stats(log, compat=True).first()["buy_cnt"] == 4


def test_action_distinct_and_compat(spark):
    # favourite (seller, item) distinct: sellers 7 7 7 8, actions 0 2 2 3 -> 1; compat adds the empty key
    log = _events(spark, [7, 7, 7, 8], actions=["0", "2", "2", "3"], items=[1, 1, 1, 1])
    assert feat.user_stats(log).first()["fav_seller_item_nunique"] == 1
    assert feat.user_stats(log, compat=True).first()["fav_seller_item_nunique"] == 2


def test_unknown_ratio(spark):
    info = spark.createDataFrame([(1, None, 1), (2, 0, 1), (3, 3, 1), (4, 4, 1)],
                                 "user_id long, age_range int, gender int")
    assert pr.unknown_ratio(info).first()["age_range_unknown_ratio"] == pytest.approx(0.5)


def test_mean_embedding_in_vocabulary(spark):
    toks = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "q")], "user_id long, token string")
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "word string, v array<double>")
    from pyspark.ml.functions import array_to_vector, vector_to_array
    vecs = vecs.select("word", array_to_vector("v").alias("vector"))
    m = tx.mean_vectors(toks, vecs).select(vector_to_array("mean_vec").alias("m")).first()["m"]
    assert m == pytest.approx([2 / 3, 1.0])


def test_one_character_tokens_dropped(spark):
    log = _events(spark, [3, 42, 42])
    toks = [r["token"] for r in tx.word_tokens(log, "seller_id").collect()]
    # the event with only "3" keeps a null-token row so its document still counts
    assert sorted(t for t in set(toks) if t is not None) == ["42"]
    assert toks.count(None) == 1


@pytest.mark.parametrize("lo,hi,expect", [(0, 200, "smallint"), (-128, 5, "smallint"), (1, 200, "smallint"),
                                          (-5, 5, "tinyint"), (1, 60000, "int")])
def test_narrowing_bounds_strict(spark, lo, hi, expect):
    df = spark.createDataFrame([(lo,), (hi,)], "x long")
    assert narrow_plan(df).first()["spark_type"] == expect


def test_narrowing_unsigned_between_signed(spark):
    df = spark.createDataFrame([(1,), (200,)], "x long")
    assert narrow_plan(df).first()["ref_dtype"] == "uint8"


def test_sanitize(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (2.0,)], "x double")
    assert [r[0] for r in df.select(sanitize(F.col("x"))).collect()] == [0.0, 0.0, 0.0, 2.0]


def test_union_fills_missing(spark):
    tr = spark.createDataFrame([(1, 2, 1)], "user_id long, merchant_id long, label int")
    te = spark.createDataFrame([(3, 4, None)], "user_id long, merchant_id long, prob double")
    rows = {r["user_id"]: r for r in tr.unionByName(te, allowMissingColumns=True).collect()}
    assert rows[1]["prob"] is None and rows[3]["label"] is None


def test_histogram_of_nothing_is_empty(spark):
    empty = spark.createDataFrame([], "x double")
    assert pr.fd_histogram(empty).count() == 0


def test_histogram_single_value(spark):
    one = spark.createDataFrame([(0.5,), (0.5,), (0.5,)], "x double")
    rows = pr.fd_histogram(one).collect()
    assert sum(r["n"] for r in rows) == 3


def test_degenerate_inputs_do_not_divide_by_zero(spark):
    from shopsignal.operators import evaluate as ev
    one_class = spark.createDataFrame([(1, 0.3), (1, 0.7)], "label int, score double")
    assert ev.auc(one_class).first()["auc"] is None
    assert ev.r2_score(one_class).first()["r2"] is None
    const = spark.createDataFrame([(1, 5.0), (2, 5.0)], "user_id long, v double")
    assert [r["z_v"] for r in ev.zscore(const, ["v"]).collect()] == [None, None]
    assert pr.kde(const.select(F.col("v").alias("x"))).count() == 0
