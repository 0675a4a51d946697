"""Same results for 1 and 16 shuffle partitions and for shuffled input order."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _rows(spark, name, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = E.queries()[name](spark, SF_SMALL)
        return sorted(tuple(str(v) for v in r) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("name", ["user_features", "user_most_n_cnt", "tfidf_topvocab", "event_position",
                                  "stratified_kfold", "auc", "hist_user"])
def test_partition_count_invariance(spark, name):
    assert _rows(spark, name, 1) == _rows(spark, name, 16)


def test_input_order_invariance(spark):
    from shopsignal.operators import features as feat
    from shopsignal.sources import fixtures as fx
    log = fx.user_log(spark, SF_SMALL)
    def canon(rows):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    a = feat.user_stats(log).collect()
    b = feat.user_stats(log.repartition(7).sortWithinPartitions("item_id")).collect()
    assert canon(a) == canon(b)
