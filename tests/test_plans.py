"""Scale assertions on physical plans and the driver contract."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["user_features", "user_nunique", "user_most_n", "tfidf_topvocab",
                                  "mean_embedding", "repeat_rate_merchant", "crosstab_age"])
def test_no_python_udf_in_relational_plans(spark, name):
    p = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


# partial aggregates, one row per partition (_pid) or per class label, or a top-k
BOUNDED_CHILD = ("partial_", "keys=[_pid", "keys=[label", "TakeOrderedAndProject", "Limit", "Scan ExistingRDD", "LocalTableScan")


@pytest.mark.parametrize("name", ["user_features", "user_most_n", "tfidf_topvocab", "event_position",
                                  "auc", "kfold", "stratified_kfold"])
def test_single_partition_only_over_bounded_input(spark, name):
    """A SinglePartition exchange may only gather partial aggregates or a top-k (bounded rows)."""
    lines = [x for x in _plan(E.queries()[name](spark, SF_SMALL)).splitlines() if x.strip()]
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            assert any(b in child for b in BOUNDED_CHILD), f"unbounded gather: {line} / {child}"


def test_scan_prunes_columns(spark):
    p = E.queries()["scan_log"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in p and "l_comment" not in p


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.schema == E.entry(spark).schema
    assert set(E.oracle_sql()) <= set(E.queries())


def test_no_cross_join_or_python_in_relational_queries(spark):
    """Relational queries, which are all but those over trained models and the training-data operators."""
    from tools.plan_report import relational, report
    rows = report(spark, SF_SMALL, relational())
    assert len(rows) > 70
    assert [n for n, s in rows if s["cross"]] == []
    assert [n for n, s in rows if s["python"]] == []


def test_cluster_conf_sets_runtime_sql_settings(spark):
    from shopsignal.session import CLUSTER_SQL_CONF, apply_cluster_conf
    before = {k: spark.conf.get(k) for k in CLUSTER_SQL_CONF}
    try:
        apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "7"})
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("256m", str(256 * 1024 * 1024))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
