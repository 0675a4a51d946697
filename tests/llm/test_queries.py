"""The registered queries: SQL parity, the pipeline by hand, and what the main paths may contain."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shopsignal.llm import queries
from tests.conftest import SF_SMALL


def _canon(rows):
    """Column names, and the rows as sorted texts: integers stay integers where a column holds nulls."""
    names = sorted(rows.column_names)
    columns = [rows.column(n).to_pylist() for n in names]
    return names, sorted("|".join(repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in zip(*columns))


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_duckdb(spark, duck, name):
    got = queries.QUERIES[name](spark, SF_SMALL).toArrow()
    assert _canon(got) == _canon(duck(SF_SMALL).sql(queries.ORACLE[name]).fetch_arrow_table())


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op8_mixing"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    rows, kept = docs, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF_SMALL)
        assert out.columns == docs.columns
        now = {r["doc_id"]: r["text"] for r in out.collect()}
        assert now.items() <= kept.items()
        if name == "quality classifier":
            good = {d for d, q in labels.items() if q == 1}
            assert len(good & now.keys()) >= 0.97 * len(good)
            assert len(now.keys() - good) < len(kept.keys() - good)
        if name == "exact dedup":
            assert now == {max(d for d, t in kept.items() if t == text): text for text in set(kept.values())}
        rows, kept = out, now
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF_SMALL)
    assert {r["doc_id"] for r in packed.collect()} == kept.keys()
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "piece", "length").collect()} == {
        tuple(r) for r in packed.select("doc_id", "piece", "length").collect()}


def test_pipeline_on_odd_rows(spark, odd, none):
    for rows in (odd, none):
        columns = rows.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SF_SMALL)
            assert rows.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, rows, SF_SMALL).count()
