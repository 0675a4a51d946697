"""Differential tests: every query with an oracle equals DuckDB on the same parquet (sf0.001)."""

import math

import pandas as pd
import pyarrow as pa
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()


def _canon(df):
    cols = sorted(df.columns)
    rows = []
    for r in df[cols].itertuples(index=False):
        out = []
        for v in r:
            if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
                out.append("<null>")
            elif isinstance(v, float):
                out.append(repr(round(v, 6)))
            elif hasattr(v, "item"):
                x = v.item()
                out.append(repr(round(x, 6)) if isinstance(x, float) else str(x))
            else:
                out.append(str(v))
        rows.append("|".join(out))
    return cols, sorted(rows)


def _pandas(df):
    """Integers stay integers where a column holds nulls, as DuckDB's do."""
    whole = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}
    return df.toArrow().to_pandas(types_mapper=whole.get)


@pytest.fixture
def small_models(monkeypatch):
    """Which rows are scored does not depend on the models' sizes: small ones here."""
    from shopsignal.plans import q_models
    q_models.forget()
    monkeypatch.setattr(q_models, "PRESET", "small")
    yield
    q_models.forget()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name, small_models):
    con = duck(SF_SMALL)
    got = _pandas(E.queries()[name](spark, SF_SMALL))
    want = con.sql(ORACLE[name]).df()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
