import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shopsignal.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from shopsignal.sources.tables import TABLES

    def make(sf):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        return con
    return make
