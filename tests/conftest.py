import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session, scratch_root

    s = local_session(4, shuffle_partitions=8, app="ledgerline-tests")
    scratch_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def model(spark):
    from ledgerline.plans.model import build_model

    return build_model(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ["region", "nation", "customer", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
