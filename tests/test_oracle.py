"""Every registered query against its DuckDB oracle (row count, column names and types, values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import compare  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from ledgerline.api import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, list(QUERIES))


def test_every_query_has_an_oracle():
    import __spark_entry__ as E

    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_all_queries_match(results):
    bad = {k: v for k, v in results.items() if v["status"] != "ok"}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6 and {"categoria", "margem_pct", "situacao"} <= set(df.columns)
