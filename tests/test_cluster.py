"""The queries on a cluster of two executors whose spark.checkpoint.dir is a plain path that they share."""

import importlib.util
import json
import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

NAMES = [
    "csv_sales", "customer_abc", "dim_customer", "dim_product", "dim_date", "dim_seller", "dimension_counts",
    "discount_bands", "export_model", "export_panel_csv", "export_reports", "export_reports_category",
    "export_reports_customers", "export_reports_discount", "export_reports_freight", "export_reports_panel",
    "fact_integrity", "fact_sales",
]

# Runs NAMES over the folder given and puts out, by name, the sorted rows or the error.
JOB = """
import json, sys
from pyspark.sql import SparkSession
from ledgerline.api import QUERIES

kept, folder, out, *names = sys.argv[1:]
conf = {
    "spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "1024m", "spark.checkpoint.dir": kept,
    "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1",
}
spark = SparkSession.builder.config(map=conf).getOrCreate()
found = {}
for name in names:
    try:
        found[name] = sorted(str(tuple(r)) for r in QUERIES[name](spark, folder).collect())
    except Exception as e:
        found[name] = f"{type(e).__name__}: {e}"
with open(out, "w") as f:
    json.dump(found, f)
spark.stop()
"""


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = {
        "region": spark.sql("SELECT id AS r_regionkey, concat('R', id) AS r_name FROM range(2)"),
        "nation": spark.sql("SELECT id AS n_nationkey, id % 2 AS n_regionkey FROM range(4)"),
        "customer": spark.sql(
            "SELECT id AS c_custkey, concat('Customer ', id) AS c_name, id % 4 AS c_nationkey, id * 10.5D - 40 AS c_acctbal,"
            " concat('S', id % 3) AS c_mktsegment FROM range(1, 31)"
        ),
        "part": spark.sql(
            "SELECT id AS p_partkey, concat('part ', id) AS p_name, concat('B', id % 2) AS p_brand,"
            " element_at(array('PROMO', 'SMALL', 'ECONOMY', 'LARGE'), int(id % 4) + 1) AS p_type, 900 + id * 1.25D AS p_retailprice"
            " FROM range(1, 41)"
        ),
        "orders": spark.sql(
            "SELECT id AS o_orderkey, 1 + id * 7 % 30 AS o_custkey, timestamp_ntz'2020-01-01' + make_dt_interval(int(id)) AS o_orderdate"
            " FROM range(1, 121)"
        ),
        "lineitem": spark.sql(
            "SELECT 1 + id % 120 AS l_orderkey, 1 + id * 11 % 40 AS l_partkey, 1 + id * 13 % 50 AS l_suppkey,"
            " int(1 + id div 120) AS l_linenumber, double(1 + id % 9) AS l_quantity, 950.25D * (1 + id % 9) AS l_extendedprice,"
            " (id % 11) / 100.0D AS l_discount, (id % 9) / 100.0D AS l_tax, element_at(array('R', 'N', 'A'), int(id % 3) + 1) AS l_returnflag"
            " FROM range(600)"
        ),
    }
    for name, df in rows.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def on_cluster(tables, tmp_path_factory):
    top = tmp_path_factory.mktemp("cluster")
    # The executors' folders go to ``work`` in Spark's home: one of our own, that links to the real one.
    home = os.path.dirname(importlib.util.find_spec("pyspark").origin)
    (top / "home").mkdir()
    for name in os.listdir(home):
        if name != "work":
            (top / "home" / name).symlink_to(f"{home}/{name}")
    env = os.environ | {
        "SPARK_HOME": f"{top}/home", "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": f"{top}/local", "PYTHONPATH": ROOT,
        "PYSPARK_SUBMIT_ARGS": "--driver-memory 1g pyspark-shell", "PYSPARK_PYTHON": sys.executable,
    }
    # What the test's own session has told its JVM is not for this one.
    env = {k: v for k, v in env.items() if k not in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET", "SPARK_ENV_LOADED")}
    job = [sys.executable, "-c", JOB, f"{top}/kept", tables, f"{top}/found.json", *NAMES]
    ran = subprocess.run(job, env=env, cwd=top, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0, ran.stderr[-2000:]
    return json.loads((top / "found.json").read_text())


@pytest.mark.parametrize("name", NAMES)
def test_a_query_gives_the_same_rows_on_a_cluster_with_a_plain_shared_folder(spark, tables, on_cluster, name):
    from ledgerline.api import QUERIES

    there = on_cluster[name]
    assert isinstance(there, list), there
    assert there and there == sorted(str(tuple(r)) for r in QUERIES[name](spark, tables).collect())
