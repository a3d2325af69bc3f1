"""What is counted while the staging tables are written: conversions, copies, hot codes."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import explain  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from ledgerline.operators.dedupe import dedupe_and_sum, dedupe_by_key  # noqa: E402
from ledgerline.operators.joins import frequent, hot_keys, join_dealt  # noqa: E402
from ledgerline.plans import checks as Q  # noqa: E402
from ledgerline.plans.model import build_model, build_model_from_raw, fact_sales  # noqa: E402
from ledgerline.sources import io  # noqa: E402

AT_SCALE = {
    "spark.ledgerline.broadcastMaxRows": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def at_scale(spark):
    for k, v in AT_SCALE.items():
        spark.conf.set(k, v)
    yield
    for k in AT_SCALE:
        spark.conf.unset(k)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_checks_of_a_written_model_are_those_of_a_lazy_one(spark, model):
    lazy = build_model(spark, SF_SMALL, materialized=False, reuse=False)
    assert model.metrics and not lazy.metrics
    for check in (Q.load_counts, Q.parse_quality):
        assert _rows(check(model)) == _rows(check(lazy))
        assert check(model).dtypes == check(lazy).dtypes
        assert "parquet" not in explain(check(model)) and "parquet" in explain(check(lazy))  # no export is read again
    assert _rows(model["stg_vendas"]) == _rows(lazy["stg_vendas"])


def test_checks_of_empty_exports(spark):
    empty = {t: spark.createDataFrame([], ", ".join(f"{c} string" for c in cols)) for t, cols in io.LAYOUTS.items()}
    m = build_model_from_raw(spark, empty)
    assert _rows(Q.load_counts(m)) == [(0, 0, 0, 0, 0)]
    assert all(r[2:] == (0, 0, 0) for r in Q.parse_quality(m).collect())


def test_dedupe_and_sum_keeps_the_same_rows(spark):
    rnd = random.Random(6)
    some = lambda: rnd.choice([None, "", "a", "b", "c"])
    rows = [(rnd.choice([None, "1", "01", "2", "3"]), rnd.choice("xyz"), some(), some(), rnd.randrange(3)) for _ in range(3000)]
    rows += [("hot", "x", some(), some(), 1) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, l string, a string, b string, n long").repartition(6)
    order = [F.col("a"), F.col("b")]
    plain = dedupe_by_key(df.drop("n"), ["k", "l"], [c.asc_nulls_last() for c in order])
    both = dedupe_and_sum(df, ["k", "l"], order, {"n": F.col("n"), "copies": F.lit(1)})
    assert _rows(both.select(plain.columns)) == _rows(plain)
    want = {}
    for k, l, _, _, n in rows:
        x, y = want.get((k, l), (0, 0))
        want[k, l] = (x + n, y + 1)
    assert {(r.k, r.l): (r.n, r.copies) for r in both.collect()} == want


def test_dedupe_and_sum_combines_before_its_exchange(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "cast(id as string) AS a")
    tree = explain(dedupe_and_sum(df, ["k"], [F.col("a")], {"n": F.lit(1)})).split("\n\n")[0]
    steps = [line for line in tree.splitlines() if "Aggregate" in line or "Exchange" in line]
    assert ["Aggregate" in s for s in steps] == [True, False, True]


def test_fact_build_reads_staging_once_and_shuffles_it_three_times(spark, at_scale):
    m = build_model(spark, SF_SMALL, reuse=False)
    plan = explain(fact_sales(m))
    assert sum(line.startswith("Location:") and "/stg_vendas" in line for line in plan.splitlines()) == 1
    # A shuffle of each side a join: three of the sales, three of dimensions.
    assert sum("hashpartitioning(__key" in line for line in plan.splitlines() if line.startswith("Arguments")) == 6
    lazy = build_model(spark, SF_SMALL, materialized=False, reuse=False)
    assert _rows(m["fct_vendas"]) == _rows(fact_sales(lazy))


def test_sketch_finds_the_hot_codes(spark):
    """Keys with more than a quarter of a mean partition, among very many others, with their salts."""
    n = 40_000
    code = F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 20 == 1, F.lit("WARM")).when(F.col("id") % 7 == 0, F.lit(None))
    df = spark.range(0, n, 1, 6).select(code.otherwise(F.concat(F.lit("C"), F.col("id"))).alias("c"))
    seen = df.agg(frequent(spark, "c").alias("top")).first().top
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unit = n / (4 * parts)
    want = {r.c: r["count"] for r in df.groupBy("c").count().collect() if r.c and r["count"] > unit}
    found = dict(hot_keys(spark, seen, n))
    assert set(found) == set(want) == {"HOT", "WARM"}
    assert all(abs(found[c] - want[c] / unit) < 1.5 for c in want)
    assert hot_keys(spark, [], 0) == []


def test_given_hot_keys_join_the_same_rows(spark):
    facts = spark.range(500).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'HOT' WHEN id % 5 = 0 THEN NULL ELSE concat('C', id) END AS c")
    dim = spark.range(400).selectExpr("concat('C', id) AS c", "id AS sk").unionByName(spark.sql("SELECT 'HOT' AS c, -1L AS sk"))
    for how in ("inner", "left"):
        for hot in ([("HOT", 9)], [], [("HOT", 3), ("C7", 2), ("absent", 4)], None):
            out = join_dealt(facts, dim, "c", ["id"], how, hot)
            assert _rows(out.select("id", "c", "sk")) == _rows(facts.join(dim, "c", how).select("id", "c", "sk"))
