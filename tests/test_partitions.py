"""The same answers whatever the number of shuffle partitions (1, 4, 200) or join strategy."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.functions.numeric import exact_mean
from ledgerline.operators.joins import fits_broadcast, join_dealt, measured
from ledgerline.plans import analyses as A
from ledgerline.plans.model import build_model, fact_sales


def _snapshot(spark):
    m = build_model(spark, SF_SMALL, reuse=False)
    out = {}
    for fn in (A.margin_by_category, A.customer_abc, A.monthly_trend, A.seller_performance):
        out[fn.__name__] = sorted((tuple(r) for r in fn(m).collect()), key=repr)
    out["dim_produto"] = sorted((tuple(r) for r in m["dim_produto"].collect()), key=repr)
    out["fct_vendas"] = sorted((tuple(r) for r in m["fct_vendas"].collect()), key=repr)
    return out, m


def _with(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def base(spark):
    old = _with(spark, {"spark.sql.shuffle.partitions": "4"})
    try:
        return _snapshot(spark)[0]
    finally:
        _restore(spark, old)


@pytest.mark.parametrize("parts", [1, 200])
def test_partition_count_does_not_change_results(spark, base, parts):
    old = _with(spark, {"spark.sql.shuffle.partitions": str(parts)})
    try:
        assert _snapshot(spark)[0] == base
    finally:
        _restore(spark, old)


def test_shuffle_joins_give_same_results(spark, base):
    """Dimensions too big to broadcast: sort-merge joins, NULL customer codes on salted keys."""
    old = _with(spark, {
        "spark.ledgerline.broadcastMaxRows": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    })
    try:
        snap, m = _snapshot(spark)
        plan = fact_sales(m)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 3
        assert snap == base
    finally:
        _restore(spark, old)


def test_mean_discounts_do_not_depend_on_the_order(spark):
    """Discounts of two arbitrary decimals, in 1, 4 and 200 partitions."""
    rnd = random.Random(5)
    rows = [(f"S{rnd.randrange(40)}", rnd.randrange(3000) / 100) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, desconto_pct double")
    want = {}
    for k in {r[0] for r in rows}:
        values = [round(d * 10_000) for g, d in rows if g == k]
        want[k] = sum(values) / 10_000 / len(values)
    for n in (1, 4, 200):
        got = df.repartition(n).groupBy("k").agg(*A._discounts()).select("k", exact_mean("ds", "dn").alias("m")).collect()
        assert {r.k: r.m for r in got} == want


def test_hot_codes_are_dealt_over_tasks(spark):
    """A third of the sales on one code and a third without one: no partition above twice the
    median, adaptive execution off."""
    n = 30_000
    code = F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("C"), F.col("id")))
    facts = spark.range(n).select(F.col("id").alias("numero_pedido"), F.lit(1).alias("sequencia_item"), code.alias("codigo"))
    dim = spark.range(n).select(F.concat(F.lit("C"), F.col("id")).alias("codigo"), F.col("id").alias("sk"))
    dim = dim.unionByName(spark.range(1).select(F.lit("HOT").alias("codigo"), F.lit(-1).cast("long").alias("sk")))
    old = _with(spark, {
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    try:
        for how in ("inner", "left"):
            out = join_dealt(facts, dim, "codigo", ["numero_pedido", "sequencia_item"], how)
            sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
            assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8], sizes
            plain = facts.join(dim, "codigo", how)
            assert out.columns == plain.columns or set(out.columns) == set(plain.columns)
            key = ["numero_pedido", "codigo", "sk"]
            assert _rows(out.select(*key)) == _rows(plain.select(*key))
    finally:
        _restore(spark, old)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_long_texts_are_not_broadcast(spark):
    """The bytes of a dimension count, not only its rows."""
    short = spark.range(2000).select(F.col("id"), F.lit("x").alias("t"))
    long = spark.range(2000).select(F.col("id"), F.repeat(F.lit("x"), 50_000).alias("t"))
    assert fits_broadcast(short, *measured(short)) and not fits_broadcast(long, *measured(long))
    assert fits_broadcast(long.select("id"), *measured(long))
