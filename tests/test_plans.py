"""Plan properties that matter at scale, checked on the physical plans."""

import os
import re
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import explain  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from ledgerline.plans import analyses as A  # noqa: E402

ANALYSES = [
    A.margin_by_category, A.margin_waterfall, A.customer_abc, A.critical_customers, A.discount_bands,
    A.freight_subsidy, A.monthly_trend, A.loss_products, A.seller_performance, A.panel,
]


def test_analyses_read_one_pruned_filtered_scan_and_join_nothing(model):
    for fn in ANALYSES:
        if fn in (A.customer_abc, A.critical_customers):  # read the written curve, see below
            continue
        plan = explain(fn(model))
        tree = plan.split("\n\n")[0]
        assert "Join" not in tree and "CartesianProduct" not in tree, fn.__name__
        pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters: ")]
        assert any("EqualTo(custo_confiavel,true)" in line for line in pushed), (fn.__name__, pushed)
        # column pruning: no analysis reads the whole fact
        width = len(model["fct_vendas"].columns)
        for schema in [line for line in plan.splitlines() if line.startswith("ReadSchema: ")]:
            assert schema.count(":") < width, (fn.__name__, schema)


def test_fact_build_at_scale_has_no_single_partition_over_sales(spark):
    from ledgerline.plans.model import build_model, fact_sales

    conf = {
        "spark.ledgerline.broadcastMaxRows": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        m = build_model(spark, SF_SMALL, reuse=False)
        plan = explain(fact_sales(m))
        tree = plan.split("Subqueries")[0]  # the subqueries add up one row a partition
        assert "SinglePartition" not in tree
        assert "SortMergeJoin" in plan and "NestedLoopJoin" not in plan
        assert "hashpartitioning(__key" in plan and "__salt" in plan  # hot and NULL codes are dealt out
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_ordered_scan_has_one_plan_and_no_single_task_over_rows(spark):
    from ledgerline.operators.ordered import ordered_scan

    df = spark.range(5000).selectExpr("id", "cast(id % 97 as string) AS k")
    out = ordered_scan(df, [("k", False), ("id", False)], number="n")
    plan = explain(out)
    # What meets in one partition is the per-partition counts, below the broadcast.
    for exchange in re.findall(r"Arguments: SinglePartition.*", plan):
        assert exchange
    assert plan.count("SinglePartition") <= 2 and "rangepartitioning" not in plan
    aggregate = plan.index("HashAggregate")
    assert plan.index("SinglePartition") > aggregate


def test_dedupe_limits_before_any_exchange_on_its_key(spark):
    from ledgerline.plans.staging import dedupe_sales
    from ledgerline.sources.fixture import raw_sales

    tree = explain(dedupe_sales(raw_sales(spark, SF_SMALL))).split("\n\n")[0]
    lines = [line for line in tree.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    # final limit, exchange on the key, partial limit; below that only the order-key join
    assert len(limits) == 2 and limits[1] - limits[0] == 2
    assert "l_linenumber" not in "".join(re.findall(r"hashpartitioning\((.*?)\)", explain(raw_sales(spark, SF_SMALL))))


def test_number_text_is_made_once_a_value(spark):
    from ledgerline.plans.staging import stg_products
    from ledgerline.sources.io import RAW_PRODUCT_COLUMNS

    raw = spark.createDataFrame([tuple("x" for _ in RAW_PRODUCT_COLUMNS)], ", ".join(f"{c} string" for c in RAW_PRODUCT_COLUMNS))
    plan = stg_products(raw.repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 2  # two number columns


def test_a_month_of_the_panel_reads_that_month_only(spark, model):
    month = A.panel(model).filter("ano_mes = '1995-03'")
    plan = explain(month)
    assert re.search(r"PartitionFilters: \[.*ano_mes#\d+ = 1995-03\)\]", plan)
    stored = model["fct_vendas"].filter("ano_mes = '1995-03'").select(F.input_file_name().alias("f")).distinct().collect()
    assert 1 <= len(stored) <= 2 and all("ano_mes=1995-03" in r.f for r in stored)
    assert {r.ano_mes for r in month.collect()} == {"1995-03"}


def test_fact_by_month_keeps_its_columns_and_rows(spark, model):
    from ledgerline.plans.model import fact_sales

    stored, made = model["fct_vendas"], fact_sales(model)
    assert stored.columns == made.columns and stored.dtypes == made.dtypes
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, made.collect()))


def test_items_of_an_order_are_combined_where_they_are_read(spark, model):
    """An order's items of a month lie in one file, side by side; so the partial aggregate of
    (group, order) leaves one row of each for the shuffle."""
    fact = model["fct_vendas"].select("numero_pedido", "ano_mes", F.input_file_name().alias("f"))
    assert fact.select("numero_pedido", "f").distinct().count() == fact.select("numero_pedido", "ano_mes").distinct().count()
    rows = fact.withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()
    files = {}
    for r in rows:
        files.setdefault(r.f, []).append(r.numero_pedido)
    assert all(orders == sorted(orders) for orders in files.values())
