"""The model and the analyses under the reference's table and view names, for Spark SQL users.

``register_views(model)`` publishes session temp views (no catalog, no server), so queries
written against the reference's names keep working, e.g.
``spark.sql("SELECT categoria, margem_pct FROM an_categoria")``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .plans import analyses as A
from .plans import checks as Q
from .plans.model import Model, fact_columns

# Reference name -> analysis (fixed names of the reference's views).
ANALYSIS_VIEWS = {
    "an_categoria": A.margin_by_category,
    "an_cascata": A.margin_waterfall,
    "an_clientes_abc": A.customer_abc,
    "an_clientes_criticos": A.critical_customers,
    "an_desconto": A.discount_bands,
    "an_frete": A.freight_subsidy,
    "an_mensal": A.monthly_trend,
    "an_produtos_prejuizo": A.loss_products,
    "an_vendedor": A.seller_performance,
    "painel": A.panel,
}
MODEL_TABLES = [
    "raw_vendas", "raw_produtos", "raw_clientes", "stg_produtos", "stg_clientes", "stg_vendas",
    "dim_produto", "dim_cliente", "dim_vendedor", "dim_tempo",
]


def views(m: Model) -> dict[str, DataFrame]:
    out = {name: m[name] for name in MODEL_TABLES}
    out["fct_vendas"] = fact_columns(m["fct_vendas"])
    out.update({name: fn(m) for name, fn in ANALYSIS_VIEWS.items()})
    return out


def register_views(m: Model) -> list[str]:
    """Create or replace a session temp view per table and analysis; returns the names."""
    names = []
    for name, df in views(m).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


CHECKS = {
    "load_counts": Q.load_counts,
    "dimension_counts": Q.dimension_counts,
    "fact_integrity": Q.fact_integrity,
    "panel_range": Q.panel_range,
    "parse_quality": Q.parse_quality,
}
