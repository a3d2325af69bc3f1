"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import analyses as A
from .plans import checks as Q
from .plans.model import Model, build_model, fact_columns
from .plans.staging import dedupe_sales, stg_customers, stg_products
from .session import new_scratch_dir, scratch_root
from .sources import io
from .sources.fixture import raw_customers, raw_products, raw_sales
from .sources.scratch import shuffles_removed


def _model(spark: SparkSession, sf_dir: str) -> Model:
    scratch_root(spark)
    return build_model(spark, sf_dir)


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _model(spark, sf_dir)[name]

    run.__name__ = name
    return run


def _on_model(fn: Callable[[Model], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_model(spark, sf_dir))

    run.__name__ = fn.__name__
    return run


def _raw(fn: Callable[[DataFrame], DataFrame] | None, source) -> Callable[[SparkSession, str], DataFrame]:
    """Queries over one raw export: no model build needed."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = source(spark, sf_dir)
        return fn(raw) if fn else raw

    run.__name__ = (fn or source).__name__
    return run


def _csv(name: str, source, reader) -> Callable[[SparkSession, str], DataFrame]:
    """An export written in the ERP's layout and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_scratch_dir(spark, f"csv-{name}")
        return reader(spark, io.write_raw_exports({name: source(spark, sf_dir)}, folder)[name])

    run.__name__ = f"csv_{name}"
    return run


def _exported_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the model written as Parquet; the fact read back."""
    m = _model(spark, sf_dir)
    tables = {t: m[t] for t in ("dim_produto", "dim_cliente", "dim_vendedor", "dim_tempo")}
    paths = io.export_model(tables | {"fct_vendas": fact_columns(m["fct_vendas"])}, new_scratch_dir(spark, "export"))
    return spark.read.parquet(paths["fct_vendas"])


def _exported_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel written as (compressed) CSV and read back as text."""
    panel, path = A.panel(_model(spark, sf_dir)), new_scratch_dir(spark, "panel-csv")
    io.export_panel_csv(panel, path, "gzip")
    return io.read_raw_csv(spark, path, panel.columns, ",")


def _exported_sheet(sheet: str) -> Callable[[SparkSession, str], DataFrame]:
    """The report sheets written as (compressed) CSV (once a model); one of them read back as text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = _model(spark, sf_dir)
        with m.lock:
            if "sheets" not in m.exports:
                views = A.report_views(m)
                with shuffles_removed(spark):
                    paths = io.export_reports(views, f"{m.folder}/reports", "gzip")
                m.exports["sheets"] = {s: (paths[s], views[s].columns) for s in views}
        path, columns = m.exports["sheets"][sheet]
        return io.read_raw_csv(spark, path, columns, ",")

    run.__name__ = f"export_{sheet}"
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources (the raw exports, projected from the test tables)
    "raw_sales": _raw(None, raw_sales),
    "raw_products": _raw(None, raw_products),
    "raw_customers": _raw(None, raw_customers),
    "csv_sales": _csv("raw_vendas", raw_sales, io.read_raw_sales),
    "csv_products": _csv("raw_produtos", raw_products, io.read_raw_products),
    "csv_customers": _csv("raw_clientes", raw_customers, io.read_raw_customers),
    # staging
    "dedupe_by_key": _raw(dedupe_sales, raw_sales),
    "stg_products": _raw(stg_products, raw_products),
    "stg_customers": _raw(stg_customers, raw_customers),
    "stg_sales": _table("stg_vendas"),
    # star schema
    "dim_product": _table("dim_produto"),
    "dim_customer": _table("dim_cliente"),
    "dim_seller": _table("dim_vendedor"),
    "dim_date": _table("dim_tempo"),
    "fact_sales": _on_model(lambda m: fact_columns(m["fct_vendas"])),
    # analyses
    "margin_by_category": _on_model(A.margin_by_category),
    "margin_waterfall": _on_model(A.margin_waterfall),
    "customer_abc": _on_model(A.customer_abc),
    "critical_customers": _on_model(A.critical_customers),
    "discount_bands": _on_model(A.discount_bands),
    "freight_subsidy": _on_model(A.freight_subsidy),
    "monthly_trend": _on_model(A.monthly_trend),
    "loss_products": _on_model(A.loss_products),
    "seller_performance": _on_model(A.seller_performance),
    "panel": _on_model(A.panel),
    # sinks
    "export_model": _exported_model,
    "export_panel_csv": _exported_panel,
    "export_reports": _exported_sheet("por_mes"),
    "export_reports_panel": _exported_sheet("painel"),
    "export_reports_category": _exported_sheet("por_categoria"),
    "export_reports_discount": _exported_sheet("por_desconto"),
    "export_reports_customers": _exported_sheet("clientes"),
    "export_reports_freight": _exported_sheet("frete"),
    # checks
    "load_counts": _on_model(Q.load_counts),
    "dimension_counts": _on_model(Q.dimension_counts),
    "fact_integrity": _on_model(Q.fact_integrity),
    "panel_range": _on_model(Q.panel_range),
    "parse_quality": _on_model(Q.parse_quality),
}
