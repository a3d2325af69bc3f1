"""Star schema: dimensions (D1-D5), the order-item fact (F1) and the job that materialises them."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import r2
from ..operators.joins import fits_broadcast, frequent, hot_keys, join_dealt, measured
from ..operators.ordered import ordered_scan
from ..session import app_id, new_scratch_dir
from ..sources.fixture import TABLES, raw_tables, table_path
from ..sources.scratch import files_digest, in_passes, materialize_passes, pass_count, remove_folder
from .staging import SALES_KEY, Watched, stage_plain, stage_sales, stg_customers, stg_products, stg_sales

# Fixed values of the reference: seller names and commission rates by seller code, and the
# defaults for any other code.
SELLER_NAMES = {"V01": "Rogerio Antunes", "V02": "Simone Klein", "V03": "Tarcisio Bueno"}
SELLER_RATES = {"V01": 0.030, "V02": 0.035, "V03": 0.028}
SELLER_DEFAULT_NAME = "Nao informado"
SELLER_DEFAULT_RATE = 0.032
# Member that receives sales whose customer code is missing or unknown.
UNKNOWN_CUSTOMER = (0, "NAO_IDENTIFICADO", "Cliente nao identificado")

PRODUCT_COLUMNS = ["codigo_produto", "descricao", "categoria", "unidade", "custo_unitario", "preco_tabela", "ativo"]
CUSTOMER_COLUMNS = ["codigo_cliente", "razao_social", "cnpj", "segmento", "regiao", "data_cadastro"]
CUSTOMER_ORDER = CUSTOMER_COLUMNS + ["cod_vendedor", "limite_credito"]


def assign_surrogate_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Dense key 1..n in ``order`` (ascending, NULLs last), without a single-task window."""
    keyed = ordered_scan(df, [(c, False) for c in order], number=name)
    return keyed.select(name, *[c for c in df.columns])


def dim_product(stg: DataFrame) -> DataFrame:
    """D2."""
    keyed = assign_surrogate_key(stg.select(*PRODUCT_COLUMNS), PRODUCT_COLUMNS, "sk_produto")
    return keyed.select(
        "sk_produto", "codigo_produto", "descricao", "categoria", "unidade", "custo_unitario", "preco_tabela",
        F.col("custo_unitario").isNotNull().alias("custo_confiavel"), "ativo",
    )


def dim_customer(stg: DataFrame) -> DataFrame:
    """D3: customers plus the member 0 for orphan sales."""
    keyed = assign_surrogate_key(stg.select(*CUSTOMER_ORDER), CUSTOMER_ORDER, "sk_cliente").select(
        "sk_cliente", *CUSTOMER_COLUMNS
    )
    schema = keyed.schema
    unknown = stg.sparkSession.createDataFrame([UNKNOWN_CUSTOMER + (None, None, None, None)], schema)
    return keyed.unionByName(unknown)


def _lookup(code, mapping: dict, default, dtype: str):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v)))
    return expr.otherwise(F.lit(default)).cast(dtype)


def dim_seller(codes: DataFrame) -> DataFrame:
    """Every non-NULL seller code seen in the sales, with name and commission rate."""
    distinct = codes.select("cod_vendedor").filter(F.col("cod_vendedor").isNotNull()).distinct()
    keyed = assign_surrogate_key(distinct, ["cod_vendedor"], "sk_vendedor")
    code = F.col("cod_vendedor")
    return keyed.select(
        "sk_vendedor", "cod_vendedor",
        _lookup(code, SELLER_NAMES, SELLER_DEFAULT_NAME, "string").alias("nome_vendedor"),
        _lookup(code, SELLER_RATES, SELLER_DEFAULT_RATE, "double").alias("taxa_comissao"),
    )


def date_key(day) -> F.Column:
    """``yyyymmdd`` as int, the date dimension's key."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def dim_date(span: DataFrame, first: str = "data_pedido", last: str = "data_pedido") -> DataFrame:
    """One row per day from the earliest to the latest sale.

    ``span`` is the sales table, or any summary of it carrying the dates in ``first``/``last``.
    The day list is generated from one (min, max) row, so its size is the date span, not the
    data volume.
    """
    bounds = span.agg(F.min(first).alias("inicio"), F.max(last).alias("fim"))
    days = bounds.select(F.explode(F.sequence("inicio", "fim")).alias("d"))
    d = F.col("d")
    weekday = (F.dayofweek(d) - 1).cast("bigint")
    return days.select(
        date_key(d).alias("sk_tempo"),
        d.alias("data"),
        F.year(d).cast("bigint").alias("ano"),
        F.month(d).cast("bigint").alias("mes"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        F.quarter(d).cast("bigint").alias("trimestre"),
        weekday.alias("dia_semana"),
        F.date_format(d, "EEEE").alias("nome_dia"),
        weekday.isin(0, 6).alias("fim_de_semana"),
    )


# Columns of the reference's fact table, in order.
FACT_COLUMNS = [
    "numero_pedido", "sequencia_item", "sk_tempo", "sk_cliente", "sk_produto", "sk_vendedor", "tipo_operacao",
    "quantidade", "preco_unitario", "desconto_pct", "receita_mercadoria", "receita_total", "custo_produto",
    "custo_entrega", "custo_comissao", "frete_subsidiado", "margem_bruta", "margem_contribuicao", "custo_confiavel",
]
# Dimension attributes carried on every fact row (see ``fact_sales``).
PRODUCT_ATTRIBUTES = ["codigo_produto", "descricao", "categoria"]
CUSTOMER_ATTRIBUTES = ["codigo_cliente", "razao_social", "segmento", "regiao"]
SELLER_ATTRIBUTES = ["nome_vendedor", "taxa_comissao"]
DATE_ATTRIBUTES = ["data", "ano_mes"]
# The fact is stored by month.
MONTH = "ano_mes"


def fact_sales(m: "Model") -> DataFrame:
    """one row per kept order item with the additive measures.

    Product and seller are inner joins (unknown product or seller code leaves the fact), the
    customer is a left join falling back to member 0.  The date key is computed from the date:
    the date dimension spans every sale date, so that join always matches and is not needed.
    A dimension is broadcast when its measured size allows; otherwise the join shuffles, with hot
    codes and sales without a code dealt over many tasks.  Which codes are hot was found for all
    three joins while the staged sales were written, so they are read once.

    The table written has the reference's fact columns plus the attributes of the very
    dimension rows it points to (member 0's for unknown customers; the day and month of the
    date key).  They ride along in the joins the fact needs anyway, and spare every analysis a
    join back to a dimension, some of which may be too large to broadcast: the analyses and
    the panel read one table.  ``fact_columns`` gives the reference's column list.
    """
    j = m["stg_vendas"]
    for name, key, columns, how in (
        ("dim_produto", "codigo_produto", ["sk_produto", "custo_unitario", "custo_confiavel", *PRODUCT_ATTRIBUTES], "inner"),
        ("dim_vendedor", "cod_vendedor", ["cod_vendedor", "sk_vendedor", *SELLER_ATTRIBUTES], "inner"),
        ("dim_cliente", "codigo_cliente", ["sk_cliente", *CUSTOMER_ATTRIBUTES], "left"),
    ):
        dim = m[name].select(*columns)
        if m.is_small(name, columns):
            j = j.join(F.broadcast(dim), key, how)
        else:
            j = join_dealt(j, dim, key, ["numero_pedido", "sequencia_item"], how, m.hot_codes(key))

    price, qty = F.col("preco_unitario"), F.col("quantidade")
    cost, rate = F.col("custo_unitario"), F.col("taxa_comissao")
    freight, delivery = F.col("frete_cobrado"), F.col("custo_frete_real")
    goods = price * qty
    reliable = F.col("custo_confiavel")
    known = F.col("sk_cliente").isNotNull()
    return j.select(
        "numero_pedido",
        "sequencia_item",
        date_key(F.col("data_pedido")).alias("sk_tempo"),
        F.coalesce(F.col("sk_cliente"), F.lit(UNKNOWN_CUSTOMER[0]).cast("bigint")).alias("sk_cliente"),
        "sk_produto",
        "sk_vendedor",
        "tipo_operacao",
        "quantidade",
        "preco_unitario",
        "desconto_pct",
        r2(goods).alias("receita_mercadoria"),
        r2(goods + freight).alias("receita_total"),
        r2(cost * qty).alias("custo_produto"),
        r2(delivery).alias("custo_entrega"),
        r2(goods * rate).alias("custo_comissao"),
        r2(delivery - freight).alias("frete_subsidiado"),
        F.when(reliable, r2(goods - cost * qty)).alias("margem_bruta"),
        F.when(reliable, r2(goods + freight - cost * qty - delivery - goods * rate)).alias("margem_contribuicao"),
        reliable.alias("custo_confiavel"),
        *PRODUCT_ATTRIBUTES,
        F.when(known, F.col("codigo_cliente")).otherwise(F.lit(UNKNOWN_CUSTOMER[1])).alias("codigo_cliente"),
        F.when(known, F.col("razao_social")).otherwise(F.lit(UNKNOWN_CUSTOMER[2])).alias("razao_social"),
        F.when(known, F.col("segmento")).alias("segmento"),
        F.when(known, F.col("regiao")).alias("regiao"),
        *SELLER_ATTRIBUTES,
        F.col("data_pedido").alias("data"),
        F.date_format("data_pedido", "yyyy-MM").alias("ano_mes"),
    )


def fact_columns(fact: DataFrame) -> DataFrame:
    """The fact with exactly the reference's columns (a projection: only those are read)."""
    return fact.select(*FACT_COLUMNS)


# Codes by which the staged sales are joined.
JOIN_CODES = ["codigo_produto", "cod_vendedor", "codigo_cliente"]


class Model(dict):
    """Named DataFrames of one build: raw, staging, dimensions and fact.

    ``sizes`` holds the measured rows and text bytes of the dimensions; ``metrics`` what was counted
    while the staging tables were written, by raw table (empty for a lazy model); ``memo`` and
    ``exports`` results that later questions share; ``folder`` is where the build wrote its tables;
    ``passes`` in how many parts the sales are worked through (see ``pass_count``).
    """

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.sizes: dict[str, tuple[int, dict[str, int]]] = {}
        self.metrics: dict[str, dict] = {}
        self.memo: dict[str, DataFrame] = {}
        self.exports: dict[str, dict] = {}
        self.lock = threading.Lock()
        self.folder: str | None = None
        self.passes = 1

    def is_small(self, name: str, columns: Sequence[str]) -> bool:
        """Whether the columns of a table may be broadcast, by its measured size."""
        if name not in self.sizes:
            self.sizes[name] = measured(self[name])
        return fits_broadcast(self[name].select(*columns), *self.sizes[name])

    def hot_codes(self, key: str) -> list[tuple[str, int]] | None:
        """Hot codes of a join of the staged sales, if they were counted (see ``join_dealt``)."""
        seen = self.metrics.get("raw_vendas")
        if seen is None:
            return None
        return hot_keys(self["stg_vendas"].sparkSession, seen[f"top_{key}"], seen["kept"])


_CACHE: dict[tuple, Model] = {}
_KEY_LOCKS: dict[tuple, threading.Lock] = {}
_LOCK = threading.Lock()


def build_model(spark: SparkSession, sf_dir: str, materialized: bool = True, reuse: bool = True) -> Model:
    """Model of the raw exports projected from the test tables in ``sf_dir``.

    Built once per session, state of the input files and settings (``reuse``); see
    ``build_model_from_raw``.  Two callers that ask for the same model at once build it once; other
    keys are not held up.
    """
    if not reuse:
        return build_model_from_raw(spark, raw_tables(spark, sf_dir), materialized)
    state = files_digest(spark, [table_path(sf_dir, t) for t in TABLES])
    key = (app_id(spark), sf_dir, str(materialized), *_settings(spark), *state)
    with _LOCK:
        own = _KEY_LOCKS.setdefault(key, threading.Lock())
    with own:
        if key not in _CACHE:
            _CACHE[key] = build_model_from_raw(spark, raw_tables(spark, sf_dir), materialized)
        return _CACHE[key]


def _settings(spark: SparkSession) -> list[str]:
    """Settings that change how a model is built."""
    names = (
        "spark.ledgerline.broadcastMaxRows", "spark.ledgerline.broadcastMaxBytes", "spark.ledgerline.passBytes",
        "spark.sql.shuffle.partitions",
    )
    return [str(spark.conf.get(n, None)) for n in names]


def build_model_from_raw(spark: SparkSession, raw: dict[str, DataFrame], materialized: bool = True) -> Model:
    """Run the whole modelling job on three raw exports (``raw_vendas``, ``raw_produtos``,
    ``raw_clientes``; all text, e.g. from ``sources.io.read_raw_exports``).

    With ``materialized`` the deduplicated sales, the four dimensions and the fact are written
    under the shared scratch folder (the reference also stores them as tables) and every later
    query reads those files: the dedupe shuffle runs once, a lost executor costs a re-read
    instead of a recomputation, and scans of the fact get column pruning and filter pushdown.
    Without it everything stays a lazy plan (used by tests).

    The deduplicated sales and the fact are made in up to eight passes, by a hash of the item and of
    the order: a pass shuffles its part of the rows, and its shuffle files are gone before the next.
    Each pass reads the files of the sales export again.
    """
    m = Model(raw)
    root = m.folder = new_scratch_dir(spark, "model") if materialized else None
    m.passes = pass_count(m["raw_vendas"]) if materialized else 1

    def keep(df: DataFrame, name: str) -> DataFrame:
        return df if root is None else materialize_passes([df], f"{root}/{name}")

    def keep_fact(df: DataFrame) -> DataFrame:
        """The fact in a folder a month, its rows by order.

        The exchange before the write brings a month's rows together, so folders get few files;
        adaptive execution splits the months that are large (and with them a very large order, which
        buckets by order would leave to one task).  The items of an order lie side by side, so the
        analyses that count orders combine them in the task that reads them, and one row of an order
        and group is all that is shuffled.  An order is in one pass.
        """
        if root is None:
            return df
        parts = in_passes(df, ["numero_pedido"], m.passes)
        rows = (p.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "numero_pedido", "sequencia_item") for p in parts)
        return materialize_passes(rows, f"{root}/fct_vendas", [MONTH])

    def keep_watched(stage, lazy, raw: str, name: str, extra: dict, key: Sequence[str] = (), passes: int = 1) -> DataFrame:
        """A staging table, written with its metrics collected by the write."""
        if root is None:
            return lazy(m[raw])
        watch = Watched()
        kept = materialize_passes((stage(p, watch, extra) for p in in_passes(m[raw], key, passes)), f"{root}/{name}")
        m.metrics[raw] = watch.read()
        return kept

    # Three independent chains (sales, products, customers) are submitted side by side: Spark
    # runs their jobs concurrently, so the small dimension jobs fill cores the sales job leaves
    # idle.  The raw exports are not copied: staging reads them once, and counts what the checks
    # and the fact's joins want to know of them.
    def sales_chain() -> None:
        extra = {"kept": F.count(F.lit(1)), "returns": F.count_if(F.col("tipo_operacao") == "DEVOLUCAO")}
        extra |= {f"top_{code}": frequent(spark, code) for code in JOIN_CODES}
        m["stg_vendas"] = keep_watched(stage_sales, stg_sales, "raw_vendas", "stg_vendas", extra, SALES_KEY, m.passes)
        # One pass over the sales gives both the seller codes and the date span.
        span = keep(
            m["stg_vendas"].groupBy("cod_vendedor").agg(
                F.min("data_pedido").alias("primeira"), F.max("data_pedido").alias("ultima")
            ),
            "seller_span",
        )
        with ThreadPoolExecutor(max_workers=2, thread_name_prefix="model-span") as side:
            seller = side.submit(lambda: keep(dim_seller(span), "dim_vendedor"))
            dates = side.submit(lambda: keep(dim_date(span, "primeira", "ultima"), "dim_tempo"))
            m["dim_vendedor"], m["dim_tempo"] = seller.result(), dates.result()
        m.sizes["dim_vendedor"] = measured(m["dim_vendedor"])

    def product_chain() -> None:
        extra = {"no_cost": F.count_if(F.col("custo_unitario").isNull())}
        stage = lambda raw, watch, e: stage_plain(raw, "raw_produtos", stg_products, watch, e)
        m["stg_produtos"] = keep_watched(stage, stg_products, "raw_produtos", "stg_produtos", extra)
        m["dim_produto"] = keep(dim_product(m["stg_produtos"]), "dim_produto")
        m.sizes["dim_produto"] = measured(m["dim_produto"])

    def customer_chain() -> None:
        stage = lambda raw, watch, e: stage_plain(raw, "raw_clientes", stg_customers, watch, e)
        m["stg_clientes"] = keep_watched(stage, stg_customers, "raw_clientes", "stg_clientes", {})
        m["dim_cliente"] = keep(dim_customer(m["stg_clientes"]), "dim_cliente")
        m.sizes["dim_cliente"] = measured(m["dim_cliente"])

    with ThreadPoolExecutor(max_workers=3, thread_name_prefix="model") as pool:
        for f in [pool.submit(c) for c in (sales_chain, product_chain, customer_chain)]:
            f.result()
    m["fct_vendas"] = keep_fact(fact_sales(m))
    return m


def forget_models() -> None:
    """Drop the cached models and the folders that their builds wrote."""
    with _LOCK:
        gone = list(_CACHE.values())
        _CACHE.clear()
        _KEY_LOCKS.clear()
    for m in gone:
        if m.folder:
            remove_folder(m["fct_vendas"].sparkSession, m.folder)
