"""Raw ERP exports projected from the TPC-H-like test tables.

The reference loads three dirty CSV exports (sales items, products, customers) with every column
as text.  Those files are not available, so the same three tables are derived here from the given
parquet tables with deterministic rules that exercise every cleaning branch: three money formats,
three date formats (two-digit years included), padded and blank text, NULL codes, cancelled items,
negative quantities (returns), disagreeing copies of one order item, and sales whose product or
customer code is in no other export.

All money is handled as integer cents so the rendered text is identical in every engine.
Everything here is a map-side projection except the sales/orders join on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The test tables that the exports are projected from.
TABLES = ["lineitem", "orders", "part", "customer", "nation", "region"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def idiv(a: Column, b: Column | int) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _cents(value: Column) -> Column:
    return F.round(value * F.lit(100.0)).cast("bigint")


def plain_money(cents: Column) -> Column:
    """Non-negative cents -> ``1234.56``."""
    return F.concat(idiv(cents, 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def signed_money(cents: Column) -> Column:
    """Cents -> ``-1234.56`` (sign written in front of the absolute value)."""
    return F.concat(F.when(cents < 0, F.lit("-")).otherwise(F.lit("")), plain_money(F.abs(cents)))


def styled_money(cents: Column, style: Column) -> Column:
    """Cents rendered in one of three styles: 0 ``R$ 1.234,56``, 1 ``1234,56``, 2 ``1234.56``."""
    whole = idiv(cents, 100)
    frac = F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.translate(F.format_number(whole, 0), ",", ".")
    return (
        F.when(style == 0, F.concat(F.lit("R$ "), grouped, F.lit(","), frac))
        .when(style == 1, F.concat(whole.cast("string"), F.lit(","), frac))
        .otherwise(F.concat(whole.cast("string"), F.lit("."), frac))
    )


def styled_date(day: Column, style: Column) -> Column:
    """Date rendered as 0 ``dd/MM/yyyy``, 1 ``yyyy-MM-dd``, 2 ``dd-MM-yy``."""
    return (
        F.when(style == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(style == 1, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "dd-MM-yy"))
    )


def _code(prefix: str, key: Column) -> Column:
    """``prefix`` + key left-padded to six digits (longer keys are kept whole)."""
    s = key.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) >= 6, s).otherwise(F.lpad(s, 6, "0")))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_vendas``: one text row per lineitem (order key and line number repeat in the data)."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Orders grow with the sales: joined by a shuffle at every size, never broadcast.
    j = li.join(orders.hint("merge"), li.l_orderkey == orders.o_orderkey)

    qty = F.col("l_quantity").cast("bigint")
    cents = _cents(F.col("l_extendedprice"))
    dk = F.round(F.col("l_discount") * F.lit(100.0)).cast("bigint")
    tk = F.round(F.col("l_tax") * F.lit(100.0)).cast("bigint")
    order_day = F.to_date(F.col("o_orderdate"))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 4 == 0)

    return j.select(
        F.col("l_orderkey").cast("string").alias("numero_pedido"),
        F.col("l_linenumber").cast("string").alias("sequencia_item"),
        F.when((F.col("o_orderkey") + F.col("l_suppkey")) % 97 == 0, F.lit("n/d"))
        .otherwise(styled_date(order_day, F.col("o_orderkey") % 3)).alias("data_pedido"),
        F.when((F.col("l_partkey") + F.col("l_suppkey")) % 29 == 0, F.lit(None).cast("string"))
        .when(F.col("o_custkey") % 50 == 7, _code("X", F.col("o_custkey")))
        .otherwise(_code("C", F.col("o_custkey"))).alias("codigo_cliente"),
        F.when(F.col("l_partkey") % 50 == 9, _code("X", F.col("l_partkey")))
        .otherwise(_code("P", F.col("l_partkey"))).alias("codigo_produto"),
        F.when(returned, -qty).otherwise(qty).cast("string").alias("quantidade"),
        styled_money(idiv(cents, qty), F.col("l_partkey") % 3).alias("preco_unitario"),
        plain_money(dk * 250).alias("desconto_pct"),
        plain_money(idiv(cents * tk, 200)).alias("frete_cobrado"),
        plain_money(idiv(cents * 4, 100)).alias("custo_frete_real"),
        F.when(F.col("l_suppkey") % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" V0"), (F.col("l_suppkey") % 5).cast("string"))).alias("vendedor"),
        F.when((F.col("o_orderkey") + F.col("l_partkey")) % 11 == 0, F.lit(" Cancelado "))
        .otherwise(F.lit("faturado")).alias("status"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_produtos``: one row per part."""
    part = _table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    price = _cents(F.col("p_retailprice"))
    ptype = F.col("p_type")
    # Cost factor (in quarters of the list price) by product family; fixed fixture values.
    factor = (
        F.when(ptype == "PROMO", 6)
        .when(ptype == "SMALL", 2)
        .when(ptype == "ECONOMY", 3)
        .otherwise(4)
    ).cast("bigint")
    cost = idiv(price * (factor + 2 * (key % 5)), 4)
    return part.select(
        _code("P", key).alias("codigo_produto"),
        F.concat(F.lit(" "), F.replace(F.col("p_name"), F.lit(" "), F.lit("  ")), F.lit(" ")).alias("descricao"),
        ptype.alias("categoria"),
        F.col("p_brand").alias("unidade"),
        F.when(key % 20 == 3, F.lit(None).cast("string")).otherwise(plain_money(cost)).alias("custo_unitario"),
        styled_money(price, key % 3).alias("preco_tabela"),
        F.when(key % 2 == 0, F.lit(" s ")).otherwise(F.lit("N")).alias("ativo"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_clientes``: one row per customer with region name."""
    cust = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(region, F.col("n_regionkey") == region.r_regionkey)
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 14, "0")
    cnpj = F.concat(
        F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 3), F.lit("."), F.substring(digits, 6, 3),
        F.lit("/"), F.substring(digits, 9, 4), F.lit("-"), F.substring(digits, 13, 2),
    )
    since = F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int"))
    return j.select(
        _code("C", key).alias("codigo_cliente"),
        F.col("c_name").alias("razao_social"),
        F.when(key % 13 == 0, F.lit("")).otherwise(cnpj).alias("cnpj"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("r_name").alias("regiao"),
        F.concat(F.lit(" V0"), (key % 5).cast("string")).alias("vendedor"),
        styled_date(since, key % 3).alias("data_cadastro"),
        signed_money(_cents(F.col("c_acctbal"))).alias("limite_credito"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "raw_vendas": raw_sales(spark, sf_dir),
        "raw_produtos": raw_products(spark, sf_dir),
        "raw_clientes": raw_customers(spark, sf_dir),
    }
