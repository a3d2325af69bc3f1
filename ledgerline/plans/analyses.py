"""The ten business analyses over the star schema (A1-A10).

Every analysis reads only fact rows whose product cost is known (``custo_confiavel``); that
filter reaches the Parquet scan of the materialised fact.  Dimension attributes are read from
the fact itself (it carries those of the dimension rows it points to), so no analysis joins
back to a dimension: each one is a pruned scan of one table and an aggregation.  Money is summed exactly
and rounded the reference's way at the end (see ``functions.numeric``).  Windows that run over one
row per category, discount band, month or seller stay plain; the ABC curve runs over one row per
customer and uses the ordered scan instead.

An analysis is a set of totals by some columns, and a sheet made of them.  The report export makes
five sheets of one pass over the fact, by grouping sets (``report_views``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import RATE, exact_mean, exact_sum, grand_total, pct, r1, r2, ratio, total, total_of_both
from ..operators.ordered import ordered_scan
from ..session import new_scratch_dir
from ..sources.scratch import in_passes, materialize, remove_folder, shuffles_removed
from .model import UNKNOWN_CUSTOMER, Model


def _reliable(m: Model) -> DataFrame:
    return m["fct_vendas"].filter(F.col("custo_confiavel"))


def _share_of_total(col: str) -> F.Column:
    """Percentage of the sum over all rows of a small grouped result."""
    return pct(total(col), grand_total(col))


def _discounts() -> list[F.Column]:
    """Sum and count of the discounts, for their mean."""
    return [exact_sum("desconto_pct", RATE).alias("ds"), F.count("desconto_pct").alias("dn")]


# Totals by name -> the amount that is summed exactly.
_AMOUNTS = {
    "rt": "receita_total", "cp": "custo_produto", "ce": "custo_entrega", "cc": "custo_comissao", "fs": "frete_subsidiado",
    "mb": "margem_bruta", "mc": "margem_contribuicao",
}


def _totals(*names: str) -> list[F.Column]:
    """Totals by name: an amount's sum, ``charged`` freight, ``pedidos`` (orders), ``itens`` (lines),
    ``discounts`` (their sum and count)."""
    out = []
    for name in names:
        if name == "pedidos":
            out.append(F.count_distinct("numero_pedido").alias(name))
        elif name == "itens":
            out.append(F.count(F.lit(1)).alias(name))
        elif name == "discounts":
            out += _discounts()
        elif name == "charged":
            out.append(exact_sum(F.col("custo_entrega") - F.col("frete_subsidiado")).alias(name))
        else:
            out.append(exact_sum(_AMOUNTS[name]).alias(name))
    return out


def _situation(margin: F.Column, revenue: F.Column) -> F.Column:
    share = ratio(F.lit(100.0) * margin, revenue)
    return (
        F.when(margin < 0, F.lit("Prejuizo"))
        .when(share < 10, F.lit("Critica"))
        .when(share < 20, F.lit("Atencao"))
        .otherwise(F.lit("Saudavel"))
    )


_OF_CATEGORY = ["pedidos", "rt", "cp", "ce", "cc", "fs", "mb", "mc"]


def margin_by_category(m: Model) -> DataFrame:
    """A1: where margin is made and lost, per product category."""
    return _category_sheet(_reliable(m).groupBy("categoria").agg(*_totals(*_OF_CATEGORY)))


def _category_sheet(g: DataFrame) -> DataFrame:
    return g.select(
        "categoria",
        "pedidos",
        r2(total("rt")).alias("receita"),
        r2(total("cp")).alias("custo_produto"),
        r2(total("ce")).alias("custo_entrega"),
        r2(total("cc")).alias("custo_comissao"),
        r2(total("fs")).alias("frete_subsidiado"),
        r2(total("mb")).alias("margem_bruta"),
        r2(total("mc")).alias("margem_contribuicao"),
        pct(total("mc"), total("rt")).alias("margem_pct"),
        _share_of_total("rt").alias("participacao_pct"),
        _situation(total("mc"), total("rt")).alias("situacao"),
    ).orderBy("margem_contribuicao")


def margin_waterfall(m: Model) -> DataFrame:
    """A2: revenue down to contribution margin in five ordered steps (one scan, one row -> five)."""
    t = _reliable(m).agg(
        exact_sum("receita_total").alias("receita"),
        exact_sum("custo_produto").alias("mercadoria"),
        exact_sum("custo_entrega").alias("entrega"),
        exact_sum("custo_comissao").alias("comissao"),
        exact_sum("margem_contribuicao").alias("margem"),
    )
    steps = [
        ("Receita", total("receita")), ("Mercadoria", -total("mercadoria")), ("Entrega", -total("entrega")),
        ("Comissao", -total("comissao")), ("Margem", total("margem")),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("ordem"), F.lit(n).alias("etapa"), v.alias("valor")) for i, (n, v) in enumerate(steps, 1)])
    return t.select(F.inline(rows)).select(F.col("ordem").cast("int").alias("ordem"), "etapa", r2("valor").alias("valor")).orderBy("ordem")


ABC_GROUP = ["codigo_cliente", "razao_social", "segmento", "regiao"]


_OF_CUSTOMER = ["pedidos", "rt", "mc", "fs", "discounts"]


def _known_customer() -> F.Column:
    return F.col("codigo_cliente") != F.lit(UNKNOWN_CUSTOMER[1])


def customer_totals(m: Model) -> DataFrame:
    """Per-customer totals behind A3 (orphan member excluded)."""
    rows = _reliable(m).filter(_known_customer())
    of = lambda fact: fact.groupBy(*ABC_GROUP).agg(*_totals(*_OF_CUSTOMER))
    return of(rows) if m.passes == 1 else _added([p for p, _ in _written_parts(m, rows, of, "customer-totals")], ABC_GROUP)


def _written_parts(m: Model, fact: DataFrame, of: Callable[[DataFrame], DataFrame], name: str) -> list[tuple[DataFrame, str]]:
    """Totals of the fact, written part by part in the model's passes (by order, which is in one of
    them), with their folders.

    To count orders, a row for each order and group is shuffled, which can be several times the
    input; a part's shuffle files are gone before the next is summed up."""
    spark, out = fact.sparkSession, []
    with shuffles_removed(spark):
        for rows in in_passes(fact, ["numero_pedido"], m.passes):
            folder = new_scratch_dir(spark, name)
            out.append((materialize(of(rows), name, folder), folder))
    return out


def _added(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Totals of parts of the fact added up by group."""
    rows = reduce(DataFrame.unionByName, parts)
    sums = [
        F.struct(F.sum(f"{c}.whole").cast("decimal(38,0)").alias("whole"), F.sum(f"{c}.rest").alias("rest")).alias(c)
        if kind.startswith("struct") else F.sum(c).alias(c)
        for c, kind in rows.dtypes if c not in keys
    ]
    return rows.groupBy(*keys).agg(*sums).select(parts[0].columns)


def customer_abc(m: Model) -> DataFrame:
    """A3: ABC curve of customers by revenue, crossed with profitability.

    Position and running share come from the ordered scan over the per-customer totals.  Revenue
    ties are broken by the customer columns so positions are reproducible.
    """
    if "customer_abc" not in m.memo:
        m.memo["customer_abc"] = _customer_sheet(customer_totals(m))
    return m.memo["customer_abc"]


def _customer_sheet(customers: DataFrame) -> DataFrame:
    receita, margem = total("rt"), total("mc")
    per_customer = customers.withColumns(
        {"receita": receita, "rt_whole": F.col("rt.whole"), "rt_rest": F.col("rt.rest")}
    )
    order = [("receita", True)] + [(c, False) for c in ABC_GROUP]
    parts = {"whole": "rt_whole", "rest": "rt_rest"}
    scanned = ordered_scan(
        per_customer, order, number="posicao",
        running={f"acum_{k}": c for k, c in parts.items()}, totals={f"todos_{k}": c for k, c in parts.items()},
    )
    both = lambda name: total(F.struct(*[F.col(f"{name}_{k}").alias(k) for k in parts]))
    share = ratio(both("acum"), both("todos"))
    return scanned.select(
        "posicao",
        "razao_social",
        "segmento",
        "regiao",
        "pedidos",
        r2("receita").alias("receita"),
        r2(F.try_divide(F.col("receita"), F.col("pedidos"))).alias("ticket_medio"),
        r2(margem).alias("margem"),
        pct(margem, F.col("receita")).alias("margem_pct"),
        r2(total("fs")).alias("frete_subsidiado"),
        r1(exact_mean("ds", "dn")).alias("desconto_medio"),
        r1(F.lit(100.0) * share).alias("receita_acumulada_pct"),
        F.when(share <= 0.80, F.lit("A")).when(share <= 0.95, F.lit("B")).otherwise(F.lit("C")).alias("classe_abc"),
    ).orderBy("posicao")


def critical_customers(m: Model) -> DataFrame:
    """A4: A/B customers whose (rounded) margin % is below the portfolio's (unrounded) margin %.

    The portfolio margin is a one-row aggregate used as a scalar subquery (computed once, no
    join), carried as a column so every expression reads the same value.
    """
    portfolio = _reliable(m).agg(
        F.lit(100.0) * total(exact_sum("margem_contribuicao")) / F.nullif(total(exact_sum("receita_total")), F.lit(0.0))
    ).scalar()
    pf = F.col("margem_carteira")
    a = (
        customer_abc(m)
        .withColumn("margem_carteira", portfolio)
        .filter(F.col("classe_abc").isin("A", "B") & (F.col("margem_pct") < pf))
    )
    return a.select(
        "classe_abc",
        "razao_social",
        "segmento",
        "receita",
        "margem",
        "margem_pct",
        r1(pf).alias("margem_carteira_pct"),
        r1(F.col("margem_pct") - pf).alias("diferenca_pp"),
        "desconto_medio",
        r2(F.col("receita") * (pf - F.col("margem_pct")) / F.lit(100)).alias("margem_nao_realizada"),
    ).orderBy(F.col("margem_nao_realizada").desc_nulls_last())


def discount_band(d: F.Column) -> F.Column:
    # Fixed band labels of the reference.
    return (
        F.when(d < 5, F.lit("1. ate 5%"))
        .when(d < 10, F.lit("2. 5 a 10%"))
        .when(d < 15, F.lit("3. 10 a 15%"))
        .when(d < 20, F.lit("4. 15 a 20%"))
        .otherwise(F.lit("5. acima de 20%"))
    )


_OF_BAND = ["itens", "rt", "mc"]


def discount_bands(m: Model) -> DataFrame:
    """A5: revenue and margin by discount band (NULL discount falls in the last band)."""
    return _band_sheet(_reliable(m).groupBy(discount_band(F.col("desconto_pct")).alias("faixa")).agg(*_totals(*_OF_BAND)))


def _band_sheet(g: DataFrame) -> DataFrame:
    return g.select(
        "faixa",
        "itens",
        r2(total("rt")).alias("receita"),
        _share_of_total("rt").alias("participacao_pct"),
        r2(total("mc")).alias("margem"),
        pct(total("mc"), total("rt")).alias("margem_pct"),
    ).orderBy("faixa")


_OF_FREIGHT = ["rt", "ce", "charged", "fs", "mc"]


def freight_subsidy(m: Model) -> DataFrame:
    """What free freight costs, per category."""
    return _freight_sheet(_reliable(m).groupBy("categoria").agg(*_totals(*_OF_FREIGHT)))


def _freight_sheet(g: DataFrame) -> DataFrame:
    return g.select(
        "categoria",
        r2(total("rt")).alias("receita"),
        r2(total("ce")).alias("custo_entrega"),
        r2(total("charged")).alias("frete_cobrado"),
        r2(total("fs")).alias("frete_absorvido"),
        pct(total("fs"), total("rt")).alias("absorvido_sobre_receita_pct"),
        r2(total("mc")).alias("margem"),
        r2(total_of_both("mc", "fs")).alias("margem_sem_subsidio"),
    ).orderBy(F.col("frete_absorvido").desc_nulls_last())


_OF_MONTH = ["pedidos", "rt", "mc", "fs"]


def monthly_trend(m: Model) -> DataFrame:
    """Month by month, with change over the previous month that had sales and a 3-month mean."""
    return _month_sheet(_reliable(m).groupBy("ano_mes").agg(*_totals(*_OF_MONTH)))


def _month_sheet(g: DataFrame) -> DataFrame:
    w = Window.orderBy("ano_mes")
    receita, margem = total("rt"), total("mc")
    prev_r, prev_m = F.lag(receita).over(w), F.lag(margem).over(w)
    monthly_pct = F.lit(100.0) * margem / F.nullif(receita, F.lit(0.0))
    return g.select(
        "ano_mes",
        "pedidos",
        r2(receita).alias("receita"),
        r2(F.try_divide(receita, F.col("pedidos"))).alias("ticket_medio"),
        r2(margem).alias("margem"),
        pct(margem, receita).alias("margem_pct"),
        r2(total("fs")).alias("frete_absorvido"),
        r1(F.lit(100.0) * (receita - prev_r) / F.nullif(prev_r, F.lit(0.0))).alias("var_receita_pct"),
        r1(F.lit(100.0) * (margem - prev_m) / F.nullif(F.abs(prev_m), F.lit(0.0))).alias("var_margem_pct"),
        r1(F.avg(monthly_pct).over(w.rowsBetween(-2, Window.currentRow))).alias("margem_pct_media_3m"),
    ).orderBy("ano_mes")


def loss_products(m: Model) -> DataFrame:
    """Products that sell (revenue over 1000) and lose money."""
    g = _reliable(m).groupBy("codigo_produto", "descricao", "categoria").agg(
        F.sum(F.col("quantidade").cast("bigint")).alias("quantidade"),
        exact_sum("receita_total").alias("rt"),
        exact_sum("margem_bruta").alias("mb"),
        exact_sum("margem_contribuicao").alias("mc"),
        *_discounts(),
        exact_sum("frete_subsidiado").alias("fs"),
    )
    return g.filter((total("mc") < 0) & (total("rt") > 1000)).select(
        "codigo_produto",
        "descricao",
        "categoria",
        "quantidade",
        r2(total("rt")).alias("receita"),
        r2(total("mb")).alias("margem_bruta"),
        r2(total("mc")).alias("margem_contribuicao"),
        pct(total("mc"), total("rt")).alias("margem_pct"),
        r1(exact_mean("ds", "dn")).alias("desconto_medio"),
        r2(total("fs")).alias("frete_absorvido"),
    ).orderBy("margem_contribuicao")


def seller_performance(m: Model) -> DataFrame:
    """The sales team, grouped by seller name and rate (unknown codes fold together)."""
    g = _reliable(m).groupBy(
        "nome_vendedor", r1(F.lit(100.0) * F.col("taxa_comissao")).alias("taxa_comissao_pct")
    ).agg(
        F.count_distinct("numero_pedido").alias("pedidos"),
        exact_sum("receita_total").alias("rt"),
        *_discounts(),
        exact_sum("custo_comissao").alias("cc"),
        exact_sum("margem_contribuicao").alias("mc"),
    )
    receita, margem = total("rt"), total("mc")
    return g.select(
        "nome_vendedor",
        "taxa_comissao_pct",
        "pedidos",
        r2(receita).alias("receita"),
        r2(F.try_divide(receita, F.col("pedidos"))).alias("ticket_medio"),
        r1(exact_mean("ds", "dn")).alias("desconto_medio"),
        r2(total("cc")).alias("comissao_paga"),
        r2(margem).alias("margem"),
        pct(margem, receita).alias("margem_pct"),
        F.rank().over(Window.orderBy(receita.desc_nulls_last())).cast("bigint").alias("posicao_receita"),
        F.rank()
        .over(Window.orderBy((margem / F.nullif(receita, F.lit(0.0))).desc_nulls_last()))
        .cast("bigint")
        .alias("posicao_margem"),
    ).orderBy(F.col("margem").desc_nulls_last())


def panel(m: Model) -> DataFrame:
    """A10: item-grain panel with every dimension resolved (reliable cost only)."""
    return _reliable(m).select(
        "data", "ano_mes", "numero_pedido", F.col("razao_social").alias("cliente"), "segmento", "regiao",
        F.col("nome_vendedor").alias("vendedor"), F.col("descricao").alias("produto"), "categoria",
        "tipo_operacao", "quantidade", "desconto_pct", "receita_total", "custo_produto", "custo_entrega",
        "custo_comissao", "frete_subsidiado", "margem_contribuicao",
    )


_REPORT_SETS = {"categoria": ["categoria"], "ano_mes": ["ano_mes"], "faixa": ["faixa"], "cliente": ABC_GROUP}
_REPORT_KEYS = [c for columns in _REPORT_SETS.values() for c in columns]


def report_totals(m: Model) -> dict[str, DataFrame]:
    """The totals of the report sheets by category, month, discount band and customer, from one pass over
    the fact: its rows are grouped by every set of columns at once, and the (small) result is
    written and split.

    A model that was made in passes is summed up in as many, and their totals are added."""
    if "report_totals" not in m.memo:
        if m.folder:
            parts = _written_parts(m, _reliable(m), _of_all_sets, "report-totals")
            whole = parts[0][0]
            if len(parts) > 1:
                with shuffles_removed(whole.sparkSession):
                    whole = materialize(_added([p for p, _ in parts], [*_REPORT_KEYS, "__set"]), "report-totals")
                for _, folder in parts:
                    remove_folder(whole.sparkSession, folder)
            m.memo["report_totals"] = whole
        else:
            m.memo["report_totals"] = _of_all_sets(_reliable(m))
    out = {}
    for name, columns in _REPORT_SETS.items():
        # A bit for every column that the set leaves out, the first column's the highest.
        number = sum(1 << (len(_REPORT_KEYS) - 1 - i) for i, c in enumerate(_REPORT_KEYS) if c not in columns)
        left_out = [c for c in _REPORT_KEYS if c not in columns]
        out[name] = m.memo["report_totals"].filter(F.col("__set") == number).drop("__set", *left_out)
    return out


def _of_all_sets(fact: DataFrame) -> DataFrame:
    """Totals of fact rows by every set of columns of the report sheets; ``__set`` is the set's number."""
    names = dict.fromkeys([*_OF_CATEGORY, *_OF_FREIGHT, *_OF_MONTH, *_OF_BAND, *_OF_CUSTOMER])
    sets = [[F.col(c) for c in columns] for columns in _REPORT_SETS.values()]
    rows = fact.withColumn("faixa", discount_band(F.col("desconto_pct")))
    return rows.groupingSets(sets, *[F.col(c) for c in _REPORT_KEYS]).agg(F.grouping_id().alias("__set"), *_totals(*names))


def report_views(m: Model) -> dict[str, DataFrame]:
    """The six sheets of the report export: the panel, and five that share one pass over the fact."""
    of = report_totals(m)
    if "customer_abc" not in m.memo:
        m.memo["customer_abc"] = _customer_sheet(of["cliente"].filter(_known_customer()))
    return {
        "painel": panel(m),
        "por_categoria": _category_sheet(of["categoria"]),
        "por_mes": _month_sheet(of["ano_mes"]),
        "por_desconto": _band_sheet(of["faixa"]),
        "clientes": customer_abc(m),
        "frete": _freight_sheet(of["categoria"]),
    }
