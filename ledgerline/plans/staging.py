"""Staging jobs (T1-T4): typed, cleaned views of the three raw exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.cleaning import (
    cast_text, digits_only, flag_yes, norm_txt, number_text, parse_date, parse_int, parse_number, strict_int, to_int_like_cast,
    trim_spaces,
)
from ..operators.dedupe import dedupe_and_sum, dedupe_by_key

SALES_KEY = ["numero_pedido", "sequencia_item"]

# Every raw sales column after the key, in the order used to break ties between copies.
SALES_TIEBREAK = [
    "codigo_cliente", "codigo_produto", "preco_unitario", "quantidade", "desconto_pct",
    "frete_cobrado", "custo_frete_real", "vendedor", "data_pedido", "status",
]


# Which rule converts the (prepared) text of which raw column.
PARSED_COLUMNS: dict[str, dict[str, Callable]] = {
    "raw_vendas": {
        "numero_pedido": parse_int,
        "sequencia_item": parse_int,
        "data_pedido": parse_date,
        "quantidade": parse_int,
        "preco_unitario": parse_number,
        "desconto_pct": parse_number,
        "frete_cobrado": parse_number,
        "custo_frete_real": parse_number,
    },
    "raw_produtos": {"custo_unitario": parse_number, "preco_tabela": parse_number},
    "raw_clientes": {"cnpj": digits_only, "data_cadastro": parse_date, "limite_credito": parse_number},
}
_CLEANED = {parse_number: number_text, parse_date: trim_spaces, parse_int: cast_text}


def sales_copy_rank() -> list[Column | str]:
    """Which copy of an order item survives (ascending, NULLs last): non-negative quantity first, then
    the customer code as in the reference, then every other raw column so the choice is total."""
    sign = F.when(to_int_like_cast("quantidade") < 0, F.lit(1)).otherwise(F.lit(0))
    return [sign, *SALES_TIEBREAK]


def sales_copy_order() -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in sales_copy_rank()]


def conversion_flags(raw: DataFrame, rules: Mapping[str, Callable]) -> tuple[DataFrame, list[str]]:
    """``raw`` with two 0/1 columns per converted column, and their names: ``absent_<column>`` (no
    text) and ``failed_<column>`` (text that its rule does not convert)."""
    texts = {f"__text_{c}": _CLEANED.get(rule, F.col)(c) for c, rule in rules.items()}
    flags = {}
    for c, rule in rules.items():
        absent = F.col(f"__text_{c}").isNull()
        flags[f"absent_{c}"] = absent.cast("bigint")
        flags[f"failed_{c}"] = (~absent & rule(f"__text_{c}").isNull()).cast("bigint")
    flagged = raw.withColumns(texts).select(*raw.columns, *[f.alias(name) for name, f in flags.items()])
    return flagged, list(flags)


class Watched:
    """Metrics that Spark collects while a staging table is written, to be read after the write.

    They are taken in the stage that writes (for the sales that is after the dedupe's shuffle), whose
    tasks count once each, even when executors are lost and tasks run again.  What several passes
    over one export have watched is added up.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def on(self, df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
        self._seen.append(Observation())
        return df.observe(self._seen[-1], *[m.alias(name) for name, m in metrics.items()])

    def read(self) -> dict:
        out = {}
        for seen in self._seen:
            for name, value in seen.get.items():
                out[name] = _added(out[name], value) if name in out else value
        return out


def _added(a: int | list, b: int | list) -> int | list:
    """The sum of two counts, or of two lists of counted items (rows of ``item`` and ``count``)."""
    if not isinstance(a, list):
        return a + b
    counts = {}
    for r in [*a, *b]:
        counts[r["item"]] = counts.get(r["item"], 0) + r["count"]
    return [{"item": item, "count": n} for item, n in counts.items()]


def _sums(flags: Sequence[str]) -> dict[str, Column]:
    return {f: F.coalesce(F.sum(f), F.lit(0)) for f in flags}


def dedupe_sales(raw_sales: DataFrame) -> DataFrame:
    """T3 applied to the raw sales: one raw row per (order, item) text key."""
    return dedupe_by_key(raw_sales, SALES_KEY, sales_copy_order())


def prepared(df: DataFrame, numbers: Sequence[str] = (), dates: Sequence[str] = (), integers: Sequence[str] = ()) -> DataFrame:
    """``df`` with the text of columns to convert cleaned, in a projection of its own: the
    conversions read it several times, and so it is made once a value."""
    return df.withColumns(
        {c: number_text(c) for c in numbers} | {c: trim_spaces(c) for c in dates} | {c: cast_text(c) for c in integers}
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    """T1."""
    return prepared(raw_products, numbers=["custo_unitario", "preco_tabela"]).select(
        "codigo_produto",
        norm_txt("descricao").alias("descricao"),
        norm_txt("categoria").alias("categoria"),
        norm_txt("unidade").alias("unidade"),
        parse_number("custo_unitario").alias("custo_unitario"),
        parse_number("preco_tabela").alias("preco_tabela"),
        flag_yes("ativo").alias("ativo"),
    )


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    """T2."""
    return prepared(raw_customers, numbers=["limite_credito"], dates=["data_cadastro"]).select(
        "codigo_cliente",
        norm_txt("razao_social").alias("razao_social"),
        digits_only("cnpj").alias("cnpj"),
        norm_txt("segmento").alias("segmento"),
        norm_txt("regiao").alias("regiao"),
        trim_spaces("vendedor").alias("cod_vendedor"),
        parse_date("data_cadastro").alias("data_cadastro"),
        parse_number("limite_credito").alias("limite_credito"),
    )


def stage_plain(raw: DataFrame, table: str, stage: Callable[[DataFrame], DataFrame], watch: Watched, extra: Mapping[str, Column]) -> DataFrame:
    """T1 or T2 of an export, with its rows and conversions (and ``extra`` of the result) watched."""
    flagged, flags = conversion_flags(raw, PARSED_COLUMNS[table])
    staged = stage(watch.on(flagged, {"rows": F.count(F.lit(1))} | _sums(flags)))
    return watch.on(staged, extra) if extra else staged


def stg_sales(raw_sales: DataFrame) -> DataFrame:
    """T4: dedupe first, then drop cancelled and undated items, then tag returns.

    The filters must stay after the dedupe: if the surviving copy of an item is cancelled or
    undated the whole item goes, even when another copy was valid.  Catalyst keeps them there
    because they are not on the window's partition keys.
    """
    return _typed_sales(dedupe_sales(raw_sales))


def stage_sales(raw_sales: DataFrame, watch: Watched, extra: Mapping[str, Column]) -> DataFrame:
    """T4 with the raw rows and their conversions (and ``extra`` of the result) watched.

    The dedupe is an aggregation here, which adds up the copies of an item and their conversions
    while it finds the one that survives; so the export is read once for all of them.
    """
    flagged, flags = conversion_flags(raw_sales, PARSED_COLUMNS["raw_vendas"])
    sums = {"__copies": F.lit(1).cast("bigint")} | {f: F.col(f) for f in flags}
    rows = flagged.select(*SALES_KEY, *SALES_TIEBREAK, *flags)
    one = dedupe_and_sum(rows, SALES_KEY, sales_copy_rank(), sums)
    one = watch.on(one, {"rows": F.coalesce(F.sum("__copies"), F.lit(0))} | _sums(flags))
    return watch.on(_typed_sales(one), extra)


def _typed_sales(one_copy: DataFrame) -> DataFrame:
    numbers = ["preco_unitario", "desconto_pct", "frete_cobrado", "custo_frete_real"]
    kept = prepared(one_copy, numbers, ["data_pedido"], [*SALES_KEY, "quantidade"])
    typed = kept.select(
        strict_int("numero_pedido").alias("numero_pedido"),
        strict_int("sequencia_item").alias("sequencia_item"),
        parse_date("data_pedido").alias("data_pedido"),
        "codigo_cliente",
        "codigo_produto",
        strict_int("quantidade").alias("quantidade"),
        parse_number("preco_unitario").alias("preco_unitario"),
        parse_number("desconto_pct").alias("desconto_pct"),
        parse_number("frete_cobrado").alias("frete_cobrado"),
        parse_number("custo_frete_real").alias("custo_frete_real"),
        trim_spaces("vendedor").alias("cod_vendedor"),
        F.upper(trim_spaces("status")).alias("status"),
    )
    return typed.filter((F.col("status") != F.lit("CANCELADO")) & F.col("data_pedido").isNotNull()).withColumn(
        "tipo_operacao", F.when(F.col("quantidade") < 0, F.lit("DEVOLUCAO")).otherwise(F.lit("VENDA"))
    )
