"""Data-quality checks of the build (Q1-Q4) and the converter check.

What can be counted while the staging tables are written is not asked of the exports again; the
other checks are one-pass aggregates, and totals over different tables are combined with scalar
subqueries (planned once, no join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum, r2, total
from .analyses import panel
from .model import Model
from .staging import PARSED_COLUMNS, conversion_flags


def load_counts(m: Model) -> DataFrame:
    """Q1: raw rows, kept rows, dropped rows, returns, products without cost.

    A written model has counted them while its staging tables were written; a lazy one asks the
    tables.
    """
    schema = "linhas_brutas bigint, linhas_tratadas bigint, descartadas bigint, devolucoes bigint, produtos_sem_custo bigint"
    if m.metrics:
        sales, products = m.metrics["raw_vendas"], m.metrics["raw_produtos"]
        row = (sales["rows"], sales["kept"], sales["rows"] - sales["kept"], sales["returns"], products["no_cost"])
        return m["stg_vendas"].sparkSession.createDataFrame([row], schema)
    stg = m["stg_vendas"]
    kept = stg.agg(F.count(F.lit(1))).scalar()
    returns = stg.agg(F.count_if(F.col("tipo_operacao") == "DEVOLUCAO")).scalar()
    no_cost = m["stg_produtos"].agg(F.count_if(F.col("custo_unitario").isNull())).scalar()
    raw = m["raw_vendas"].agg(F.count(F.lit(1)).alias("linhas_brutas"))
    return raw.select(
        "linhas_brutas",
        kept.alias("linhas_tratadas"),
        (F.col("linhas_brutas") - kept).alias("descartadas"),
        returns.alias("devolucoes"),
        no_cost.alias("produtos_sem_custo"),
    )


def dimension_counts(m: Model) -> DataFrame:
    """Q2: rows per dimension."""
    parts = [
        m[table].agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(label).alias("t"), "linhas")
        for label, table in (
            ("produto", "dim_produto"), ("cliente", "dim_cliente"), ("vendedor", "dim_vendedor"), ("tempo", "dim_tempo"),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


def fact_integrity(m: Model) -> DataFrame:
    """Q3: fact rows, dangling keys, orphan customers, rows without cost, revenue and margin."""
    f = m["fct_vendas"]
    return f.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(F.col("sk_produto").isNull()).alias("sem_produto"),
        F.count_if(F.col("sk_tempo").isNull()).alias("sem_tempo"),
        F.count_if(F.col("sk_vendedor").isNull()).alias("sem_vendedor"),
        F.count_if(F.col("sk_cliente") == 0).alias("cliente_nao_identificado"),
        F.count_if(~F.col("custo_confiavel")).alias("sem_custo"),
        r2(total(exact_sum("receita_total"))).alias("receita"),
        r2(total(exact_sum("margem_contribuicao"))).alias("margem"),
    )


def panel_range(m: Model) -> DataFrame:
    """Q4: panel rows and first/last date."""
    return panel(m).agg(F.count(F.lit(1)).alias("linhas"), F.min("data").alias("de"), F.max("data").alias("ate"))


def parse_quality(m: Model) -> DataFrame:
    """Per raw column with a conversion rule, rows present, converted and failed.

    A written model has summed the conversions while its staging tables were written; a lazy one
    takes one pass per raw table.
    """
    spark = m["stg_vendas"].sparkSession
    schema = "tabela string, coluna string, presentes bigint, convertidos bigint, falhas bigint"
    if m.metrics:
        rows = []
        for table, rules in PARSED_COLUMNS.items():
            seen = m.metrics[table]
            for c in rules:
                present, failed = seen["rows"] - seen[f"absent_{c}"], seen[f"failed_{c}"]
                rows.append((table, c, present, present - failed, failed))
        return spark.createDataFrame(rows, schema)
    parts = []
    for table, rules in PARSED_COLUMNS.items():
        flagged, flags = conversion_flags(m[table].select(*rules), rules)
        one = flagged.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in flags])
        counted = [
            F.struct(
                F.lit(c).alias("coluna"),
                (F.col("rows") - F.col(f"absent_{c}")).alias("presentes"),
                (F.col("rows") - F.col(f"absent_{c}") - F.col(f"failed_{c}")).alias("convertidos"),
                F.col(f"failed_{c}").alias("falhas"),
            )
            for c in rules
        ]
        parts.append(one.select(F.lit(table).alias("tabela"), F.inline(F.array(*counted))))
    return reduce(DataFrame.unionByName, parts)
