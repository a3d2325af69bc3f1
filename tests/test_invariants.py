"""Invariants of the model and the analyses (from the reference's notebook checks)."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.plans import analyses as A
from ledgerline.plans import checks as Q

# Business figures of the fixture (FIXTURES.md, measured independently) at sf0.001.
EXPECTED_SF0001 = {"kept": 4130, "fact": 3676, "reliable": 3473, "returns": 115, "loss_products": 71, "months": 80,
                   "orphans": 171, "products": 186, "abc": {"A": 98, "B": 31, "C": 18},
                   "category_margins": [-18.7, 6.2, 8.4, 17.9, 20.2, 34.0]}


def test_fixture_counts(model):
    assert model["stg_vendas"].count() == EXPECTED_SF0001["kept"]
    assert model["fct_vendas"].count() == EXPECTED_SF0001["fact"]
    rel = model["fct_vendas"].filter("custo_confiavel")
    assert rel.count() == EXPECTED_SF0001["reliable"]
    assert rel.filter(F.col("tipo_operacao") == "DEVOLUCAO").count() == EXPECTED_SF0001["returns"]
    assert A.loss_products(model).count() == EXPECTED_SF0001["loss_products"]
    assert A.monthly_trend(model).count() == EXPECTED_SF0001["months"]
    assert rel.filter(F.col("sk_cliente") == 0).count() == EXPECTED_SF0001["orphans"]
    assert rel.select("codigo_produto").distinct().count() == EXPECTED_SF0001["products"]
    abc = {r.classe_abc: r.n for r in A.customer_abc(model).groupBy("classe_abc").agg(F.count("*").alias("n")).collect()}
    assert abc == EXPECTED_SF0001["abc"]
    assert sorted(r.margem_pct for r in A.margin_by_category(model).collect()) == EXPECTED_SF0001["category_margins"]


def test_surrogate_keys_dense_and_unique(model):
    for name, key in [("dim_produto", "sk_produto"), ("dim_vendedor", "sk_vendedor"), ("dim_cliente", "sk_cliente")]:
        keys = sorted(r[0] for r in model[name].select(key).collect())
        start = 0 if name == "dim_cliente" else 1
        assert keys == list(range(start, start + len(keys))), name


def test_date_dimension_spans_sales(model):
    d = model["dim_tempo"].agg(F.count("*").alias("n"), F.min("data").alias("a"), F.max("data").alias("b")).first()
    assert d.n == (d.b - d.a).days + 1
    assert d.a.year >= 1900
    s = model["stg_vendas"].agg(F.min("data_pedido"), F.max("data_pedido")).first()
    assert (s[0], s[1]) == (d.a, d.b)


def test_fact_integrity(model):
    r = Q.fact_integrity(model).first()
    assert r.sem_produto == 0 and r.sem_tempo == 0 and r.sem_vendedor == 0
    assert r.linhas == EXPECTED_SF0001["fact"]


def test_waterfall_closes(model):
    steps = {r.etapa: r.valor for r in A.margin_waterfall(model).collect()}
    residual = steps["Receita"] + steps["Mercadoria"] + steps["Entrega"] + steps["Comissao"] - steps["Margem"]
    # Margin per row is rounded once, costs separately: only cents may remain per row.
    assert abs(residual) <= 0.01 * EXPECTED_SF0001["reliable"]


def test_shares_sum_to_100(model):
    for df in (A.margin_by_category(model), A.discount_bands(model)):
        total = sum(r.participacao_pct for r in df.collect())
        assert abs(total - 100) <= 0.05 * df.count() + 1e-9


def test_abc_curve_monotone(model):
    rows = A.customer_abc(model).collect()  # in position order
    assert [r.posicao for r in rows] == list(range(1, len(rows) + 1))
    acc = [r.receita_acumulada_pct for r in rows]
    assert all(a <= b for a, b in zip(acc, acc[1:]))
    classes = "".join(r.classe_abc for r in rows)
    assert classes == "".join(sorted(classes))
    assert abs(acc[-1] - 100.0) < 1e-9


def test_critical_customers_below_portfolio(model):
    rows = A.critical_customers(model).collect()
    assert rows and all(r.classe_abc in ("A", "B") and r.diferenca_pp <= 0 for r in rows)


def test_money_sums_are_exact(model):
    rel = model["fct_vendas"].filter("custo_confiavel")
    exact = sum((Decimal(str(r.receita_total)) for r in rel.select("receita_total").collect()), Decimal(0))
    steps = {r.etapa: r.valor for r in A.margin_waterfall(model).collect()}
    assert Decimal(str(steps["Receita"])) == exact


def test_limbs_add_up_exactly(spark):
    """Sums of whole units by limbs against Python's integers: both signs, the largest amounts, NULLs."""
    import random

    from ledgerline.functions.numeric import MONEY, RATE, exact_sum, total

    rnd = random.Random(9)
    values = [rnd.choice([1, -1]) * rnd.randrange(10 ** rnd.randint(1, 16)) / 100 for _ in range(3000)]
    values += [999_999_999_999_999.0, -899_999_999_999_999.0, 0.0, -0.01, None]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "k int, x double").repartition(5)
    for units in (MONEY, RATE):
        small = [v for v in values if v is not None and abs(v) < min(1e15, 9e18 / units)]
        kept = df.filter(F.abs("x") < min(1e15, 9e18 / units))
        got = kept.groupBy("k").agg(exact_sum("x", units).alias("s")).select("s.whole", "s.rest").collect()
        assert sum(int(r.whole) for r in got) == sum(round(v * units) for v in small)
        assert all(r.rest is None for r in got)
    assert spark.createDataFrame([], "x double").agg(total(exact_sum("x")).alias("s")).first().s is None
    assert df.filter("x IS NULL").agg(total(exact_sum("x")).alias("s")).first().s is None
