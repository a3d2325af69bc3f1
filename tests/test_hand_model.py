"""A model small enough to work out by hand; the expected values below are written, not computed."""

import pytest

from ledgerline.plans import analyses as A
from ledgerline.plans import checks as Q
from ledgerline.plans.model import build_model_from_raw
from ledgerline.sources.io import RAW_CUSTOMER_COLUMNS, RAW_PRODUCT_COLUMNS, RAW_SALES_COLUMNS

# order, item, date, customer, product, quantity, price, discount, freight charged, freight cost, seller, status
SALES = [
    ("1", "1", "10/01/2024", "C1", "P1", "10", "R$ 100,00", "2,50", "5,00", "20,00", "V01", "faturado"),
    ("1", "1", "10/01/2024", "C1", "P1", "-10", "R$ 100,00", "2,50", "5,00", "20,00", "V01", "faturado"),  # a copy
    ("1", "2", "2024-01-11", "C1", "P2", "1", "50,00", None, "0,00", "0,00", "V01", "faturado"),  # no discount known
    ("2", "1", "05-03-24", "C2", "P1", "1", "100.00", "12,00", "0,00", "10,00", "V09", "faturado"),  # no sale in February
    ("3", "1", "05-03-24", "C9", "P3", "0", "80.00", "0,00", "0,00", "0,00", "V02", "faturado"),  # no revenue, no such customer
    ("4", "1", "05-03-24", None, "P4", "2", "30.00", "20,00", "0,00", "0,00", "V02", "faturado"),  # cost unknown
    ("5", "1", "05-03-24", "C1", "P9", "2", "30.00", "0,00", "0,00", "0,00", "V02", "faturado"),  # no such product
    ("6", "1", "n/d", "C1", "P1", "2", "30.00", "0,00", "0,00", "0,00", "V02", "faturado"),
    ("7", "1", "05-03-24", "C1", "P1", "2", "30.00", "0,00", "0,00", "0,00", "V02", " cancelado "),
    ("8", "1", "05-03-24", "C2", "P2", "-1", "10.00", "4,00", "0,00", "1,00", None, "faturado"),  # no seller
]
PRODUCTS = [
    ("P1", " Caneta ", "A", "un", "60,00", "100,00", "S"), ("P2", "Lapis", "B", "un", "20,00", "50,00", "S"),
    ("P3", "Caderno", "C", "un", "1,00", "80,00", "N"), ("P4", "Regua", "C", "un", None, "30,00", "N"),
]
CUSTOMERS = [
    ("C1", "Alfa", "11.111.111/0001-11", "X", "Sul", "V01", "01/01/2020", "1.000,00"),
    ("C2", "Beta", "", "Y", "Norte", "V02", "01/01/2020", "0"),
]


def _model(spark, sales=SALES):
    text = lambda rows, columns: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    raw = {
        "raw_vendas": text(sales, RAW_SALES_COLUMNS), "raw_produtos": text(PRODUCTS, RAW_PRODUCT_COLUMNS),
        "raw_clientes": text(CUSTOMERS, RAW_CUSTOMER_COLUMNS),
    }
    return build_model_from_raw(spark, raw)


@pytest.fixture(scope="module")
def hand(spark):
    return _model(spark)


def test_loads(hand):
    # 10 rows; a copy, an undated and a cancelled one go
    assert tuple(Q.load_counts(hand).first()) == (10, 7, 3, 1, 1)
    r = Q.fact_integrity(hand).first()
    assert (r.linhas, r.cliente_nao_identificado, r.sem_custo) == (5, 2, 1)


def test_fact(hand):
    rows = {(r.numero_pedido, r.sequencia_item): r for r in hand["fct_vendas"].collect()}
    r = rows[1, 1]  # 10 x 100, cost 600, commission 3 %
    assert (r.receita_mercadoria, r.receita_total, r.custo_produto, r.custo_comissao) == (1000.0, 1005.0, 600.0, 30.0)
    assert (r.frete_subsidiado, r.margem_bruta, r.margem_contribuicao) == (15.0, 400.0, 355.0)
    assert rows[4, 1].margem_contribuicao is None and rows[4, 1].codigo_cliente == "NAO_IDENTIFICADO"
    assert rows[2, 1].custo_comissao == 3.2  # unknown seller code: 3.2 %


def test_unknown_discount_lands_in_the_last_band(hand):
    bands = {r.faixa: (r.itens, r.receita) for r in A.discount_bands(hand).collect()}
    assert bands == {"1. ate 5%": (2, 1005.0), "3. 10 a 15%": (1, 100.0), "5. acima de 20%": (1, 50.0)}


def test_no_revenue_is_healthy(hand):
    rows = {r.categoria: r for r in A.margin_by_category(hand).collect()}
    assert (rows["C"].receita, rows["C"].margem_pct, rows["C"].situacao) == (0.0, None, "Saudavel")
    assert (rows["A"].receita, rows["A"].margem_contribuicao, rows["A"].situacao) == (1105.0, 381.8, "Saudavel")


def test_one_customer_above_95_percent_is_class_c(spark, hand):
    # C1 holds 1055 of 1155 (91.3 %): class B alone, C2 reaches 100 %
    abc = [(r.razao_social, r.receita, r.receita_acumulada_pct, r.classe_abc) for r in A.customer_abc(hand).collect()]
    assert abc == [("Alfa", 1055.0, 91.3, "B"), ("Beta", 100.0, 100.0, "C")]
    only = A.customer_abc(_model(spark, SALES[:3])).collect()
    assert [(r.posicao, r.classe_abc, r.desconto_medio) for r in only] == [(1, "C", 2.5)]


def test_change_is_against_the_previous_month_with_sales(hand):
    rows = [(r.ano_mes, r.receita, r.margem, r.var_receita_pct, r.var_margem_pct) for r in A.monthly_trend(hand).collect()]
    # January 355 + 28.5; March 100 - 60 - 10 - 3.2; (100 - 1055) / 1055 and (26.8 - 383.5) / 383.5
    assert rows == [("2024-01", 1055.0, 383.5, None, None), ("2024-03", 100.0, 26.8, -90.5, -93.0)]


@pytest.mark.parametrize("price,revenue", [("inf", float("inf")), ("-inf", float("-inf")), ("nan", float("nan")), ("1e17", 1e17)])
def test_odd_amounts_add_up_as_doubles_do(spark, price, revenue):
    """What the reference's sum of doubles gives when one amount is no ordinary number."""
    odd = ("9", "1", "05-03-24", "C2", "P1", "1", price, "1,00", "0,00", "0,00", "V01", "faturado")
    m = _model(spark, [*SALES, odd])
    same = lambda a, b: a == b or (a != a and b != b)
    a = {r.categoria: r for r in A.margin_by_category(m).collect()}
    assert same(a["A"].receita, revenue + 1105.0) and a["B"].receita == 50.0
    assert same({r.etapa: r.valor for r in A.margin_waterfall(m).collect()}["Receita"], revenue + 1155.0)
    for f in (A.customer_abc, A.critical_customers, A.discount_bands, A.freight_subsidy, A.monthly_trend, A.loss_products, A.seller_performance):
        f(m).collect()
    assert same(Q.fact_integrity(m).first().receita, revenue + 1215.0)
    abc = A.customer_abc(m).collect()
    assert {r.posicao for r in abc} == {1, 2}
