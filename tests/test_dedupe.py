"""Dedupe before filtering, total tie-break, raw text keys."""

from ledgerline.plans.staging import dedupe_sales, stg_sales
from ledgerline.sources.io import RAW_SALES_COLUMNS


def _raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_SALES_COLUMNS))


def row(order="1", item="1", date="03/05/2025", cust="C1", prod="P1", qty="2", price="10,00", status="faturado"):
    return (order, item, date, cust, prod, qty, price, "0.00", "1.00", "2.00", " V01", status)


def test_cancelled_survivor_removes_item(spark):
    # The non-negative copy wins; it is cancelled, so the item disappears although the
    # other copy was valid (filters run after the dedupe).
    raw = _raw(spark, [row(qty="2", status=" Cancelado "), row(qty="-2", status="faturado")])
    assert stg_sales(raw).count() == 0


def test_positive_copy_preferred_then_customer_nulls_last(spark):
    raw = _raw(spark, [row(qty="-1", cust="A"), row(qty="3", cust=None), row(qty="3", cust="B")])
    kept = stg_sales(raw).collect()
    assert len(kept) == 1 and kept[0].quantidade == 3 and kept[0].codigo_cliente == "B"


def test_full_tie_break_is_deterministic(spark):
    rows = [row(price=p) for p in ["30,00", "10,00", "20,00"]]
    for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
        kept = dedupe_sales(_raw(spark, perm)).collect()
        assert [r.preco_unitario for r in kept] == ["10,00"]


def test_key_is_raw_text(spark):
    raw = _raw(spark, [row(order="1"), row(order="01")])
    kept = stg_sales(raw).collect()
    assert len(kept) == 2 and {r.numero_pedido for r in kept} == {1}


def test_undated_and_returns(spark):
    raw = _raw(spark, [row(order="1", date="n/d"), row(order="2", qty="-4"), row(order="3", date="05-03-69")])
    kept = {r.numero_pedido: r for r in stg_sales(raw).collect()}
    assert set(kept) == {2, 3}
    assert kept[2].tipo_operacao == "DEVOLUCAO" and kept[3].tipo_operacao == "VENDA"
    assert kept[3].data_pedido.year == 1969


def test_partial_limit_before_shuffle(spark):
    raw = _raw(spark, [row()])
    plan = dedupe_sales(raw)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_key_keeps_one_row_and_the_rest(spark):
    # A third of the rows are copies of one item; they collapse to the first copy and every
    # other item is kept whole.
    hot = [row(order="7", item="1", price=f"{p},00") for p in range(10, 310)]
    rest = [row(order=str(1000 + i), item="1") for i in range(600)]
    kept = stg_sales(_raw(spark, hot + rest))
    assert kept.count() == 601
    assert kept.filter("numero_pedido = 7").first().preco_unitario == 10.0  # "10,00" sorts first as text


def test_null_status_and_decimal_quantity(spark):
    raw = _raw(spark, [row(order="1", status=None), row(order="2", qty="2.5"), row(order="3", qty=" 4 ")])
    kept = {r.numero_pedido: r for r in stg_sales(raw).collect()}
    assert set(kept) == {2, 3}  # NULL status fails the status filter, as in the reference
    assert kept[2].quantidade == 3 and kept[3].quantidade == 4
