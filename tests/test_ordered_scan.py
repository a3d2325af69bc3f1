"""The ordered scan against a plain global window."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.ordered import natural_order, ordered_scan


def _data(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # few distinct values so ties on the leading column are frequent; some NULLs
        v = None if rnd.random() < 0.05 else Decimal(rnd.randint(-50, 200)) / 4
        code = None if rnd.random() < 0.03 else f"C{rnd.randint(0, 300):04d}"
        rows.append((i, v, code, rnd.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "id int, v decimal(18,2), code string, tag string")


@pytest.fixture(params=["1", "7", "64"])
def partitions(spark, request):
    """Several range partitions, kept apart."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], request.param)
    spark.conf.set(names[1], "false")
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


@pytest.mark.parametrize("order", [
    [("v", True), ("code", False), ("tag", False), ("id", False)],
    [("code", False), ("tag", False), ("v", False), ("id", False)],
])
def test_matches_plain_window(spark, partitions, order):
    df = _data(spark)
    got = ordered_scan(df, order, number="pos", running={"run": "v"}, totals={"tot": "v"})
    w = Window.orderBy(*natural_order(order))
    want = df.select(
        "id",
        F.row_number().over(w).cast("bigint").alias("pos"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.sum("v").over(Window.partitionBy()).alias("tot"),
    )
    g = {r.id: (r.pos, r.run, r.tot) for r in got.select("id", "pos", "run", "tot").collect()}
    w_ = {r.id: (r.pos, r.run, r.tot) for r in want.collect()}
    assert g == w_
    assert sorted(p for p, _, _ in g.values()) == list(range(1, len(g) + 1))


def test_hot_leading_value_is_split(spark, partitions):
    """A third of the rows share the leading sort value; ties are broken by the next column."""
    rows = [(i, "HOT" if i % 3 == 0 else f"K{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string")
    got = ordered_scan(df, [("k", False), ("id", False)], number="pos")
    pos = {r.id: r.pos for r in got.collect()}
    expected = {i: n + 1 for n, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert pos == expected


def test_numbers_and_sums(spark):
    df = _data(spark, n=200)
    got = ordered_scan(df, [("id", False)], number="pos", running={"run": "v"}, totals={"tot": "v"})
    rows = got.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 201))
    total = sum((r.v for r in rows if r.v is not None), Decimal(0))
    assert rows[-1].run == total and rows[0].tot == total


def test_descending_text(spark, partitions):
    df = _data(spark, n=200)
    order = [("code", True), ("id", True)]
    got = {r.id: r.pos for r in ordered_scan(df, order, number="pos").collect()}
    w = Window.orderBy(*natural_order(order))
    assert got == {r.id: r.pos for r in df.select("id", F.row_number().over(w).alias("pos")).collect()}


def test_empty_and_single_row(spark, partitions):
    empty = _data(spark, n=3).limit(0)
    assert ordered_scan(empty, [("id", False)], number="pos", running={"run": "v"}).count() == 0
    one = _data(spark, n=1)
    r = ordered_scan(one, [("v", True), ("id", False)], number="pos", running={"run": "v"}, totals={"tot": "v"}).first()
    assert r.pos == 1 and r.run == r.v and r.tot == r.v
