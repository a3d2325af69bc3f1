"""Cleaning rules (C1-C5): literal cases and agreement with the reference engine's own evaluation."""

import datetime as dt
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import cleaning as C
from ledgerline.functions.numeric import r1, r2
from ledgerline.plans import oracle as O

NUMBER_CASES = [
    ("R$ 1.234,56", 1234.56), ("89.90", 89.9), ("89,90", 89.9), ("1.234", 1.234), ("1.234.567", None),
    ("1,234.56", 1.23456), ("R$", None), ("", None), (None, None), ("1.5d", None), ("\t1.5\t", 1.5),
    (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("1.5e", None), ("-inf", float("-inf")), ("0x10", None),
    (" 12,5　", 12.5),
]
DATE_CASES = [
    ("03/05/2025", dt.date(2025, 5, 3)), ("2025-05-03", dt.date(2025, 5, 3)), ("05-03-25", dt.date(2025, 3, 5)),
    ("05-03-68", dt.date(2068, 3, 5)), ("05-03-69", dt.date(1969, 3, 5)), ("31/02/2025", None), ("n/d", None),
    (" 03/05/2025 ", dt.date(2025, 5, 3)), ("03/05/2025\n", None), ("29-02-00", dt.date(2000, 2, 29)),
    ("29-02-69", None), ("00/01/2025", None), ("3/5/2025", None), (None, None),
]
TEXT_CASES = [("  a   b ", "a b"), ("   ", None), (" a\tb\x0bc ", "a b\x0bc"), (" x ", "x"), (None, None)]
DIGIT_CASES = [("12.345/0001-9", "1234500019"), ("-", None), ("", None), (None, None)]


def _one(spark, values, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


@pytest.mark.parametrize("rule,cases", [
    (C.to_num, NUMBER_CASES), (C.to_date_br, DATE_CASES), (C.norm_txt, TEXT_CASES), (C.digits_only, DIGIT_CASES),
])
def test_literal_cases(spark, rule, cases):
    got = _one(spark, [v for v, _ in cases], rule)
    for (inp, want), g in zip(cases, got):
        assert _same(g, want), (inp, g, want)


def test_flag(spark):
    assert _one(spark, [" s ", "S", "N", "sim", None], C.flag_yes) == [True, True, False, False, None]


def test_int_like_cast(spark):
    assert _one(spark, ["12", "-3", " 7", "12.7", "-2.5", "+4"], C.to_int_like_cast) == [12, -3, 7, 13, -3, 4]


INTEGER_CASES = [
    ("1_000", 1000), ("12.7", 13), ("x", None), ("inf", None), ("nan", None), ("99999999999", None), ("", None), ("+4", 4),
    ("1__0", None), ("2147483647", 2147483647), ("1e3", 1000), (None, None),
]


def test_one_integer_rule_in_two_forms(spark):
    """What the check counts as converted is what staging converts; the rest raises there."""
    assert _one(spark, [v for v, _ in INTEGER_CASES], C.try_int) == [w for _, w in INTEGER_CASES]
    for text, want in INTEGER_CASES:
        if want is not None or text is None:
            assert _one(spark, [text], C.to_int_like_cast) == [want]
        else:
            with pytest.raises(Exception, match="not an integer"):
                _one(spark, [text], C.to_int_like_cast)


ALPHABET = list("0123456789.,-/ R$\tn 　d e") + ["\n", "\x0b", "\u00a0", "\u2009", "\x85", "inf", "nan", "_"]


def _random_texts(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = rnd.randint(0, 12)
        out.append("".join(rnd.choice(ALPHABET) for _ in range(k)))
    # shapes close to real values
    for _ in range(n // 2):
        a, b = rnd.randint(0, 99), rnd.randint(0, 99)
        y = rnd.choice([rnd.randint(0, 99), rnd.randint(1900, 2100)])
        out.append(rnd.choice([f"{a:02d}/{b:02d}/{y:04d}", f"{y:04d}-{a:02d}-{b:02d}", f"{a:02d}-{b:02d}-{y % 100:02d}",
                               f"R$ {a}.{b:03d},{y % 100:02d}", f" {a},{b} ", f"{a}.{b}", f"  {a}  {b} "]))
    return out


@pytest.mark.parametrize("name", ["to_num", "to_date_br", "norm_txt"])
def test_rules_agree_with_reference_engine(spark, duck, name):
    """Random and near-real texts: the Spark rule equals the same rule evaluated by DuckDB."""
    texts = _random_texts(1500, seed=zlib.crc32(name.encode()))
    spark_rule = getattr(C, name)
    sql_rule = {"to_num": O._number, "to_date_br": O._day, "norm_txt": O._label}[name]
    got = _one(spark, texts, spark_rule)
    duck.execute("CREATE OR REPLACE TEMP TABLE probe(i INTEGER, v VARCHAR)")
    duck.executemany("INSERT INTO probe VALUES (?, ?)", list(enumerate(texts)))
    want = [r[0] for r in duck.execute(f"SELECT {sql_rule('v')} FROM probe ORDER BY i").fetchall()]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if not _same(g, w)]
    assert not bad, bad[:10]


def test_rounding_matches_reference_engine(spark, duck):
    """Binary-scaling rounding, ties and signed zero included."""
    rnd = random.Random(7)
    vals = [k / 1000 for k in range(-3000, 3000, 5)] + [rnd.uniform(-1e6, 1e6) for _ in range(2000)]
    vals += [0.285, 1.005, 2.675, -0.0049, -0.04, 0.0, -0.0, 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [(r.a, r.b) for r in df.select("i", r2("v").alias("a"), r1("v").alias("b")).orderBy("i").collect()]
    duck.execute("CREATE OR REPLACE TEMP TABLE rp(i INTEGER, v DOUBLE)")
    duck.executemany("INSERT INTO rp VALUES (?, ?)", list(enumerate(vals)))
    want = duck.execute("SELECT round(v, 2), round(v, 1) FROM rp ORDER BY i").fetchall()
    for v, g, w in zip(vals, got, want):
        assert g[0] == w[0] and math.copysign(1, g[0]) == math.copysign(1, w[0]), (v, g, w)
        assert g[1] == w[1] and math.copysign(1, g[1]) == math.copysign(1, w[1]), (v, g, w)
