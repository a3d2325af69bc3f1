"""The pipeline's stages against brute force, each on what its predecessor kept."""

import duckdb
import pytest

import corpus_pipeline as c
from ledgerline.llm import packing, quality_rules, toxicity
from ledgerline.llm.tables import kept, table

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, f in c.STAGES:
        docs = kept(f(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(spark, stages):
    columns = table(spark, SF, "documents").columns
    assert [s.columns for s in stages[:-1]] == [columns] * 4


def test_quality(spark, stages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
    assert set(_texts(stages[0])) == want


def test_toxicity(spark, stages):
    scored = toxicity.score_rows(stages[0], table(spark, SF, "labels"))
    assert set(_texts(stages[1])) == {r["doc_id"] for r in scored.filter("score < 0.5").collect()}


def test_near_copies(spark, stages):
    docs = _texts(stages[1])
    components = brute.near_components(docs.items())
    assert _texts(stages[2]) == {i: t for i, t in docs.items() if components[i] == i}


def test_passages(spark, stages):
    assert _texts(stages[3]) == brute.without_passages(list(_texts(stages[2]).items()))
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())


def test_packing(spark, stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in _texts(stages[3]).items()}
    got = {}
    for r in stages[4].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_run(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32"]
    total = lambda df: df.agg({"length": "sum"}).first()[0]
    out = c.run(spark, SF)
    assert out.columns == stages[4].columns and total(out) == total(stages[4])
    assert out.select("doc_id").distinct().count() == stages[3].count() and key[0] in out.columns


def test_messy(spark, messy):
    docs = messy
    for name, f in c.STAGES[:-1]:
        docs = f(spark, docs, SF)
        assert docs.columns == messy.columns
    assert docs.count() <= messy.count()
    empty = messy.limit(0)
    for name, f in c.STAGES:
        assert f(spark, empty, SF).count() == 0


def test_columns_with_dots_and_result_names(spark, messy):
    docs = messy.withColumnsRenamed({"lang": "a.b", "score": "n_removed_words"}).withColumn("held out", messy.doc_id)
    for name, f in c.STAGES[:-1]:
        docs, before = f(spark, docs, SF), docs
        assert docs.columns == before.columns
    assert docs.count() <= messy.count()
