import random

import numpy as np

from ledgerline.llm import minhash as m

from . import brute


def _texts(seed=5):
    """Groups of near copies around hubs, chains of links, and documents with a shared passage."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefghij", k=5))
    passage = [word() for _ in range(60)]
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([30, 90, 200]))]
        docs += [" ".join(base)] * rnd.choice([1, 1, 3])
        for _ in range(rnd.choice([0, 3, 14])):
            copy = list(base)
            for _ in range(rnd.randint(1, 4)):
                copy[rnd.randrange(len(copy))] = word()
            docs.append("  ".join(copy).upper())
        chain = list(base)
        for _ in range(5):
            chain[rnd.randrange(len(chain))] = word()
            docs.append(" ".join(chain))
        docs.append(" ".join(passage + [word() for _ in range(20)]))
    docs += ["", " ", "one two", "one two", "One  Two", "one two three"]
    rnd.shuffle(docs)
    return list(enumerate(docs))


def test_same_components_as_all_pairs(spark):
    docs = _texts()
    got = m.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute.near_components(docs)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(brute.shingles(t)) for i, t in docs}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_leaf_links_that_no_star_tests(spark):
    """Of three classes in one bucket, the two that link are no centres."""
    same = np.arange(m._BINS, dtype=np.uint64) % 251
    near = same.copy()
    near[500:] = 7
    far = same.copy()
    far[240:] = 250
    rows = [
        (9, 0, 1, 50, 3, bytes(same.astype(np.uint8))), (9, 0, 2, 51, 3, bytes(near.astype(np.uint8))),
        (9, 0, 3, 50, 3, bytes(far.astype(np.uint8))),
    ]
    df = spark.createDataFrame(rows, "bucket long, band int, id long, n long, size long, signature binary")
    sketches = df.select(df.id.alias("doc_id"), "signature")
    leaves = m.promising_leaves(df.drop("signature"), sketches, None).collect()
    assert sorted(r["id"] for r in leaves) == [1, 2]


def test_bytes_that_agree_by_chance_in_an_earlier_band(spark):
    """The one-byte signatures agree in band 0 though its buckets differ: band 1's bucket is the only one."""
    same = bytes((np.arange(m._BINS) % 251).astype(np.uint8))
    rows = [(9, 1, 1, 50, 3, same), (9, 1, 2, 51, 3, same)]
    df = spark.createDataFrame(rows, "bucket long, band int, id long, n long, size long, signature binary")
    leaves = m.promising_leaves(df.drop("signature"), df.select(df.id.alias("doc_id"), "signature"), None).collect()
    assert sorted(r["id"] for r in leaves) == [1, 2]


def _variants(n, words, changed, seed):
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        copy = list(base)
        for at in rnd.sample(range(words), changed):
            copy[at] = f"x{k}y{at}"
        out.append((k, " ".join(copy)))
    return out


def test_a_crowd_that_does_not_link_makes_no_more_rows_than_it_reads(spark, monkeypatch):
    """400 variants of one text, four of 200 words changed: similar, but hardly any two link."""
    docs = _variants(400, 200, 4, 8)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    steps = {"promising_leaves": [], "leaf_links": []}
    for name, rows in steps.items():
        plain = getattr(m, name)

        def watched(*args, plain=plain, rows=rows):
            out = plain(*args)
            rows.append((args[0].count(), out.count()))
            return out

        monkeypatch.setattr(m, name, watched)
    got = {r["doc_id"]: r["component_id"] for r in m.near_groups(df).collect()}
    assert got == brute.near_components(docs)
    for rows in steps.values():
        assert len(rows) == 1 and rows[0][1] <= rows[0][0], steps


def test_leaves_are_joined_over_blocks(spark, monkeypatch):
    """Blocks of two members: what links is found in whatever block pair it meets."""
    monkeypatch.setattr(m, "BLOCK", 2)
    docs = _variants(40, 200, 3, 3)
    got = {r["doc_id"]: r["component_id"] for r in m.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.near_components(docs)


def test_densified_bins_copy_filled_ones():
    few = np.sort(np.random.default_rng(3).integers(0, 2**63, 7).astype(np.uint64))
    sig = m.signatures([few, few[:1]])
    assert set(sig[0]) == set(few) and set(sig[1]) == {few[0]}


def test_messy(spark, messy):
    got = m.near_groups(messy).collect()
    assert len(got) == messy.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], r)
    assert by[7]["component_id"] == 1 and not by[7]["kept"] and by[1]["kept"]
    assert by[2]["n_shingles"] == 0 and by[2]["component_id"] == 2 and by[3]["component_id"] == 3
    assert by[None]["component_id"] is None and by[None]["kept"]
    left = m.drop_near_copies(messy)
    assert left.columns == messy.columns
    assert left.filter("doc_id = 7").count() == 0 and left.filter("doc_id IS NULL").count() == 2


def test_empty(spark, messy):
    assert m.near_groups(messy.limit(0)).count() == 0
