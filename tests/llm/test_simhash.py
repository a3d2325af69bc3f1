import random

import pytest
import xxhash

from ledgerline.llm import simhash as s

from . import brute


def _fingerprint(text):
    w = brute.WORD.findall((text or "").translate(brute.LOWER))
    if not w:
        return 0
    k = min(3, len(w))
    h = [xxhash.xxh64(" ".join(w[i : i + k]).encode(), seed=42).intdigest() for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(prints):
    up = {i: i for i in prints}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: top(i) for i in ids}


def _texts(seed=11):
    rnd = random.Random(seed)
    docs = []
    for _ in range(15):
        base = [rnd.choice("abcdefghijklmnop") * rnd.randint(1, 4) + str(rnd.randint(0, 99)) for _ in range(rnd.choice([3, 50, 400]))]
        for _ in range(rnd.randint(1, 9)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = str(rnd.randint(0, 9999))
            docs.append("  ".join(copy).title())
    docs += ["", " \t\n", None, "one", "ONE", "one two", "naïve Ünï 中文 😀 \x00 e\x1c", "É é É"]
    rnd.shuffle(docs)
    return [(i * 3 - 20, t) for i, t in enumerate(docs)]


def test_same_as_all_pairs(spark):
    docs = _texts()
    got = s.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    prints = {i: _fingerprint(t) for i, t in docs}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == _components(prints)


def _crowds(seed, n):
    """Fingerprints in crowds: around centres (links and near misses), chains and random ones."""
    rnd = random.Random(seed)
    prints = set()
    while len(prints) < n:
        at = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 1, 1, n // 4])):
            prints.add(at)
            at ^= sum(1 << b for b in rnd.sample(range(64) if rnd.random() < 0.5 else range(20), rnd.randint(1, 5)))
    return {i: p for i, p in enumerate(sorted(prints))}


@pytest.mark.parametrize("shard", [4096, 8])
def test_links_of_crowds(spark, monkeypatch, shard):
    """With small shards, crowds are cut again and dealt over parts; no link is lost."""
    monkeypatch.setattr(s, "SHARD", shard)
    prints = _crowds(shard, 400)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    classes = spark.createDataFrame(signed, "id long, bits long")
    found = s.components(s.links(classes))
    got = {i: i for i in prints} | {r["node"]: r["component"] for r in found.collect()}
    assert got == _components(prints)


def test_rows_of_a_crowd_stay_fewer_than_its_members():
    base, near = 0, [sum(1 << b for b in c) for c in __import__("itertools").combinations(range(40), 2)]
    bits = [base, *near]
    every = list(range(len(bits)))
    assert len(s.spanning_links(bits, every, every, 3)) == len(bits) - 1


def test_tree_finds_exactly_the_near_ones():
    rnd = random.Random(2)
    bits = [rnd.getrandbits(12) | rnd.getrandbits(3) << 40 for _ in range(500)]
    tree = s.Tree()
    for b in bits:
        tree.add(b)
    assert all(len(set(c)) == len(c) and all((tree.bits[n] ^ tree.bits[k]).bit_count() == d for d, k in c.items())
               for n, c in enumerate(tree.children))
    for q in (*bits[:50], 0, (1 << 64) - 1):
        assert sorted(tree.near(q, 3)) == [i for i, b in enumerate(bits) if (b ^ q).bit_count() <= 3]


def test_messy(spark, messy):
    rows = s.near_groups(messy).collect()
    assert len(rows) == messy.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[2]["fingerprint"] == by[4]["fingerprint"] == "0" * 16 and by[4]["component_id"] == by[3]["component_id"] == 2
    assert by[7]["component_id"] == 1 and by[5]["fingerprint"] == f"{_fingerprint(messy.filter('doc_id = 5').first().text):016x}"
    assert all(r["component_id"] is None and r["fingerprint"] for r in rows if r["doc_id"] is None)


def test_empty(spark, messy):
    assert s.near_groups(messy.limit(0)).count() == 0
