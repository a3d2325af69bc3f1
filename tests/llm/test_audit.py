import itertools
import random

import numpy as np

from ledgerline.llm import filter_audit as f

from . import brute

WORDS = [f"w{i}" for i in range(400)]


def _docs(n=240, seed=3):
    rnd = random.Random(seed)
    docs = []
    for i in rnd.sample(range(-50, 1000), n):
        if docs and rnd.random() < 0.3:
            text = rnd.choice(docs)[1]
        else:
            text = " ".join(rnd.choices(WORDS if rnd.random() < 0.6 else WORDS[:40], k=rnd.choice([5, 199, 200, 300])))
            text = text.upper() if rnd.random() < 0.2 else text
            text += rnd.choice(["", "", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
        docs.append((i, text, rnd.choice(["a", "a", "b", None, ""])))
    return docs + [(5000, None, "b"), (5001, "", "a"), (5002, "", "b"), (None, docs[0][1], "a"), (5003, docs[0][1], "c")]


def _brute(docs, labels):
    """Every order applied to the documents themselves, step by step."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    lowest, fails = {}, []
    for i, t, _ in docs:
        if i is not None:
            lowest[t or ""] = min(i, lowest.get(t or "", i))
    for i, t, _ in docs:
        t = t or ""
        w = brute.WORD.findall(t)
        no = {"A"} if len(w) < 200 else set()
        no |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        no |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        no |= {"D"} if set(t) & set("#$%&*|") else set()
        no |= {"E"} if i is not None and i > lowest[t] else set()
        fails.append(no)
    out = {}
    for part in {p or "" for _, _, p in docs}:
        rows = [k for k, d in enumerate(docs) if (d[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        found = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [k for k in left if letter in fails[k]]
                left = [k for k in left if letter not in fails[k]]
                shapley[letter] += len(gone)
                found[order, step] = (
                    len(left), len(gone), sum(letter in fails[k] for k in rows) - len(gone),
                    sum(fails[k] == {letter} for k in rows),
                    sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone),
                )
        out |= {(part, o, s): (*v, shapley[o[s - 1]]) for (o, s), v in found.items()}
    return out


def _rows(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in f._COUNTS) for r in df.collect()}


def test_same_counts_as_applying_every_order(spark):
    docs = _docs()
    labels = [(d[0], k % 3, k % 2) for k, d in enumerate(docs[::2])] + [(docs[0][0], 1, 1), (docs[0][0], 0, 0), (None, 1, 1), (docs[1][0], None, None)]
    got = f.audit(
        spark.createDataFrame(docs, "doc_id long, text string, source string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    assert _rows(got) == _brute(docs, labels)


def test_states_are_survivors_of_each_subset():
    counts = np.random.default_rng(1).integers(0, 9, (3, 32, 2))
    states = f.walk(counts)
    for active in range(32):
        passing = [m for m in range(32) if not m & active]
        assert (states[:, active] == counts[:, passing].sum(axis=1)).all()


def test_copies_and_part_names(spark):
    docs = [(7, "x", "a"), (7, "x", "a"), (3, "x", None), (9, "x", ""), (None, "x", "a")]
    got = _rows(f.audit(spark.createDataFrame(docs, "doc_id long, text string, source string"),
                        spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert {k[0] for k in got} == {"", "a"}
    assert got["a", "EABCD", 1][:2] == (1, 2) and got["", "EABCD", 1][:2] == (1, 1)


def test_messy(spark, messy, labels):
    got = _rows(f.audit(messy, labels))
    assert {k[0] for k in got} == {"", "a", "b", "c"} and len(got) == 4 * 600
    # Part a: 1 twice (the smallest id of its text), 3 (empty, as the null text of 2) and 7 (text of 1).
    assert got["a", "EABCD", 1][:2] == (2, 2)
    clash = messy.withColumnsRenamed({"kept": "mask", "score": "digest", "lang": "n"}).withColumn("part", messy.doc_id)
    assert _rows(f.audit(clash, labels)) == got


def test_empty(spark, messy, labels):
    assert f.audit(messy.limit(0), labels.limit(0)).count() == 0
