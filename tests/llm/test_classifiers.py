import pytest

from ledgerline.llm import quality_knn, toxicity

SF = "/root/testdata/sf0.01"


def _held(spark, rows, label):
    known = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    held = rows.filter("held_out").join(known, "doc_id").collect()
    return [(r["score"], r["predicted"], r[label]) for r in held]


def test_quality_of_held_out_rows(spark):
    held = _held(spark, quality_knn.query(spark, SF), "quality")
    good, bad = [s for s, _, y in held if y == 1], [s for s, _, y in held if y == 0]
    assert sum(g > b for g in good for b in bad) > 0.97 * len(good) * len(bad)
    assert sum(p == y for _, p, y in held) > 0.95 * len(held)


def test_toxicity_of_held_out_rows(spark):
    held = _held(spark, toxicity.query(spark, SF), "toxic")
    assert sum(p == y for _, p, y in held) > 0.9 * len(held)
    assert sum(p for _, p, y in held if y == 1) >= 0.6 * sum(y for _, _, y in held)


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_messy(spark, messy, labels, kind):
    score = quality_knn.score if kind == "quality" else toxicity.score_rows
    rows = score(messy, labels).collect()
    assert len(rows) == messy.count()
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in rows)
    one = {r["score"] for r in rows if r["doc_id"] == 1}
    assert len(one) == 1
    none = score(messy, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert score(messy.limit(0), labels).count() == 0


def test_labels_of_the_held_out_fold_teach_nothing(spark, messy, labels):
    from pyspark.sql import functions as F

    from ledgerline.llm.tables import held_out

    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = sorted((r["doc_id"] or 0, r["score"]) for r in quality_knn.score(messy, labels).collect())
    again = sorted((r["doc_id"] or 0, r["score"]) for r in quality_knn.score(messy, flipped).collect())
    assert first == again


def _plain_tokens(text):
    """Words without the ASCII signs around them, in lower case."""
    import string

    from . import brute

    return [w.strip(string.punctuation).lower() for w in brute.WORD.findall(text)]


def test_features_as_counted_one_by_one():
    import numpy as np

    lexicon = ["nasty", "grim"]
    keys = np.sort(np.concatenate([toxicity._word_hashes(lexicon)]))
    texts = [
        "You are NASTY, so nasty!!!", "", "x" * 5000, "grim" + "!" * 9 + " day", "***grim*** (you)", "n.a.s.t.y words GRIM2 AB ABC",
        "!!! ??? .", "a\n\tb grim  c d e f g h your",
    ]
    got = toxicity.features([t.encode() for t in texts], (keys, np.ones(len(keys))))
    of = {name: got[:, k] for k, name in enumerate(toxicity.NAMES)}
    for k, text in enumerate(texts):
        words = _plain_tokens(text)
        n = max(1, len(words))
        bad = [w in lexicon for w in words]
        you = [w in toxicity.YOU for w in words]
        near = [b and any(you[max(0, i - 5) : i + 6]) for i, b in enumerate(bad)]
        assert of["learned"][k] == sum(bad) / n and of["you"][k] == sum(you) / n, text
        assert of["near_you"][k] == sum(near) / n and of["any_learned"][k] == min(4, sum(bad)), text
        raw = max(1, len(text.encode()))
        assert of["capitals"][k] == sum("A" <= c <= "Z" for c in text) / raw
        assert of["exclaims"][k] == text.count("!") / raw


def test_toxic_lexicon_is_cross_fitted_at_every_size(spark, monkeypatch):
    """A few rows of a label are enough, and no row's features come from entries it taught."""
    taught = []
    plain = toxicity.learn_lexicon

    def watched(train):
        taught.append({r["doc_id"] for r in train.select("doc_id").collect()})
        return plain(train)

    monkeypatch.setattr(toxicity, "learn_lexicon", watched)
    rows = [(i, "you vile wretch " * 3 if i % 4 == 0 else f"calm words of day {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    scored = {r["doc_id"]: r for r in toxicity.score_rows(docs, marks).collect()}
    first, second, every = taught
    assert not first & second and first | second == every and min(len(first), len(second)) > 10
    held = [r for r in scored.values() if r["held_out"]]
    assert held and all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)


def test_votes_as_counted_one_by_one():
    """Neighbours, their weights and what ties share, against plain loops."""
    import numpy as np

    rng = np.random.default_rng(8)
    known = quality_knn.unit(rng.integers(-2, 3, (90, 6)).astype(np.float64))  # few values: many ties
    labels = rng.integers(0, 2, 90).astype(float)
    latent = rng.integers(-2, 3, (40, 6)).astype(np.float64)
    got = quality_knn.vote(latent, known, labels, 0.25)
    similar = np.maximum(quality_knn.unit(latent) @ known.T, 0)
    for row, score in zip(similar, got, strict=True):
        order = sorted(range(90), key=lambda i: -row[i])
        last = row[order[quality_knn.NEIGHBOURS - 1]]
        near, tied = [i for i in order if row[i] > last], [i for i in order if row[i] == last]
        votes = dict.fromkeys(near, 1.0) | dict.fromkeys(tied, (quality_knn.NEIGHBOURS - len(near)) / len(tied))
        total = sum(v * row[i] ** quality_knn.SHARPNESS for i, v in votes.items())
        want = sum(v * row[i] ** quality_knn.SHARPNESS * labels[i] for i, v in votes.items()) / total if total else 0.25
        assert abs(score - want) < 1e-9


def test_quality_of_a_table_as_one_block(spark, messy, labels, monkeypatch):
    """Counted and voted in slices of two, or all at once: the same scores."""
    every = sorted((r["doc_id"] or 0, r["score"]) for r in quality_knn.score(messy, labels).collect())
    monkeypatch.setattr(quality_knn, "ROWS", 2)
    two = sorted((r["doc_id"] or 0, r["score"]) for r in quality_knn.score(messy, labels).collect())
    assert [a for a, _ in every] == [a for a, _ in two]
    assert all(abs(a - b) < 1e-6 for (_, a), (_, b) in zip(every, two, strict=True))


def test_toxicity_sends_a_text_once_and_looks_at_few_bytes_together(spark, monkeypatch):
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from ledgerline.llm import kernel

    rng = random.Random(3)
    listed = ["".join(rng.choices("abcdefghij!", k=rng.randint(1, 9))) for _ in range(900)]
    texts = [" ".join(rng.choices(listed, k=400)) for _ in range(700)] + [None, "", "x"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "label": pa.array([i % 2 for i in range(len(texts))])})
    lexicon = (np.sort(kernel.words([" ".join(listed[:40]).encode()]).hash), np.linspace(0, 1, 40))
    kernel.powers(1)
    for run in (toxicity._featurise(lexicon, "text"), toxicity._keys):
        tracemalloc.start()
        for _ in run([batch]):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60e6, peak
    out = pa.Table.from_batches(list(toxicity._featurise(lexicon, "text")([batch])))
    assert out["text"].to_pylist() == texts
    whole = toxicity.features([(t or "").encode() for t in texts], lexicon)
    assert np.array_equal(np.stack([out[c].to_numpy() for c in toxicity._COLUMNS], axis=1), whole)

    sent = []
    plain = toxicity._with_features
    monkeypatch.setattr(toxicity, "_with_features", lambda rows, *a: sent.append(rows.columns) or plain(rows, *a))
    docs = spark.createDataFrame([(i, f"word{i % 7} you fool" if i % 2 else f"word{i % 7} and tea", i) for i in range(60)], "doc_id bigint, text string, `n.x` bigint")
    marked = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic bigint")
    scored = toxicity.score_rows(docs, marked)
    assert sent[-1] == ["doc_id", "text", "__c2"] and scored.columns[:3] == docs.columns
    assert {(r[0], r[1], r[2]) for r in scored.collect()} == {tuple(r) for r in docs.collect()}
    other = toxicity.score_rows(docs.withColumn("text", docs.text.cast("binary")), marked)
    assert sorted(map(tuple, other.select("doc_id", "score").collect())) == sorted(map(tuple, scored.select("doc_id", "score").collect()))
