import random


from ledgerline.llm import substring_dedup as s

from . import brute


def _docs():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdefgh", k=4))

    def sentence(lo=2, hi=18):
        return " ".join(word() for _ in range(rnd.randint(lo, hi))).capitalize() + rnd.choice([".", "!", "?", '."'])

    passages = [" ".join(sentence() for _ in range(6)) for _ in range(4)] + [sentence(55, 60)]
    docs = []
    for _ in range(40):
        parts = [sentence() for _ in range(rnd.randint(1, 8))]
        for _ in range(rnd.choice([0, 1, 1, 2])):
            parts.insert(rnd.randint(0, len(parts)), rnd.choice(passages))
        docs.append(rnd.choice([" ", "\n", "  "]).join(parts))
    docs += [docs[0], "", " \n ", "Yes. No.", "Yes. No."]
    return list(enumerate(docs)), passages


def test_same_texts_as_brute_force(spark):
    docs, _ = _docs()
    got = s.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == brute.without_passages(docs)


def test_passages_stay_once(spark):
    docs, passages = _docs()
    got = [r["text"] for r in s.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    for p in passages:
        assert sum(" ".join(p.split()) in " ".join(t.split()) for t in got) == 1


def test_passages_set_in_mid_sentence(spark):
    """A capital after a word in lower case begins a sentence, so a passage set into one goes whole."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefgh", k=6))
    some = lambda n: " ".join(word() for _ in range(n))
    passage = " ".join(some(18).capitalize() + "." for _ in range(3))
    tail = f"{some(20)}. {some(16).capitalize()}. {some(20).capitalize()}"  # begins and ends within sentences
    one = some(16).capitalize() + "."
    short = " ".join(some(13).capitalize() + "." for _ in range(2))  # two sentences, neither long by itself
    few = some(14).capitalize() + "."  # neither a run nor long
    docs = [(k, f"{some(9)} {p} {some(9)} end.") for k, p in enumerate([passage, passage, tail, tail, one, one, short, short, few, few])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in s.remove_repeats(df).collect()}
    for k, words, sentences in ((1, 54, 3), (5, 16, 1), (7, 26, 2)):
        assert got[k - 1]["text"] == docs[k - 1][1] and len(got[k]["text"].split()) == 19
        assert (got[k]["n_removed_words"], got[k]["n_removed_sentences"]) == (words, sentences)
    # Only the sentence between: the pieces at the ends belong to the hosts' sentences.
    assert got[3]["n_removed_words"] == 16 and got[3]["n_removed_sentences"] == 1
    assert got[9]["text"] == docs[9][1]
    assert {i: r["text"] for i, r in got.items()} == brute.without_passages(docs)


def test_shared_sentences_and_no_shared_words_around(spark):
    """What goes is whole sentences: words shared by different sentences stay."""
    rnd = random.Random(12)
    some = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n))
    both, head = f"{some(13).capitalize()}. {some(13).capitalize()}.", some(15).capitalize()
    docs = [(k, f"{some(5).capitalize()}. {both} {some(4).capitalize()}.") for k in range(2)]
    docs += [(k, f"{some(5).capitalize()}. {head} {some(6)}.") for k in (2, 3)]
    got = {r["doc_id"]: r for r in s.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1]["n_removed_sentences"] == 2 and got[3]["text"] == docs[3][1]


def test_registered_query_is_the_brute_force(spark):
    """The registered path over a whole given table."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["doc_id"]: r["text"] for r in s.query(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute.without_passages(docs)


def test_messy(spark, messy):
    out = s.remove_repeats(messy)
    rows = out.collect()
    assert len(rows) == messy.count() and set(messy.columns) <= set(out.columns)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[2]["text"] is None and by[3]["text"] == "" and by[4]["text"] == " \t\n "
    assert by[7]["text"] == "" and by[7]["n_removed_words"] == 48  # one long sentence, a copy of document 1
    assert len(by[5]["text"]) < 300  # repeats within one document go too


def test_empty(spark, messy):
    assert s.remove_repeats(messy.limit(0)).count() == 0
