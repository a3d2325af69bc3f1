import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing as p

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(p.vocabulary())


def _sequences(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["sequence_id"]].append(r)
    for pieces in out.values():
        pieces.sort(key=lambda r: r["offset"])
    return out


def test_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = p.pack(docs, p.vocabulary()).collect()
    ids = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [p.END_ID] for r in docs.collect()}
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids"] == own and r["ids_crc32"] == zlib.crc32(own) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert pieces.keys() == ids.keys()
    for doc, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == len(ids[doc])
    padded = 0
    for own in _sequences(rows).values():
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= p.MAX_TOKENS and len(own) <= p.MAX_SEGMENTS
        padded += 0 if at & (at - 1) == 0 else p.MAX_TOKENS - at
    assert padded == 0


def test_ids_are_the_tokenizers(tokenizer):
    import random

    rnd, quick = random.Random(2), p.Ids(p.vocabulary())
    for pool in ("abc XYZ'sT ll 12\t\n\xa0éÉüß.,!?", "İIΣσ áé  \x85\x1c\x1f​　a1٠中文𝔘", "it's I'LL 'S <|endoftext|> ### %%% don't"):
        for _ in range(800):
            s = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25)))
            want = np.array(tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
            assert quick(s) == want


def test_instruction_data_stays_whole(spark):
    rows = [(i, "answer words here " * (1 + i % 9), "please say " * (i % 4) or None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ask string").coalesce(1)
    limits = p.Limits(tokens=128, segments=5, loss=60, cut=False)
    packed = p.pack(df, p.vocabulary(), limits, prompt="ask").collect()
    assert sorted(r["doc_id"] for r in packed) == list(range(300))
    prompts = {i: 2 * (i % 4) for i in range(300)}
    for own in _sequences(packed).values():
        assert sum(r["length"] for r in own) <= 128 and len(own) <= 5
        assert sum(r["length"] - prompts[r["doc_id"]] for r in own) <= 60


def test_prompts_longer_than_the_loss_limit_stay_whole(spark, tokenizer):
    """Only what bears a loss counts for that limit; what exceeds one is cut where it is reached."""
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    rows = [(0, "a " * 9, "please say " * 45), (1, "a " * 99, "please say " * 10), (2, "a " * 9, "please say " * 100), (3, "a " * 200, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ask string").coalesce(1)
    limits = p.Limits(tokens=128, segments=5, loss=60, cut=False)
    packed = p.pack(df, p.vocabulary(), limits, prompt="ask").collect()
    sizes = {i: (count(ask or ""), count(ask or "") + count(text) + 1) for i, text, ask in rows}
    want = {}
    for i, (prompt, n) in sizes.items():
        at, want[i] = 0, []
        while at < n:
            end = at
            while end < n and end - at < 128 and max(0, end + 1 - max(at, prompt)) <= 60:
                end += 1
            want[i].append((at, end - at))
            at = end
    got = {i: sorted((r["start"], r["length"]) for r in packed if r["doc_id"] == i) for i in sizes}
    assert got == want and len(want[0]) == 1 and len(want[1]) == 2 and len(want[2]) == 2
    for own in _sequences(packed).values():
        assert sum(r["length"] for r in own) <= 128
        loss = [max(0, r["start"] + r["length"] - max(r["start"], sizes[r["doc_id"]][0])) for r in own]
        assert sum(loss) <= 60


def test_short_documents_leave_no_padding(spark):
    """Sequences that have all their segments long before they are full."""
    rows = [(i, "a " * (i % 5)) for i in range(20_000)]
    packed = p.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), p.vocabulary(), with_ids=False).collect()
    total = 0
    for own in _sequences(packed).values():
        n = sum(r["length"] for r in own)
        assert n & (n - 1) == 0 and len(own) <= p.MAX_SEGMENTS
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        total += n
    assert total == sum(i % 5 + 1 for i in range(20_000))


def test_messy(spark, messy):
    rows = p.pack(messy, p.vocabulary()).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    tokens = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert tokens[2] == tokens[3] == tokens[4] == 1
    total = {i: sum(r["length"] for r in rows if r["doc_id"] == i) for i in tokens}
    assert total[1] == 2 * tokens[1] and total[5] == tokens[5] and total[None] == 1 + 2


def test_empty(spark, messy):
    assert p.pack(messy.limit(0), p.vocabulary()).count() == 0
