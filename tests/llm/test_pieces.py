import hashlib
import random
import zlib

import numpy as np
import sentencepiece

from ledgerline.llm import pieces as p


def _texts():
    rnd = random.Random(4)
    out = ["", " ", "  a  b ", "▁x", "a▁b", "<s> </s> <unk> <0x41>", "\n\nzz\t", "\x00a", "abcdefgh" * 400]
    for pool in ("ab cde the ▁ \n\t12é", "中文 𝔘😀 a\x00\x7f ", "   ▁▁x", "The quick, brown fox's 3.14!\r\n"):
        out += ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    return out


def test_ids_spans_and_text_are_the_librarys():
    library = sentencepiece.SentencePieceProcessor(model_file=p.vocabulary())
    model = p.model_of(p.vocabulary())
    texts = _texts()
    for t, (n, ids, decoded) in zip(texts, model.round_trips(texts), strict=True):
        want = library.encode(t)
        assert (n, ids, decoded) == (len(want), ",".join(map(str, want)), library.decode(want))
        found = model.encode(t)
        assert [f[0] for f in found] == want and model.decode(want) == library.decode(want)
        for (i, begin, end), piece in zip(found, library.encode(t, return_type="proto").pieces, strict=True):
            if not library.is_byte(i):
                assert (begin, end) == (piece.begin, piece.end)  # bytes, there too


def test_character_map_replaces_the_longest_prefix():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    model = p.PieceModel(library.serialized_model_proto())
    rnd = random.Random(6)
    texts = ["ｱｲ①  ﬁé Ⅷ  ", "　a　", "  ﷺ x", "カ゛\t\nx ", "", "   "]
    blocks = [(0x20, 0x3FF), (0x1E00, 0x33FF), (0xF900, 0xFFEF)]
    texts += ["".join(chr(rnd.randint(*rnd.choice(blocks))) for _ in range(30)) for _ in range(500)]
    for t in texts:
        normal, source = model.normalise(t)
        assert normal == library.normalize(t)
        assert len(source) == len(normal) + 1 and source == sorted(source) and source[-1] <= len(t.encode())


def test_alignment_reaches_the_source():
    model = p.PieceModel(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    normal, source = model.normalise("x ﬁ  Ⅷ")  # ligature: 3 bytes at 2; two blanks at 5; numeral: 3 bytes at 7
    assert normal == "▁x▁fi▁VIII"
    assert source == [0, 0, 1, 2, 2, 5, 7, 7, 7, 7, 10]


def test_messy(spark, messy):
    library = sentencepiece.SentencePieceProcessor(model_file=p.vocabulary())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = p.digests(messy, p.vocabulary()).collect()
    want = []
    for r in messy.collect():
        ids = library.encode(r["text"] or "")
        spans = np.array([s[1:] for s in p.model_of(p.vocabulary()).encode(r["text"] or "")], "<u4")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), zlib.crc32(spans.tobytes())))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    spans = {r["doc_id"]: r["pieces"] for r in p.encode(messy.filter("doc_id = 8"), p.vocabulary()).collect()}[8]
    assert spans[0]["begin"] == 0 and spans[-1]["end"] == len(messy.filter("doc_id = 8").first()["text"].encode())


def test_pieces_of_a_mapped_text_reach_the_source():
    """A model with a character map: the spans of plain pieces cut the source where the map took from it."""
    library = sentencepiece.SentencePieceProcessor(model_file=p.vocabulary())
    model = p.PieceModel(library.serialized_model_proto())
    model.map = p.PieceModel(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()).map
    for text in ("x ﬁ Ⅷ ｱ", "①②", "plain words", "", "é ﬁﬁ"):
        normal, source = model.normalise(text)
        found = model.encode(text)
        assert [f[0] for f in found] == (library.encode(normal[1:].replace(p.SPACE, " ")) if normal else [])
        assert all(b <= e for _, b, e in found) and [f[1] for f in found] == sorted(f[1] for f in found)
        assert not found or (found[0][1] == 0 and found[-1][2] == len(text.encode()))


def test_remembered_parts_give_the_same_pieces():
    model = p.PieceModel(sentencepiece.SentencePieceProcessor(model_file=p.vocabulary()).serialized_model_proto())
    texts = _texts()
    first, again = model.aligned(texts), model.aligned(texts[::-1])[::-1]
    one = [model.aligned([t])[0] for t in texts]
    for a, b, c in zip(first, again, one, strict=True):
        assert all((x == y).all() and (x == z).all() for x, y, z in zip(a, b, c, strict=True))


def test_empty(spark, messy):
    assert p.digests(messy.limit(0), p.vocabulary()).count() == 0
