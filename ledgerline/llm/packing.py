"""Packing (operator 8): vector bin packing of token sequences by the dot-product heuristic.

Examples are placed under three limits at once: tokens, segments (pieces in a sequence) and
loss-bearing tokens.  A sequence is filled by taking, again and again, the example whose demand
vector has the largest dot product with what the sequence has left; longer examples are first cut
into full sequences.  With ``cut`` (plain documents) a gap that no whole example fits is closed
with the head of the longest one left, so every sequence but the last of a task is full, and the
last is dealt out over lengths that are powers of two, which need no padding.  Without ``cut``
(instruction data) an example within the limits stays whole, and a longer one is cut at the
limits only.

Packing needs no shuffle: every task packs the rows of its input split in pools of bounded size
and hands the unfilled rest of a pool to the next.  sequence_id holds the task's number in its
high bits.  A task that runs again reads the same split and gives the same rows.

Token ids are the tokenizer's own, found the quick way: white space never lies in a token of this
vocabulary, so ids are made per blank-separated part and remembered in a bounded table.

Defined cases.  A null or empty text is a document of the end token alone.  Repeated rows and rows
without doc_id are documents like others.  Very long texts are encoded whole.  Of examples with equal
products the first of the longest comes first.  An empty table gives no rows.  Extra columns are not
looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import slices
from .tables import table

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
END_ID = 1
#: A pool is packed when it holds this many documents or this many bytes of ids.
POOL_ROWS = 2048
POOL_BYTES = 16 << 20
REMEMBERED = 150_000
# Fixed value: the split pattern that the vocabulary file names.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Ids:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.split = regex.compile(SPLIT)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unusual = re.compile("|".join(["[\x1c-\x1f\u0130\u0250-\U0010ffff]", *special]))
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in shown]
        self.byte_names = {b: 256 + i for i, b in enumerate(rest)}  # bytes without a printable sign of their own
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _exact(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one match of the split pattern, in lower case."""
        name = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.byte_names)
        return array("I", [t.id for t in self.model.tokenize(name)]).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of a lower-case part that is not among the young entries."""
        known = self.old.get(part)
        if known is None:
            if part.isalpha():
                known = self._word(part)
            elif (word := part[:-1]).isalpha():  # a word and one sign
                known = (self.young.get(word) or self._part(word)) + (self.young.get(part[-1]) or self._part(part[-1]))
            else:
                known = b"".join(map(self._word, self.split.findall(part)))
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[part] = known
        return known

    def __call__(self, text: str) -> bytes:
        # Below U+0250, but for a capital that becomes two signs, lower case is sign by sign, no two
        # signs compose and the split pattern is plain.  Python's split() also breaks at the four
        # ASCII separators, which are no white space to the tokenizer.  Other texts, and texts with
        # a special token's string, go through the whole tokenizer.
        if self.unusual.search(text):
            return self._exact(text)
        known, part = self.young.get, self._part
        return b"".join([known(p) or part(p) for p in text.lower().split()])


_LOADED: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _LOADED:
        _LOADED[path] = Ids(path)
    return _LOADED[path]


@dataclass
class Limits:
    tokens: int = MAX_TOKENS
    segments: int = MAX_SEGMENTS
    loss: int = MAX_TOKENS
    cut: bool = True


@dataclass
class Pool:
    """Pieces that wait for a sequence: document, first id, length, and where the document's
    loss-bearing ids begin."""

    limits: Limits
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    length: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    loss_from: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, docs: np.ndarray, lengths: np.ndarray, loss_from: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Adds whole documents; the full sequences cut from the long ones come back at once."""
        limit, full = self.limits, []
        start = np.zeros(len(docs), np.int64)
        for k in np.flatnonzero((lengths > limit.tokens) | (lengths - loss_from > limit.loss)):
            n, at, bearing = int(lengths[k]), 0, int(loss_from[k])
            while (end := min(at + limit.tokens, max(at, bearing) + limit.loss)) < n:
                full.append([(int(docs[k]), at, end - at)])
                at = end
            start[k] = at
        self.doc = np.concatenate([self.doc, docs])
        self.start = np.concatenate([self.start, start])
        self.length = np.concatenate([self.length, lengths - start])
        self.loss_from = np.concatenate([self.loss_from, loss_from])
        return full

    def sequences(self, last: bool) -> Iterator[list[tuple[int, int, int]]]:
        """Sequences of (document, first id, length).  Unless ``last``, what can't fill one stays."""
        limit = self.limits
        order = np.argsort(-self.length, kind="stable")
        doc, start, length = self.doc[order], self.start[order], self.length[order]
        loss_from = self.loss_from[order]
        loss = length - np.clip(loss_from - start, 0, length)
        free = np.ones(len(doc), bool)
        scale = np.array([1 / limit.tokens, 1 / limit.segments, 1 / limit.loss])
        while free.any():
            if not last and length[free].sum() < 2 * limit.tokens:
                break
            room = np.array([limit.tokens, limit.segments, limit.loss], np.int64)
            pieces = []
            while True:
                ok = np.flatnonzero(free & (length <= room[0]) & (loss <= room[2])) if room[1] > 0 else ()
                if not len(ok):
                    break
                weight = room * scale * scale
                k = ok[np.argmax(length[ok] * weight[0] + weight[1] + loss[ok] * weight[2])]
                pieces.append((int(doc[k]), int(start[k]), int(length[k])))
                free[k] = False
                room -= (length[k], 1, loss[k])
            gap = int(min(room[0], room[2])) if limit.cut and room[1] > 0 else 0
            if gap and free.any():
                k = int(np.flatnonzero(free)[0])
                k = int(np.argmax(np.where(free, length, -1)))
                pieces.append((int(doc[k]), int(start[k]), gap))
                start[k] += gap
                length[k] -= gap
                loss[k] = length[k] - min(max(loss_from[k] - start[k], 0), length[k])
            yield pieces
        self.doc, self.start, self.length, self.loss_from = doc[free], start[free], length[free], loss_from[free]


def powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of one sequence dealt out over sequences whose lengths are powers of two."""
    total = sum(p[2] for p in pieces)
    left = list(pieces)
    for bit in reversed(range(total.bit_length())):
        want, out = total & (1 << bit), []
        while want:
            doc, start, n = left.pop(0)
            if n > want:
                left.insert(0, (doc, start + want, n - want))
                n = want
            out.append((doc, start, n))
            want -= n
        if out:
            yield out


def _packer(path: str, limits: Limits, with_ids: bool):
    def rows(sequences, number, keys, ids):
        for pieces in sequences:
            offset = 0
            for doc, start, n in pieces:
                cut = ids[doc][4 * start : 4 * (start + n)]
                key, total = keys[doc]
                yield (key, start, n, zlib.crc32(cut), total, number, offset, *([cut] if with_ids else []))
                offset += n
            number += 1

    def run(batches):
        encode = ids_of(path)
        end = np.array([END_ID], "<u4").tobytes()
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        pool, keys, ids, fresh, waiting, next_doc = Pool(limits), {}, {}, [], 0, 0

        def pack(last):
            nonlocal pool, keys, ids, fresh, waiting, number
            docs = np.array([f[0] for f in fresh], np.int64)
            lengths = np.array([f[1] for f in fresh], np.int64)
            found = pool.add(docs, lengths, np.array([f[2] for f in fresh], np.int64))
            found += list(pool.sequences(last))
            if limits.cut:
                short = [sum(p[2] for p in own) < limits.tokens for own in found]
                found = [p for own, less in zip(found, short) for p in (powers_of_two(own) if less else [own])]
            out = list(rows(found, number, keys, ids))
            number += len(found)
            left = set(pool.doc.tolist())
            keys, ids = {k: keys[k] for k in left}, {k: ids[k] for k in left}
            fresh, waiting = [], 0
            return out

        for batch in slices(batches, 512):
            texts, names = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            prompts = batch.column("prompt").to_pylist() if "prompt" in batch.schema.names else None
            for k, (name, text) in enumerate(zip(names, texts, strict=True)):
                prompt = encode(prompts[k]) if prompts and prompts[k] else b""
                own = prompt + encode(text or "") + end
                keys[next_doc], ids[next_doc] = (name, len(own) // 4), own
                fresh.append((next_doc, len(own) // 4, len(prompt) // 4))
                next_doc += 1
                waiting += len(own)
                if len(fresh) >= POOL_ROWS or waiting >= POOL_BYTES:
                    yield _batch(pack(False), with_ids)
        yield _batch(pack(True), with_ids)

    return run


_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = [pa.int64()] * len(names)
    if with_ids:
        names, kinds = [*names, "ids"], [*kinds, pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pack(
    docs: DataFrame, tokenizer: str, limits: Limits | None = None, prompt: str | None = None, with_ids: bool = True
) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text and, for instruction data, a column of prompts
    whose ids bear no loss): where it lies in its document and in its sequence, and its ids."""
    columns = [F.col("doc_id").cast("bigint"), F.col("text").cast("string")]
    if prompt:
        columns.append(F.col(prompt).cast("string").alias("prompt"))
    return docs.select(*columns).mapInArrow(
        _packer(tokenizer, limits or Limits(), with_ids), _SCHEMA + (", ids binary" if with_ids else "")
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)
