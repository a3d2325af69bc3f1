"""Substring dedup (operator 10): sliding spans of whole sentences.

Every run of several consecutive sentences that is long enough is hashed, the hashes are joined over all
documents, and sentences covered by a repeated run that is not the run's first occurrence
(smallest doc_id, then position) are removed.  The rest of a text stays byte for byte, but for white
space left at the end.

A sentence ends with a line break, a word that ends in ``.``, ``!``, ``?`` (closing quotes or
brackets may follow), or before a capital that follows a word in lower case: there a passage may
have been set into a sentence.  The runs are, from each sentence on and up to each, the shortest of at
least ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words; and a sentence of ``LONG_SENTENCE`` words by
itself.  A longer repeated run is covered by the shortest ones within it, so its sentences all go.  Of a
passage set into other sentences, the pieces at its two ends stay with their hosts where no sentence
ends or begins.

A run is known by 128 bits (two independent hashes of its words) and its number of words.

Defined cases.  Null, empty or blank texts have no sentence and come back as they are, as do texts
with nothing to remove.  Very long texts are read whole.  Rows that share a doc_id count as one document
(its first occurrences stay in each); rows without doc_id come first of all and are never changed.
An empty table gives no rows.  Extra columns are unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import Words, chunks, mix, powers, slices, text_bytes, words
from .tables import kept, numbered, table

MIN_SENTENCES = 2
MIN_WORDS = 25
LONG_SENTENCE = 15
_SECOND = np.uint64(0x2545F4914F6CDD1D)
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_CLOSER = np.zeros(256, bool)
_CLOSER[list(b"\"')]")] = True


def sentence_starts(w: Words) -> np.ndarray:
    """Index of the first word of every sentence of a chunk."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    last = w.data[w.end - 1]
    before = w.data[np.maximum(w.end - 2, 0)]
    stop = _STOP[last] | (_CLOSER[last] & _STOP[before] & (w.end - w.start > 1))
    breaks = np.cumsum(w.data == 10)
    new = np.ones(len(w.start), bool)
    new[1:] = stop[:-1] | (breaks[w.start[1:]] > breaks[w.end[:-1] - 1]) | (w.text[1:] != w.text[:-1])
    # By the first character, of ASCII and Latin-1: a capital after a word in lower case.
    head, lead = w.data[w.start], w.data[w.start + 1]
    low = (head >= 97) & (head <= 122) | (head == 0xC3) & (lead >= 0x9F)
    capital = (head >= 65) & (head <= 90) | (head == 0xC3) & (lead >= 0x80) & (lead <= 0x9E)
    new[1:] |= low[:-1] & capital[1:]
    return np.flatnonzero(new)


def _hashed(w: Words, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, second hash, text, first word, word after the last) of every different run; words count
    from 0 per text."""
    n = np.int64(len(w.start) + 1)
    key = np.unique(a * n + b)
    a, b = key // n, key % n
    power, inverse = powers(len(w.hash))
    hashes = []
    for words_ in (w.hash, mix(w.hash ^ _SECOND)):
        total = np.zeros(len(w.hash) + 1, np.uint64)
        np.cumsum(words_ * power, out=total[1:])
        hashes.append(mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64)))
    first = w.bounds[w.text[a]]
    return *hashes, w.text[a], a - first, b - first


def runs(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``_hashed`` runs of whole sentences: the shortest from each sentence on, the shortest up to each, and
    long sentences by themselves."""
    at = sentence_starts(w)
    n = len(at)
    if not n:
        return _hashed(w, at, at)
    edge = np.append(at, len(w.start))
    text = w.text[at]
    first = np.searchsorted(text, text)  # first sentence of the text
    last = np.searchsorted(text, text, side="right") - 1
    index = np.arange(n)
    # Shortest run from a sentence on: up to the sentence in which the needed word lies.
    upto = np.maximum(np.searchsorted(edge, edge[:-1] + MIN_WORDS, side="left") - 1, index + MIN_SENTENCES - 1)
    # Shortest run that ends with a sentence.
    since = np.minimum(np.searchsorted(edge, edge[1:] - MIN_WORDS, side="right") - 1, index - MIN_SENTENCES + 1)
    forth, back = upto <= last, since >= first
    alone = np.flatnonzero(np.diff(edge) >= LONG_SENTENCE)
    i = np.concatenate([index[forth], since[back], alone])
    j = np.concatenate([upto[forth], index[back], alone])
    return _hashed(w, edge[i], edge[j + 1])


_RUNS = "run bigint, check bigint, doc_id bigint, i int, j int"


def _runs(batches):
    for batch in slices(batches, 1024):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for at, group in chunks(text_bytes(batch.column("text"))):
            hashed, second, text, i, j = runs(words(group, lower=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashed.view(np.int64)), pa.array(second.view(np.int64)), pa.array(ids[at + text], pa.int64()),
                    pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                ],
                names=["run", "check", "doc_id", "i", "j"],
            )


def without(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the words of the ranges; how many whole sentences and words went."""
    w = words([text])
    gone = np.zeros(len(w.start), bool)
    for i, j in ranges:
        gone[i:j] = True
    if not gone.any():
        return text, 0, 0
    edge = np.append(w.start, len(text))
    # Kept words in stretches: where one begins and the word after its last.
    turns = np.flatnonzero(np.diff(np.concatenate([[False], ~gone, [False]]).astype(np.int8)))
    parts = [text[: edge[0]]] + [text[edge[i] : edge[j]] for i, j in zip(turns[::2], turns[1::2], strict=True)]
    n_sentences = np.logical_and.reduceat(gone, sentence_starts(w)).sum()
    return b"".join(parts).rstrip(b" \t\n\r\x0b\x0c"), int(n_sentences), int(gone.sum())


def _cut(batches):
    for batch in slices(batches):
        texts = text_bytes(batch.column("text"))
        out, n_sentences, n_words = [], [], []
        for text, ranges in zip(texts, batch.column("__ranges").to_pylist(), strict=True):
            new, s, n = without(text, [(r["i"], r["j"]) for r in ranges]) if text and ranges else (text, 0, 0)
            out.append(new)
            n_sentences.append(s)
            n_words.append(n)
        columns = {name: batch.column(name) for name in batch.schema.names if name != "__ranges"}
        columns |= {
            "text": pa.array(out, pa.binary()).cast(pa.string()), "n_removed_sentences": pa.array(n_sentences, pa.int64()),
            "n_removed_words": pa.array(n_words, pa.int64()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, ranges): word ranges to remove, for the documents that have some.

    The first occurrence of a run is a partial aggregate over its hashes, so a run that occurs in
    every document is combined before the shuffle; the join back is a plain equi-join that AQE
    can split.  A document's ranges are at most as many as its sentences, three times.
    """
    ids = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter("doc_id IS NOT NULL")
    found = kept(ids.mapInArrow(_runs, _RUNS), "runs")
    first = found.groupBy("run", "check").agg(F.min(F.struct("doc_id", "i")).alias("first"), F.count(F.lit(1)).alias("n"))
    # Written, so that the join below has a shuffle of its own, which AQE can split.
    first = kept(first.filter("n > 1").select("run", "check", "first"), "repeated-runs")
    again = found.join(first, ["run", "check"]).filter(F.struct("doc_id", "i") != F.col("first"))
    return again.groupBy("doc_id").agg(F.collect_set(F.struct("i", "j")).alias("__ranges"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages removed from ``text``, and what was removed counted in
    ``n_removed_sentences`` and ``n_removed_words``."""
    counts = ["n_removed_sentences", "n_removed_words"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in [*counts, "__ranges"]])
    docs, names = numbered(docs.withColumn("text", F.col("text").cast("string")), ("doc_id", "text"))
    ranges = kept(repeated_ranges(docs), "ranges").withColumnRenamed("doc_id", "__doc_id")
    both = docs.join(ranges, F.col("doc_id") == F.col("__doc_id"), "left").drop("__doc_id")
    schema = docs.withColumns({c: F.lit(0).cast("bigint") for c in counts}).schema
    out = both.mapInArrow(_cut, schema)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], *counts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "text", "n_removed_sentences", "n_removed_words")
