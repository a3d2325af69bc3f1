"""Quality classifier (operator 4): nearest-neighbour voting in a latent-semantic space.

A text is a vector of hashed terms (words, the signs and case that words bear, doubled words, and
bands of text-level rates such as distinct words or repeated lines), weighted by log counts and
inverse document frequency.  A truncated singular value decomposition of the training rows gives
the latent space.  The training rows' latent vectors are broadcast (at most ``SAMPLE`` x
``DIMENSIONS`` floats), every document's cosine to each of them is computed in blocks, and the
``NEIGHBOURS`` nearest vote with their similarity as the weight.  Where several are equally near and
only some of them fit, they share the votes that are left.

The training rows are labelled rows outside the held-out fold, at most ``SAMPLE`` of them, those
with the lowest hash of doc_id; term weights and space are part of the model fitted on them.
Labels, lang, source and doc_id are no inputs of a score.

Defined cases.  A null or empty text, or one without a known term, gets the training rows' share of
label 1, as does every text if there are fewer than two training rows (0 without any).  Very long
texts are read whole, short ones at most ``ROWS`` at a time (a row of counts each).  Rows without a
label, or whose label is null, teach nothing; of a doc_id labelled twice the higher label counts, and
of one with different texts the first in binary order is read.  An empty table gives no rows.  Extra
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import chunks, mix, slices, text_bytes, words
from .tables import held_out, kept, table, training_rows

SAMPLE = 4096
DIMENSIONS = 48
NEIGHBOURS = 32
#: Similarities are raised to this power before they vote.
SHARPNESS = 4
CUT = 0.3
#: Texts counted at a time.
ROWS = 256
_WORD_TERMS = 2048
_SHAPE_TERMS = 512
_BANDS = 16
_RATES = ["length", "distinct", "symbols", "capitals", "digits", "word_length", "repeated_lines", "repeated_triples"]
TERMS = _WORD_TERMS + _SHAPE_TERMS + _BANDS * len(_RATES)
#: Weight of a text-level band against a term that occurs once.
_BAND_WEIGHT = 3.0

_U = np.uint64
_KIND = np.zeros(256, np.uint8)  # 0 other signs, 1 lower letters, 2 capitals, 3 digits
_KIND[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[list(range(0x41, 0x5B))] = 2
_KIND[list(range(0x30, 0x3A))] = 3


def _distinct(text: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each of ``n`` texts."""
    order = np.lexsort((keys, text))
    t, k = text[order], keys[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    return np.bincount(t[new], minlength=n)


def counts(texts: list[bytes]) -> np.ndarray:
    """Term counts of a chunk of texts, one row each; bands of rates count once."""
    w = words(texts)
    n = len(texts)
    lower = words(texts, lower=True)
    cells = [w.text * TERMS + (lower.hash % _U(_WORD_TERMS)).astype(np.int64)]
    kind = _KIND[w.data]
    up = np.append(0, np.cumsum(kind == 2))
    low = np.append(0, np.cumsum(kind == 1))
    signs = np.append(0, np.cumsum((kind == 0) & (w.data > 32)))
    digits = np.append(0, np.cumsum(kind == 3))
    span = lambda c: c[w.end] - c[w.start]
    # The shape of a word: its last two bytes if they are signs, which letters it has, whether it
    # repeats the word before it.
    last, before = w.data[w.end - 1].astype(np.int64), w.data[np.maximum(w.end - 2, w.start)].astype(np.int64)
    tail = np.where(kind[w.end - 1] == 0, last * 256 + np.where(kind[np.maximum(w.end - 2, w.start)] == 0, before, 0), 0)
    again = np.zeros(len(w.hash), np.int64)
    again[1:] = (lower.hash[1:] == lower.hash[:-1]) & (w.text[1:] == w.text[:-1])
    case = np.minimum(span(up), 2) * 3 + np.minimum(span(low), 2)
    shape = mix((tail * 64 + case * 4 + again * 2 + (span(signs) == w.end - w.start)).astype(np.uint64) + _U(1))
    cells.append(w.text * TERMS + _WORD_TERMS + (shape % _U(_SHAPE_TERMS)).astype(np.int64))
    out = np.bincount(np.concatenate(cells), minlength=n * TERMS).reshape(n, TERMS).astype(np.float32)

    n_words = np.diff(w.bounds)
    some = np.maximum(n_words, 1)
    length = np.maximum(np.diff(np.append(w.first, len(w.data))) - 1, 1)
    per = lambda c: c[np.append(w.first[1:], len(w.data))] - c[w.first]
    triple = np.zeros(n)
    if len(lower.hash) > 2:
        t = mix(lower.hash[:-2] * _U(3) + lower.hash[1:-1] * _U(5) + lower.hash[2:] * _U(7))
        ok = w.text[:-2] == w.text[2:]
        triple = np.bincount(w.text[:-2][ok], minlength=n) - _distinct(w.text[:-2][ok], t[ok], n)
    lines = [[x for x in text.split(b"\n") if x.strip()] for text in texts]
    repeated = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in lines])
    rates = [
        np.log2(length) / 20, _distinct(w.text, lower.hash, n) / some, per(signs) / length * 4, per(up) / length * 2,
        per(digits) / length * 4, np.bincount(w.text, w.end - w.start, n) / some / 16, repeated, triple / some,
    ]
    rows = np.arange(n)
    for k, rate in enumerate(rates):
        band = np.minimum((np.clip(rate, 0, 1) * _BANDS).astype(np.int64), _BANDS - 1)
        out[rows, _WORD_TERMS + _SHAPE_TERMS + k * _BANDS + band] = 1.0
    out[n_words == 0] = 0.0
    return out


def weigh(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows of log counts times inverse document frequency."""
    y = np.log1p(x)
    y *= idf
    y[:, _WORD_TERMS + _SHAPE_TERMS :] *= _BAND_WEIGHT
    size = np.sqrt((y * y).sum(axis=1))
    return y / np.where(size > 0, size, 1)[:, None]


def space(x: np.ndarray) -> np.ndarray:
    """Leading right singular vectors (terms x dimensions), by random projection and two rounds of
    power iteration."""
    k = min(DIMENSIONS, min(x.shape))
    probe = np.random.default_rng(11).standard_normal((x.shape[1], min(k + 16, x.shape[1]))).astype(np.float32)
    basis = np.linalg.qr(x @ probe)[0]
    for _ in range(2):
        basis = np.linalg.qr(x @ np.linalg.qr(x.T @ basis)[0])[0]
    return np.linalg.svd(basis.T @ x, full_matrices=False)[2][:k].T.copy()


def unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1))
    return x / np.where(size > 0, size, 1)[:, None]


def vote(latent: np.ndarray, known: np.ndarray, labels: np.ndarray, share: float) -> np.ndarray:
    """Scores of latent vectors by their nearest known ones."""
    similar = np.maximum(unit(latent) @ known.T, 0)
    k = min(NEIGHBOURS, known.shape[0])
    last = -np.partition(-similar, k - 1, axis=1)[:, k - 1 : k]
    nearer, tied = similar > last, similar == last
    left = (k - nearer.sum(axis=1)) / np.maximum(1, tied.sum(axis=1))
    weight = (nearer + tied * left[:, None]) * similar.astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    score = (weight @ labels) / np.where(total > 0, total, 1)
    return np.where(total > 0, score, share)


def _counted(batches):
    """Non-zero term counts of training rows."""
    for batch in slices(batches, ROWS):
        parts = [counts(group) for _, group in chunks(text_bytes(batch.column("text")))]
        x = np.concatenate(parts) if parts else np.zeros((0, TERMS), np.float32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("label"), pa.array([np.flatnonzero(r).astype(np.int32).tobytes() for r in x], pa.binary()),
                pa.array([r[r != 0].tobytes() for r in x], pa.binary()),
            ],
            names=["doc_id", "label", "terms", "counts"],
        )


def _scorer(model):
    idf, axes, known, labels, share = model.value

    def run(batches):
        for batch in slices(batches, ROWS):
            parts = [vote(weigh(counts(group), idf) @ axes, known, labels, share) for _, group in chunks(text_bytes(batch.column("text")), 1 << 19)]
            score = np.clip(np.concatenate(parts), 0.0, 1.0) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def fit(train: DataFrame):
    """(idf, axes, known, labels, share), or the share of label 1 alone if there is too little."""
    found = train.mapInArrow(_counted, "doc_id bigint, label bigint, terms binary, counts binary")
    rows = kept(found, "quality-train").orderBy("doc_id").collect()  # at most SAMPLE rows of sparse counts
    labels = np.array([min(1, max(0, r["label"])) for r in rows], float)
    share = float(labels.mean()) if len(rows) else 0.0
    if len(rows) < 2:
        return None, share
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["terms"], np.int32)] = np.frombuffer(r["counts"], np.float32)
    seen = (x > 0).sum(axis=0)
    idf = (np.log((1 + len(rows)) / (1 + seen)) + 0.1).astype(np.float32) * (seen > 0)
    x = weigh(x, idf)
    axes = space(x)
    return (idf, axes, unit(x @ axes), labels, share), share


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    model, share = fit(training_rows(docs, labels, label, SAMPLE))
    if model is None:
        scored = rows.select("doc_id", F.lit(share).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # SAMPLE x DIMENSIONS and TERMS x DIMENSIONS floats
        scored = rows.mapInArrow(lambda batches: _scorer(shared)(batches), "doc_id bigint, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
