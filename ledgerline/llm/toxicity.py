"""Toxicity (operator 7): gradient-boosted trees over dense features, isotonic calibration.

Features of every whole text: densities of lexicon words (words and word beginnings learned from
the labelled rows; there is no list of our own), how close lexicon words stand to second-person words,
and rates of capitals, punctuation, exclamation, repeated signs and obfuscated words (signs or
digits between letters).  Trees are pyspark.ml's; the margin of a held-back third of the training
rows is calibrated by an isotonic regression.

The training rows are labelled rows outside the held-out fold, at most ``SAMPLE`` of them, those
with the lowest hash of doc_id.  Labels, lang, source and doc_id are no inputs of a score.  The
lexicon is cross-fitted, however many rows there are: each half of the training rows has its
features by the entries that the other half taught, so entries bear the weight they have on rows
that they were not learned from; new texts are scored by the entries of all training rows.  Halves
and thirds are dealt within each label.

Defined cases.  A null or empty text has zero features and gets a score.  Very long texts are read
whole.  Rows without a label, or whose label is null, teach nothing; of a doc_id labelled twice the
higher label counts, and of one with different texts the first in binary order is read.  With fewer
than two toxic or two harmless training rows every score is the share of toxic ones (0 without
rows).  Repeated rows are scored alike.  An empty table gives no rows.  Extra columns are not
looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernel import BYTE_CODE, chunks, mix, powers, slices, text_bytes, words
from .tables import held_out, kept, numbered, table, training_rows

#: Most labelled rows that the model learns from.
SAMPLE = 20_000
TREES = 15
DEPTH = 4
#: Most learned lexicon entries, and in how many toxic rows one must occur.
ENTRIES = 4000
MIN_ROWS = 3
#: An entry's share of toxic rows has to be this many times its share of others.
MIN_LIFT = 8.0
CUT = 0.5
#: Bytes of texts that are looked at together; the arrays over them are many times as large.
TEXT_BYTES = 1 << 18
# Second-person words of the corpus languages.
YOU = "you your you're yours u ur tu te toi vous votre vos du dich dir dein deine ihr euch usted tú ti vosotros".split()

_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_PREFIXES = (4, 5, 6)
NAMES = [
    "learned", "learned_prefix", "learned_weight", "near_you", "you", "capitals", "shouted", "punctuation", "exclaims",
    "symbols", "obfuscated", "repeated", "word_length", "any_learned",
]


def _word_hashes(listed: list[str]) -> np.ndarray:
    return np.sort(words([" ".join(listed).encode()], lower=True).hash) if listed else np.zeros(0, np.uint64)


def _core(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without leading and trailing signs, however many; empty where a word has nothing else."""
    n = len(data)
    at = np.arange(n, dtype=np.int64)
    plain = ~_PUNCT[data]
    following = np.minimum.accumulate(np.where(plain, at, n)[::-1])[::-1]  # first other byte from here on
    last = np.maximum.accumulate(np.where(plain, at, -1))  # last other byte up to here
    a = np.minimum(following[start], end)
    return a, np.maximum(last[end - 1] + 1, a)


def tokens(texts: list[bytes]):
    """Core words of a chunk: word spans, whole-word hashes, and hashes of word beginnings (0 where
    a word is not longer than the beginning)."""
    w = words([t.lower() for t in texts])
    a, b = _core(w.data, w.start, w.end)
    # Hash again over the core spans: prefix sums of the same byte codes.
    power, inverse = powers(len(w.data))
    total = np.zeros(len(w.data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[w.data] * power, out=total[1:])
    hashed = mix((total[b] - total[a]) * inverse[np.minimum(a, len(w.data) - 1)])
    heads = []
    for n in _PREFIXES:
        stop = np.minimum(a + n, b)
        head = mix((total[stop] - total[a]) * inverse[np.minimum(a, len(w.data) - 1)] + _U(n))
        heads.append(np.where(b - a > n, head, _U(0)))
    return w, a, b, hashed, heads


def _in(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values


def features(texts: list[bytes], lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Feature rows of a chunk of texts; ``lexicon``: sorted learned keys and their weights."""
    keys, weights = lexicon
    w, a, b, hashed, heads = tokens(texts)
    n_texts = len(texts)
    per = lambda flag: np.bincount(w.text, weights=flag, minlength=n_texts)
    n = np.maximum(np.diff(w.bounds), 1)
    you = _in(_YOU_KEYS, hashed)
    whole = _in(keys, hashed)
    head = np.zeros(len(hashed), bool)
    weight = np.zeros(len(hashed))
    for found in (hashed, *heads):
        hit = _in(keys, found)
        if hit.any():
            weight[hit] = np.maximum(weight[hit], weights[np.searchsorted(keys, found[hit])])
        if found is not hashed:
            head |= hit
    bad = whole | head
    near = np.zeros(len(bad), bool)
    for gap in range(1, 6):
        same = w.text[gap:] == w.text[:-gap] if len(bad) > gap else np.zeros(0, bool)
        near[gap:] |= same & you[:-gap] if len(same) else False
        near[: len(bad) - gap] |= same & you[gap:] if len(same) else False
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    first = np.append(w.first, len(raw))
    length = np.maximum(np.diff(first) - 1, 1)
    rate = lambda flag: np.add.reduceat(flag.astype(np.int64), w.first) / length
    upper = _UPPER[raw]
    ups = np.append(0, np.cumsum(upper))
    letters = np.append(0, np.cumsum(_LETTER[raw]))
    shouted = (ups[w.end] - ups[w.start] >= 3) & (ups[w.end] - ups[w.start] == letters[w.end] - letters[w.start])
    core_letters = letters[b] - letters[a]
    obfuscated = (core_letters >= 2) & (core_letters < b - a)
    again = np.zeros(len(raw), bool)
    again[1:] = (raw[1:] == raw[:-1]) & _PUNCT[raw[1:]]
    columns = [
        per(whole) / n, per(head) / n, per(weight) / n, per(bad & near) / n, per(you) / n, rate(upper),
        per(shouted) / n, rate(_PUNCT[raw]), rate(raw == 0x21), rate(np.isin(raw, list(b"#*$%&|<>@"))),
        per(obfuscated) / n, rate(again), per(w.end - w.start) / n, np.minimum(per(bad), 4),
    ]
    return np.stack(columns, axis=1)


_YOU_KEYS = _word_hashes(YOU)


_COLUMNS = [f"__{name}" for name in NAMES]
_KINDS = ", ".join(f"{c} double" for c in _COLUMNS)


def _featurise(lexicon, scored="__scored"):
    """Adds the feature columns; the column ``scored`` has the texts, and one named ``__scored`` goes."""

    def run(batches):
        for batch in slices(batches):
            rest = {name: batch.column(name) for name in batch.schema.names if name != "__scored"}
            parts = [features(group, lexicon) for _, group in chunks(text_bytes(batch.column(scored)), TEXT_BYTES)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
            columns = rest | {name: pa.array(x[:, k]) for k, name in enumerate(_COLUMNS)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _keys(batches):
    """(key, label) of the distinct words and word beginnings of every training row."""
    for batch in slices(batches):
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        for at, group in chunks(text_bytes(batch.column("text")), TEXT_BYTES):
            w, _, _, hashed, heads = tokens(group)
            out, label = [], []
            for i in range(len(group)):
                part = slice(w.bounds[i], w.bounds[i + 1])
                own = np.unique(np.concatenate([hashed[part], *(h[part] for h in heads)]))
                own = own[own != 0]
                out.append(own)
                label.append(np.full(len(own), labels[at + i], np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(label))], names=["key", "label"]
            )


def learn_lexicon(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The words and beginnings that mark toxic training rows, at most ``ENTRIES`` of them."""
    size = train.groupBy().agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, harmless = int(size["t"] or 0), int(size["n"]) - int(size["t"] or 0)
    seen = train.select("text", "label").mapInArrow(_keys, "key bigint, label bigint")
    seen = seen.groupBy("key").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).filter(F.col("t") >= MIN_ROWS)
    lift = (F.col("t") / (toxic + 1.0)) / ((F.col("n") - F.col("t") + 0.5) / (harmless + 1.0))
    best = seen.withColumn("lift", lift).filter(F.col("lift") >= MIN_LIFT).orderBy(F.desc("lift"), F.desc("t"), "key")
    rows = best.limit(ENTRIES).collect()
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log(np.array([r["lift"] for r in rows], float))[order]


def _dealt(train: DataFrame) -> DataFrame:
    """The (at most ``SAMPLE``) training rows with their ``half`` and ``third``, dealt within each label."""
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")) - 1
    return train.withColumn("third", place % 3).withColumn("half", F.floor(place / 3) % 2)


def _with_features(rows: DataFrame, lexicon, scored: str = "__scored") -> DataFrame:
    carried = [f for f in rows.schema.fields if f.name != "__scored"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carried] + [_KINDS])
    vector = VectorAssembler(inputCols=_COLUMNS, outputCol="__features", handleInvalid="keep")
    return vector.transform(rows.mapInArrow(_featurise(lexicon, scored), schema)).drop(*_COLUMNS)


def score_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", with_text: bool = True) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; columns of these names are replaced.

    ``with_text=False`` leaves the text out of the result, so it isn't carried back from Python.
    """
    out = [c for c in docs.columns if c not in ("held_out", "score", "predicted") and (with_text or c != "text")]
    train = kept(_dealt(training_rows(docs, labels, label, SAMPLE)), "toxic-train")
    rows, names = numbered(docs.select(*[F.col(f"`{c}`") for c in out]), ("doc_id", "text"))
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < 2:
        share = float(counts.get(1, 0)) / max(1, sum(counts.values()))
        scored = rows.withColumn("score", F.lit(share))
    else:
        scored_text = F.col("text").cast("string").alias("__scored")
        halves = []
        for half in (0, 1):
            own = train.filter(F.col("half") == half).select("doc_id", "label", "third", scored_text)
            halves.append(_with_features(own, learn_lexicon(train.filter(F.col("half") != half))))
        known = kept(halves[0].unionByName(halves[1]).coalesce(4), "toxic-features")
        known = known.withColumn("label", F.col("label").cast("double"))
        lexicon = learn_lexicon(train)
        trees = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, featuresCol="__features", labelCol="label",
            predictionCol="__prediction",
        )
        trees.setRawPredictionCol("__raw").setProbabilityCol("__probability")
        model = trees.fit(known.filter("third <> 0"))
        margin = vector_to_array("__raw")[1].alias("__margin")
        held = model.transform(known.filter("third = 0")).select(margin, "label")
        curve = IsotonicRegression(featuresCol="__margin", labelCol="label", predictionCol="__calibrated").fit(held)
        new = rows if with_text else numbered(docs.select(*[F.col(f"`{c}`") for c in out], "text"), ("doc_id", "text"))[0]
        # A text that comes back is read where it stands, and goes to Python once.
        scored = "text" if with_text and new.schema["text"].dataType == T.StringType() else "__scored"
        if scored == "__scored":
            new = new.withColumn(scored, scored_text).select(*names.values(), scored)
        new = _with_features(new, lexicon, scored)
        new = model.transform(new).select(*names.values(), margin)
        calibrated = F.least(F.lit(1.0), F.greatest(F.lit(0.0), "__calibrated"))
        scored = curve.transform(new).withColumn("score", calibrated).drop("__margin", "__calibrated")
    scored = scored.select(*[F.col(n).alias(c) for c, n in names.items()], "score")
    fold = F.coalesce(held_out(F.col("doc_id").cast("bigint")), F.lit(False))
    return scored.withColumn("held_out", fold).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_rows(docs, table(spark, sf_dir, "labels"), with_text=False)
    return scored.select("doc_id", "held_out", "score", "predicted")
