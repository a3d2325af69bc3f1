"""Filter interaction audit (operator 11): a Gray-code walk over the subsets of filters.

1. One pass over the texts gives every document the bits of the filters it fails, apart from the
   one that compares documents; equal texts are found by a digest of the whole text, of which
   the smallest doc_id passes.  Only narrow rows are shuffled, none of them by a key that a large
   group of copies shares: the smallest id of a digest is a partial aggregate, and joins are on
   (doc_id, digest) and doc_id of rows that were counted together before.
2. Documents are counted by part and mask: at most 32 cells a part, whatever the part's size.
3. The subsets of filters are walked in Gray-code order, so one filter is toggled at a time.  Each
   mask cell holds a counter of the active filters that it fails; when the counter leaves or
   reaches zero, the cell leaves or rejoins the running survivors.  The 32 states are stored, and
   every step of every order is a difference of two of them.

Defined cases.  A null text is an empty one; no word is repeated in it, and it has no characters.
A null part is the empty string (and one part with it).  Rows without doc_id have no label, are
no copies and make none.  A repeated row counts as often as it occurs; equal ids are not smaller
than each other, so rows with one id and one text are no copies of each other.  A document is good
(toxic) if any of its label rows says so.  Very long texts are read whole, by Spark's own string
functions.  An empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import slices
from .tables import WORD_BREAK, kept, table

MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITALS_PCT = 2
SYMBOLS = "[#$%&*|]"
FILTERS = "ABCDE"
#: The filter that compares a document with others.
_COPY = FILTERS.index("E")
_CELLS = 1 << len(FILTERS)
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS)


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    n = F.size(words)
    fails = [
        n < MIN_WORDS,
        F.size(F.array_distinct(words)) * 100 < n * MIN_DISTINCT_PCT,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * MAX_CAPITALS_PCT,
        text.rlike(SYMBOLS),
    ]
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)]
    return sum(bits[1:], bits[0])


def masked(docs: DataFrame, part: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, part, mask, n): documents counted by id, part and the bits of all filters they fail."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(t.cast("binary"), 256)).alias("digest"),
        failures(t).alias("mask"),
    )
    rows = kept(rows, "audit")
    counted = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    named = counted.filter("doc_id IS NOT NULL")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL")
    named = named.join(first.withColumn("first", F.lit(True)), ["doc_id", "digest"], "left")
    copy = F.when(F.col("first"), F.lit(0)).otherwise(F.lit(1 << _COPY))
    named = named.select("doc_id", "part", (F.col("mask") + copy).alias("mask"), "n")
    return named.unionByName(counted.filter("doc_id IS NULL").select("doc_id", "part", "mask", "n"))


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cells): of every part, the counted documents, good and toxic ones of each mask."""
    any_of = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("bigint")), F.lit(0)).alias(c)
    labels = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    labels = labels.agg(any_of("quality"), any_of("toxic"))
    none = F.lit(0).cast("bigint")
    marked = rows.filter("doc_id IS NOT NULL").join(labels, "doc_id", "left")
    marked = marked.unionByName(rows.filter("doc_id IS NULL").withColumns({"quality": none, "toxic": none}))
    by_mask = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("quality", none)).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", none)).alias("toxic"),
    )
    return by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def walk(counts: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters; ``counts`` and the result are [..., 32, measures]."""
    states = np.empty_like(counts)
    survivors = counts.sum(axis=-2)
    failing = np.zeros(_CELLS, np.int64)  # active filters that each cell fails
    states[..., 0, :] = survivors
    active = 0
    for k in range(1, _CELLS):
        toggled = k & -k
        active ^= toggled
        on = bool(active & toggled)
        for cell in range(_CELLS):
            if not cell & toggled:
                continue
            failing[cell] += 1 if on else -1
            if on and failing[cell] == 1:
                survivors = survivors - counts[..., cell, :]
            elif not on and failing[cell] == 0:
                survivors = survivors + counts[..., cell, :]
        states[..., active, :] = survivors
    return states


_ORDERS = ["".join(o) for o in itertools.permutations(FILTERS)]
_STEP_BITS = np.array([[1 << FILTERS.index(f) for f in o] for o in _ORDERS]).ravel()
_AFTER = np.array([list(itertools.accumulate(1 << FILTERS.index(f) for f in o)) for o in _ORDERS]).ravel()
_BEFORE = _AFTER - _STEP_BITS
_FILTER = np.array([FILTERS.index(f) for o in _ORDERS for f in o])
_STEP = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(_ORDERS))


def steps(states: np.ndarray) -> dict[str, np.ndarray]:
    """Counts [parts, orders x steps] as differences of the stored states."""
    lost = states[:, _BEFORE] - states[:, _AFTER]
    removed = lost[..., 0]
    n, full = states[..., 0], _CELLS - 1
    shapley = np.stack([removed[:, _FILTER == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)
    return {
        "kept": n[:, _AFTER],
        "removed": removed,
        "redundant": n[:, :1] - n[:, _STEP_BITS] - removed,
        "unique_fails": n[:, full - _STEP_BITS] - n[:, [full]],
        "good_lost": lost[..., 1],
        "toxic_lost": lost[..., 2],
        "shapley": shapley[:, _FILTER],
    }


def _audit(batches):
    for batch in slices(batches, 64):
        counts = np.zeros((batch.num_rows, _CELLS, 3), np.int64)
        for row, entries in enumerate(batch.column("cells").to_pylist()):
            for e in entries:
                counts[row, e["mask"]] += (e["n"], e["good"], e["toxic"])
        found = steps(walk(counts))
        at = pa.array(np.repeat(np.arange(batch.num_rows), len(_STEP)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("part").cast(pa.string()).take(at),
                pa.array([o for o in _ORDERS for _ in FILTERS] * batch.num_rows, pa.string()),
                pa.array(np.tile(_STEP, batch.num_rows)),
                *[pa.array(found[c].ravel().astype(np.int64)) for c in _COUNTS],
            ],
            names=["part", "filter_order", "step", *_COUNTS],
        )


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text") -> DataFrame:
    """One row per part, order of the filters and step, with its counts."""
    return cells(masked(docs, part, text), labels).mapInArrow(_audit, _RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS lowest
  FROM documents),
l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (
  SELECT part, CAST(len(w) < {MIN_WORDS} AS INT)
             + 2 * CAST(100 * len(list_distinct(w)) < {MIN_DISTINCT_PCT} * len(w) AS INT)
             + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITALS_PCT} * length(t) AS INT)
             + 8 * CAST(regexp_matches(t, '{SYMBOLS}') AS INT)
             + 16 * CAST(coalesce(d.doc_id > lowest, false) AS INT) AS mask,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id GROUP BY ALL),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.letter || b.letter || x.letter || y.letter || z.letter AS filter_order
  FROM f a, f b, f x, f y, f z WHERE a.bit + b.bit + x.bit + y.bit + z.bit = 31
    AND len(list_distinct([a.bit, b.bit, x.bit, y.bit, z.bit])) = 5),
s AS (
  SELECT filter_order, step, f.letter, f.bit,
         (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE position(g.letter IN filter_order) < step) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step), f WHERE position(f.letter IN filter_order) = step),
r AS (
  SELECT part, filter_order, step, letter,
         sum(n) FILTER (mask & (CAST(before AS INT) | bit) = 0) AS kept,
         sum(n) FILTER (mask & bit > 0 AND mask & CAST(before AS INT) = 0) AS removed,
         sum(n) FILTER (mask & bit > 0 AND mask & CAST(before AS INT) > 0) AS redundant,
         sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & bit > 0 AND mask & CAST(before AS INT) = 0) AS good_lost,
         sum(toxic) FILTER (mask & bit > 0 AND mask & CAST(before AS INT) = 0) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM r
"""
