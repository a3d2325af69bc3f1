"""MinHash near-dedup (operator 1): one-permutation hashing, optimal densification, banded
buckets, star-shaped candidate edges, exact confirmation on full shingle sets.

1. One pass over the texts gives every document its shingle count, a hash of its whole shingle
   set, ``BANDS`` bucket keys and one byte of every bin of its signature.  Documents with equal
   sets form one class; only one member of a class goes on, so copies by the thousand cost one row.
2. Buckets with two or more classes survive.  In each, the member whose buckets are the fullest
   (the natural hub of a group of near copies) is linked to every other member: a star, not all
   pairs.  Star edges are confirmed on full sets and components are formed.
3. Stars alone could miss a link between two leaves.  Buckets whose leaves lie in more than one
   component are therefore searched in blocks, in two steps.  First signatures are compared within a
   task, and the leaves come out that have a partner in another component whose estimated similarity
   is within 5 standard deviations of the threshold.  Then their full shingle sets are brought
   together bucket by bucket and compared there; of the links confirmed in a block pair only a spanning
   forest comes out, so neither step makes more rows than it reads, however large a group is.

With 40 bands of 6 rows, a pair at the threshold (0.85) shares no bucket with probability 6e-9.

Defined cases.  Null, empty or blank texts have zero shingles and link with nothing.  Repeated
rows fall into one class.  A row without doc_id is in no group and is kept.  Very long texts are
read whole; a block holds few documents where their sets are long.  An empty table gives no rows.
Other columns are not looked at; ``drop_near_copies`` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .kernel import chunks, constants, list_column, mix, slices, text_bytes, windows, words
from .tables import kept, table

SHINGLE = 5
BANDS = 40
ROWS = 6
THRESHOLD = 85  # percent
#: Bins of a signature; the first BANDS x ROWS of them make the bands.
_BINS = 512
#: Lowest estimate that is confirmed: at 0.85 the estimate's standard deviation is 0.016.
_ESTIMATE = 0.765
#: Members of a bucket that meet in one task at a time, and the bytes of their shingle sets.
BLOCK = 256
BLOCK_BYTES = 4 << 20
#: Most ids that are broadcast to pick their texts (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
_U = np.uint64
#: Lowest 64-bit value of every bin: bins cut the hash range evenly.
_EDGES = np.array([-(-(b << 64) // _BINS) for b in range(_BINS)], dtype=np.uint64)
_DONOR_TRIES = 256


def _donors(attempt: int) -> np.ndarray:
    """The bin that each bin asks in a given attempt of the densification."""
    seed = constants(1, 1000 + attempt)[0]
    return (mix(np.arange(_BINS, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + seed) % _U(_BINS)).astype(np.int64)


_TRIES = [_donors(a) for a in range(_DONOR_TRIES)]
_ROW_CODES = constants(BANDS * ROWS, 77).reshape(BANDS, ROWS)
_BAND_CODES = constants(BANDS, 78)


def shingle_sets(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text, in order."""
    for _, group in chunks(texts):
        w = words(group, lower=True)
        hashed, at = windows(w, SHINGLE, 11)
        cut = np.searchsorted(at, w.bounds)
        for i in range(len(group)):
            n = w.bounds[i + 1] - w.bounds[i]
            if n >= SHINGLE:
                yield np.unique(hashed[cut[i] : cut[i + 1]])
            elif n:
                few = w.hash[w.bounds[i] : w.bounds[i + 1]] * constants(n, 11)
                yield mix(np.array([few.sum() + _U(n)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One-permutation minima of the bins, a row for each (non-empty) set; an empty bin copies the
    bin that its hash sequence finds first among the filled ones (optimal densification)."""
    out = np.empty((len(sets), _BINS), np.uint64)
    filled = np.empty((len(sets), _BINS), bool)
    for row, s in enumerate(sets):
        at = np.searchsorted(s, _EDGES)
        filled[row, :-1] = at[1:] > at[:-1]
        filled[row, -1] = len(s) > at[-1]
        out[row] = s[np.minimum(at, len(s) - 1)]
    row, empty = np.nonzero(~filled)
    attempt = 0
    while len(row):
        donor = (_TRIES[attempt] if attempt < _DONOR_TRIES else _donors(attempt))[empty]
        hit = filled[row, donor]
        out[row[hit], empty[hit]] = out[row[hit], donor[hit]]
        row, empty = row[~hit], empty[~hit]
        attempt += 1
    return out


def band_keys(sigs: np.ndarray) -> np.ndarray:
    cells = sigs[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    return mix((cells * _ROW_CODES).sum(axis=2, dtype=np.uint64) + _BAND_CODES)


_SKETCH = "doc_id bigint, n_shingles bigint, set_hash bigint, set_check bigint, bands array<bigint>, signature binary"
#: Documents with equal values here have equal shingle sets (128 bits of hash and the size).
_SET = ["set_hash", "set_check", "n_shingles"]


def _sketch(batches):
    for batch in slices(batches):
        sets = list(shingle_sets(text_bytes(batch.column("text"))))
        counts = np.array([len(s) for s in sets], np.int64)
        hashes, checks = (
            np.array([mix(s ^ code).sum(dtype=np.uint64) for s in sets], np.uint64) for code in (_U(0x5BD1E995), _BAND_CODES[0])
        )
        full = [s for s in sets if len(s)]
        sigs = signatures(full)
        flat = band_keys(sigs).ravel()
        low = iter([r.tobytes() for r in sigs.astype(np.uint8)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(counts), pa.array(hashes.view(np.int64)), pa.array(checks.view(np.int64)),
                list_column(flat.view(np.int64), np.cumsum([0, *np.where(counts > 0, BANDS, 0)]), pa.int64()),
                pa.array([next(low) if n else b"" for n in counts], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "set_hash", "set_check", "bands", "signature"],
        )


def _full_sets(batches):
    for batch in slices(batches):
        sets = list(shingle_sets(text_bytes(batch.column("text"))))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        bounds = np.cumsum([0, *map(len, sets)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), list_column(flat.view(np.int64), bounds, pa.int64())], names=["doc_id", "shingles"]
        )


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_hash, set_check, bands, signature) of every row of ``docs`` (doc_id, text)."""
    ids = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return ids.mapInArrow(_sketch, _SKETCH)


def _may_link(n: str, m: str) -> Column:
    """Sizes that a pair over the threshold can have."""
    small, large = F.least(n, m), F.greatest(n, m)
    return small * 100 >= large * THRESHOLD


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is in ``ids``; ids are broadcast when they are counted to be few."""
    ids = kept(ids.distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``, made again from their texts."""
    texts = _only(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), ids)
    sets = texts.mapInArrow(_full_sets, "doc_id bigint, shingles array<bigint>")
    return kept(sets.dropDuplicates(["doc_id"]), "sets")


def confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose full shingle sets reach the threshold.

    Sets are made again from the texts, for the documents that occur in a pair only.
    """
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    sets = full_sets(docs, ids)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    both = both.select("a", "b", F.size("s").alias("n"), F.size("t").alias("m"), F.size(F.array_intersect("s", "t")).alias("i"))
    return both.filter(F.col("i") * 100 >= (F.col("n") + F.col("m") - F.col("i")) * THRESHOLD).select("a", "b")


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks that meet (twice the same for a block with itself)."""
    block = rows["block"].to_numpy()
    return tuple(np.flatnonzero(block == rows[c][0].as_py()) for c in ("low", "high"))


def _may_pair(rows: pa.Table, left: np.ndarray, right: np.ndarray, component: np.ndarray) -> np.ndarray:
    """[left, right]: whether two rows lie in different components and may link by their sizes."""
    n = rows["n"].to_numpy()
    small, large = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
    return (component[left][:, None] != component[right][None, :]) & (small * 100 >= large * THRESHOLD)


def _near(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (sig[i] == sig[j]).mean(axis=1) >= _ESTIMATE


def _signed(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8).reshape(rows.num_rows, _BINS)


_LEAF = ["bucket", "id", "n", "component"]


def _promising(rows: pa.Table) -> pa.Table:
    """The rows of one bucket's block pair that have a partner, by size and estimate, in another component."""
    sig, component = _signed(rows), rows["component"].to_numpy()
    left, right = _sides(rows)
    found = np.zeros(rows.num_rows, bool)
    for at in range(0, len(left), 16):
        x = left[at : at + 16]
        i, j = np.nonzero(_may_pair(rows, x, right, component))
        near = _near(sig, x[i], right[j])
        found[x[i[near]]] = True
        found[right[j[near]]] = True
    return rows.select(_LEAF).filter(pa.array(found))


def _forest(rows: pa.Table) -> pa.Table:
    """A spanning forest of the links, confirmed on full sets, over different components of one
    bucket's block pair."""
    ids, sig = rows["id"].to_numpy(), _signed(rows)
    label = rows["component"].to_numpy().copy()
    flat = rows["shingles"].combine_chunks()
    values, bounds = flat.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(flat.value_lengths().to_numpy())])
    sets = [values[bounds[k] : bounds[k + 1]] for k in range(rows.num_rows)]
    left, right = _sides(rows)
    a, b = [], []
    for x in left:
        other = right[_may_pair(rows, np.array([x]), right, label)[0]]
        other = other[_near(sig, np.full(len(other), x), other)]
        if not len(other):
            continue
        own = np.sort(sets[x])
        many = np.array([len(sets[y]) for y in other])
        joined = np.concatenate([sets[y] for y in other])
        at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
        both = np.add.reduceat((own[at] == joined).astype(np.int64), np.concatenate([[0], np.cumsum(many)[:-1]]))
        for y in other[both * 100 >= (len(own) + many - both) * THRESHOLD]:
            if label[y] != label[x]:
                a.append(min(ids[x], ids[y]))
                b.append(max(ids[x], ids[y]))
                label[label == label[y]] = label[x]
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _in_blocks(members: DataFrame, blocks: Column) -> DataFrame:
    """``members`` once for every pair of blocks of their bucket that they meet in."""
    members = members.withColumn("__blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), "__blocks").cast("int"))
    members = members.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    members = members.withColumn("low", F.least("block", "__other")).withColumn("high", F.greatest("block", "__other"))
    return members.drop("__blocks", "__other")


def promising_leaves(members: DataFrame, sketches: DataFrame, found: DataFrame | None) -> DataFrame:
    """The (bucket, id, n, component) that have a partner the stars left untested and that may link.

    ``members`` (bucket, band, id, n, size) without the buckets' centres.
    """
    if found is None:
        members = members.withColumn("component", F.col("id"))
    else:
        members = members.join(found.withColumnRenamed("node", "id"), "id", "left")
        members = members.withColumn("component", F.coalesce("component", "id"))
    members = kept(members, "leaves")
    mixed = members.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    mixed = members.join(kept(mixed.select("bucket"), "mixed-buckets"), "bucket", "left_semi")
    mixed = kept(mixed, "mixed")
    signed = _only(sketches.select("doc_id", "signature"), mixed.select(F.col("id").alias("doc_id")))
    mixed = mixed.join(signed.dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "id"), "id")
    cells = _in_blocks(mixed, F.ceil(F.col("size") / BLOCK)).select(*_LEAF, "signature", "block", "low", "high")
    near = cells.groupBy("bucket", "low", "high").applyInArrow(_promising, "bucket bigint, id bigint, n bigint, component bigint")
    return kept(near.distinct(), "promising")


def leaf_links(leaves: DataFrame, sketches: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed (a, b) between ``promising_leaves``: of every bucket enough to join what links in it."""
    about = leaves.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"), F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y"),
    )
    # Of buckets with the same leaves one is enough.
    about = kept(about.dropDuplicates(["members", "shingles", "x", "y"]).drop("x", "y"), "leaf-buckets")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES))
    leaves = kept(leaves.join(about, "bucket"), "leaf-members")
    ids = leaves.select(F.col("id").alias("doc_id")).distinct()
    sets = full_sets(docs, ids).withColumnRenamed("doc_id", "id")
    signed = _only(sketches.select("doc_id", "signature"), ids).dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "id")
    cells = _in_blocks(leaves, blocks).select(*_LEAF, "block", "low", "high").join(sets, "id").join(signed, "id")
    return cells.groupBy("bucket", "low", "high").applyInArrow(_forest, "a bigint, b bigint").distinct()


def link_classes(classes: DataFrame, sketches: DataFrame, docs: DataFrame) -> DataFrame | None:
    """(node, component) over all classes that link with another one, if any do.

    ``classes`` has one row (id, n, bands) per distinct shingle set; ``sketches`` has the
    signatures.
    """
    members = classes.select(F.posexplode("bands").alias("band", "bucket"), "id", "n")
    full = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # Written aggregates, here and below: a join with one then has shuffles of its own, which AQE
    # can split where a bucket holds a large group.
    full = kept(full, "sizes")
    shared = kept(members.join(full, "bucket"), "buckets")
    # Fullest member of each bucket: a sum per member, then a maximum per bucket, both partial.
    fullness = shared.groupBy("id").agg(F.sum("size").alias("pop"))
    best = F.max(F.struct("pop", (-F.col("id")).alias("low"), "n"))
    centres = shared.join(fullness, "id").groupBy("bucket").agg(best.alias("c"))
    centres = kept(centres.select("bucket", (-F.col("c.low")).alias("centre"), F.col("c.n").alias("cn")), "centres")
    stars = kept(shared.join(centres, "bucket").filter("id <> centre"), "stars")
    pairs = stars.filter(_may_link("n", "cn"))
    pairs = kept(pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct(), "pairs")
    links = kept(confirm(pairs, docs), "links")
    found = None if links.isEmpty() else kept(components(links), "components")
    leaves = stars.filter("size > 2").select("bucket", "band", "id", "n", "size")
    leaves = promising_leaves(leaves, sketches, found)
    if not leaves.isEmpty():
        more = kept(leaf_links(leaves, sketches, docs), "links")
        if not more.isEmpty():
            found = kept(components(links.unionByName(more)), "components")
    return found


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    sketches = kept(sketch(docs), "sketch")
    sets = sketches.drop("signature").filter("n_shingles > 0 AND doc_id IS NOT NULL")
    lowest = sets.groupBy(*_SET).agg(F.min("doc_id").alias("id"))
    lowest = kept(lowest, "classes")
    one = sets.join(lowest.withColumnRenamed("id", "doc_id"), [*_SET, "doc_id"], "left_semi")
    one = one.dropDuplicates(["doc_id"])
    classes = one.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bands")
    groups = link_classes(classes, sketches, docs)
    if groups is None:
        of_set = lowest.withColumn("component", F.col("id"))
    else:
        of_set = lowest.join(groups.withColumnRenamed("node", "id"), "id", "left")
    of_set = of_set.select(*_SET, F.coalesce("component", "id").alias("component_id"))
    out = sketches.select("doc_id", *_SET).join(of_set, _SET, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are not the first of their group."""
    gone = near_groups(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
           WHEN len(w) >= {SHINGLE} THEN list_transform(range(1, len(w) - {SHINGLE - 2}),
                                                      lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * i >= {THRESHOLD} * (p.n + q.n - i)),
sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS x, doc_id AS r FROM w
  UNION
  SELECT sym.b, reach.r FROM reach JOIN sym ON sym.a = reach.x WHERE reach.r < sym.b)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id, min(r) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN reach ON reach.x = w.doc_id
GROUP BY w.doc_id, n.n
"""
