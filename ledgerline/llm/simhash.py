"""SimHash near-dedup (operator 12): BK-trees over fingerprints, children keyed by integer Hamming
distance to the parent; a search follows only the edges within the radius.

1. One pass over the texts makes the 64-bit fingerprint of every document.  Equal fingerprints
   form one class; a class goes on as one row, so copies by the thousand cost one row.
2. Fingerprints are dealt over shards: 64 bits are cut into radius + 1 equal blocks, and two
   fingerprints within the radius agree in at least one of them.  A shard is a block and its
   value, so every link lies within a shard.  Shards of more than ``SHARD`` fingerprints are
   cut again in the same way over the bits that are left.  What then is still larger (a crowd of
   fingerprints that agree in nearly half of all bits) is dealt over parts, and every pair of parts
   is searched: the tree of one with the fingerprints of the other.
3. A task builds the tree of each of its shards and searches it.  A tree holds at most ``SHARD``
   fingerprints.  Trees reach their searches by the shuffle that makes the shards, as a broadcast
   of all of them would pass every fingerprint through the driver.
4. Of the links in a shard only a spanning forest comes out, at most one row for each fingerprint
   but one, so rows never grow with the square of a crowd.  Components join the forests.

Defined cases.  A null, empty or blank text has fingerprint zero and links like any other; with
one or two words the whole sequence is one shingle.  Repeated rows have equal fingerprints.  A row
without doc_id gets its fingerprint, takes no part in links and has no component.  Very long texts
are read whole, in blocks of shingles.  An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_dealt
from .graph import components
from .kernel import slices, text_bytes
from .tables import kept, table

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
#: Most fingerprints in one tree.
SHARD = 4096
#: Fingerprints of small shards that one group of a task holds together, on average.
_GROUP = 4 * SHARD
#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 15


def fingerprint(text: bytes | None) -> int:
    """Majority of the bits of all shingles' hashes."""
    words = (text or b"").lower().split()  # of bytes: A-Z only, and blanks as in [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    total, n, counts = 0, len(words) - k + 1, np.zeros(BITS, np.int64)
    while total < n:
        some = [digest(view[a:b], SEED) for a, b in itertools.islice(spans, _BLOCK)]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(some)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > n))


def _fingerprints(batches):
    for batch in slices(batches):
        found = np.array([fingerprint(t) for t in text_bytes(batch.column("text"))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits) of every row of ``docs`` (doc_id, text); bits as a signed 64-bit integer."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id bigint, bits bigint")


class Tree:
    """BK-tree: every node's children by their Hamming distance to it (one child a distance)."""

    def __init__(self) -> None:
        self.bits: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, bits: int) -> None:
        node = len(self.bits)
        self.bits.append(bits)
        self.children.append({})
        at = 0
        while at != node:
            at = self.children[at].setdefault((self.bits[at] ^ bits).bit_count(), node)

    def near(self, bits: int, radius: int) -> list[int]:
        """Nodes within ``radius``: of a node at distance d, only children keyed d - radius to d + radius."""
        found, todo = [], [0] if self.bits else []
        while todo:
            at = todo.pop()
            d = (self.bits[at] ^ bits).bit_count()
            if d <= radius:
                found.append(at)
            children = self.children[at]
            if len(children) <= 2 * radius + 1:
                todo += [child for key, child in children.items() if d - radius <= key <= d + radius]
            else:
                todo += [children[key] for key in range(d - radius, d + radius + 1) if key in children]
        return found


class Forest:
    """Union of sets; tells of every link whether it joins two of them."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def joins(self, a: int, b: int) -> bool:
        a, b = self._top(a), self._top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b

    def _top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def spanning_links(bits: list[int], searches: list[int], built: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``radius`` between the fingerprints at ``searches`` and
    those at ``built``, as index pairs; with the same list twice, each pair is met once."""
    tree, forest, links = Tree(), Forest(len(bits)), []
    same = searches is built
    if not same:
        for i in built:
            tree.add(bits[i])
    for i in searches:
        links += [(built[j], i) for j in tree.near(bits[i], radius) if forest.joins(built[j], i)]
        if same:
            tree.add(bits[i])
    return links


def _search(rows: pa.Table) -> pa.Table:
    """Links of all shards (and pairs of parts) of one group of rows."""
    column = lambda c: rows[c].to_numpy()
    shard, low, high = column("shard"), column("low"), column("high")
    order = np.lexsort((column("id"), high, low, shard))
    shard, low, high, part, ids = shard[order], low[order], high[order], column("part")[order], column("id")[order]
    bits = column("bits")[order].view(np.uint64)
    new = np.flatnonzero((np.diff(shard) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
    a, b = [], []
    for start, end in zip([0, *new.tolist()], [*new.tolist(), len(ids)]):
        if end - start < 2:
            continue
        own, parts = bits[start:end].tolist(), part[start:end]
        if low[start] == high[start]:
            searches = built = list(range(end - start))
        else:
            built, searches = (np.flatnonzero(parts == p[start]).tolist() for p in (low, high))
        for i, j in spanning_links(own, searches, built, RADIUS):
            x, y = ids[start + i], ids[start + j]
            a.append(min(x, y))
            b.append(max(x, y))
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _blocks(width: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 1 blocks of ``width`` bits."""
    cuts = [width * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _dealt(rows: DataFrame, width: int) -> DataFrame:
    """Every row once for each block of its ``rest`` (the ``width`` bits that its shard leaves open):
    ``shard`` is extended by the block and its value, which leave ``rest``."""
    entries = []
    for i, (first, n) in enumerate(_blocks(width)):
        value = F.shiftrightunsigned("rest", first).bitwiseAND(F.lit((1 << n) - 1))
        below = F.col("rest").bitwiseAND(F.lit((1 << first) - 1))
        above = F.lit(0).cast("bigint") if first + n == width else F.shiftrightunsigned("rest", first + n)
        rest = F.shiftleft(above, first).bitwiseOR(below)
        entries.append(F.struct(F.xxhash64("shard", F.lit(i), value).alias("shard"), rest.alias("rest")))
    return rows.withColumn("entry", F.explode(F.array(*entries))).select("id", "bits", "entry.shard", "entry.rest")


def _sized(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` of shards with two or more fingerprints, with the shard's ``size``."""
    rows = kept(rows, name)
    sizes = kept(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), f"{name}-sizes")
    return kept(rows.join(sizes, "shard"), f"{name}-sized")


def links(classes: DataFrame) -> DataFrame:
    """(a, b) whose components are those of all links between ``classes`` (id, bits; distinct bits).

    Shards go by a 64-bit hash of blocks and values; where two collide they are searched as one,
    which loses nothing, as every distance is measured.
    """
    rows = classes.select("id", "bits", F.lit(0).cast("bigint").alias("shard"), F.col("bits").alias("rest"))
    first = _sized(_dealt(rows, BITS), "shards")
    left = BITS - BITS // (RADIUS + 1)
    large = first.filter(F.col("size") > SHARD).select("id", "bits", "shard", "rest")
    second = _sized(_dealt(large, left), "large-shards")
    rows = first.filter(F.col("size") <= SHARD).unionByName(second).drop("rest")
    parts = F.ceil(F.col("size") / F.lit(SHARD)).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    # Small shards share a group of a task; the number of groups goes by the rows, so a group stays small.
    n = rows.count()
    group = F.pmod(F.xxhash64("shard", "low", "high"), F.lit(max(1, -(-n // _GROUP))))
    rows = rows.select(group.alias("group"), "shard", "low", "high", "part", "id", "bits")
    return kept(rows.groupBy("group").applyInArrow(_search, "a bigint, b bigint"), "simhash-links")


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    found = kept(fingerprints(docs), "fingerprints")
    classes = kept(found.groupBy("bits").agg(F.min("doc_id").alias("id")).filter("id IS NOT NULL"), "fingerprint-classes")
    groups = components(links(classes)).withColumnRenamed("node", "id")
    of_bits = classes.join(groups, "id", "left").select(
        F.col("bits").cast("string").alias("key"), F.coalesce("component", "id").alias("component_id")
    )
    # A fingerprint may be that of a third of all documents: its rows are dealt over many tasks.
    rows = found.withColumn("key", F.col("bits").cast("string"))
    out = join_dealt(rows, of_bits, "key", ["doc_id"], "left")
    hexes = F.lpad(F.lower(F.hex("bits")), BITS // 4, "0")
    return out.select(
        "doc_id", hexes.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
