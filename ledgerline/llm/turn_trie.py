"""Conversation prefix trie (operator 13): a double-array trie per prefix shard, packed over dense
turn ids, traversed for its nodes; aggregates of the upper nodes that shards share are merged globally.

1. A turn becomes the 128-bit digest of its role and text, and the bytes of its text; the texts go
   no further.  A conversation is rebuilt as one row: arrays of digests and bytes.
2. Conversations with equal sequences become one: a sorted stream of (sequence, conv_id) gives each
   distinct sequence its members' count, the smallest of them and the hash of their ids.  So a
   conversation that a third of all rows repeat is one row from here on; its ids, which one hash has
   to read in order, pass through a task as a stream.
3. Distinct sequences are range-partitioned and sorted by their digests, so the members of any prefix
   are neighbours.  Runs of at most ``SHARD_TURNS`` turns are the prefix shards: a hot first turn just
   spreads over many.  In each, turns get dense ids, and BASE and CHECK arrays are packed level by
   level; walking all sequences through them, a level at a time, gives the nodes and their sums.
4. Only nodes on the path of a shard's first or last sequence can have members in another shard: at
   most two paths a shard.  They come out as partial sums with the digest of their path and are merged
   by it.  Sums over the shared nodes' subtrees double their reach every round (a node adds up the
   ancestors that point to it, then points twice as far), so rounds go by the log of the depth.

Order and rebuilding.  Turns are ordered by (turn, null first), ties by the digest of (role, text);
null role or text is empty.  ``base(c) = c - c % group`` with the sign of c in the remainder, and
h = crc32(c in decimal) % span: c has the first h turns of its base, then its own after its first h.

Defined cases.  Rows without conv_id belong to no conversation.  A repeated row is one more turn.  A
conversation left without turns is a member of the root only.  An empty table has no conversation and
no node, not even the root.  Very long texts are hashed whole; the turns of one conversation are
held by one task (20 bytes a turn), as one long text is.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_dealt
from .kernel import slices
from .tables import kept, table

#: Conversations of one group share the head of the first (the one whose id the group divides).
GROUP = 5
#: Heads have fewer turns than this.
SPAN = 9
#: Turns (at most, but for a single longer sequence) of one double-array trie.
SHARD_TURNS = 100_000
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROOT = b"\0" * 16

_NODE = "conv_id bigint, depth bigint, parent binary, parent_conv_id bigint, n_convs bigint, n_children bigint, "
_NODE += "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_PART = _NODE + ", path binary, bytes bigint"


def head_length(conv_id: Column, span: int = SPAN) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % span


def rebuilt(turns: DataFrame, group: int = GROUP, span: int = SPAN) -> DataFrame:
    """(conv_id, turns) of every rebuilt conversation; turns are (key, bytes) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The role's length comes first, so no other role and text read the same.
    key = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.md5(key.cast("binary"))).alias("key"), F.octet_length(text).cast("bigint").alias("bytes"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "bytes"))).alias("own"))
    convs = convs.withColumn("own", F.transform("own", lambda t: F.struct(t["key"], t["bytes"])))
    convs = kept(convs, "conversations")
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = convs.filter(F.col("conv_id") % group == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("own", 1, span - 1).alias("head"))
    both = convs.withColumn("base", base).join(heads, "base", "left")
    h = head_length(F.col("conv_id"), span).cast("int")
    none = F.array().cast(convs.schema["own"].dataType)
    first = F.slice(F.coalesce("head", none), F.lit(1), h)
    rest = F.slice("own", h + F.lit(1), F.greatest(F.size("own"), F.lit(1)))
    return both.select("conv_id", F.concat(first, rest).alias("turns"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct sequence, from (sequence, conv_id) sorted by both: a stream of ids."""
    sequence, low, n, ids = None, 0, 0, None
    for batch in batches:
        out = []
        for key, conv in zip(batch.column("sequence").to_pylist(), batch.column("conv_id").to_pylist()):
            if key != sequence:
                if ids is not None:
                    out.append((low, n, ids.hexdigest()))
                sequence, low, n, ids = key, conv, 1, hashlib.sha256(b"%d" % conv)
            else:
                n += 1
                ids.update(b",%d" % conv)
        yield _record(out, "low bigint, n bigint, ends string")
    if ids is not None:
        yield _record([(low, n, ids.hexdigest())], "low bigint, n bigint, ends string")


def _record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(low, n, ends, keys, bytes): every distinct sequence with its smallest member, the members'
    count and the hash of their ids in ascending order."""
    keys = F.transform("turns", lambda t: t["key"])
    convs = convs.select("conv_id", keys.alias("keys"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))
    digits = F.array_join(F.transform("keys", lambda k: F.hex(k)), "")
    convs = kept(convs.withColumn("sequence", F.unhex(F.sha2(digits.cast("binary"), 256))), "rebuilt")
    ids = convs.select("sequence", "conv_id").repartition("sequence").sortWithinPartitions("sequence", "conv_id")
    members = kept(ids.mapInArrow(_members, "low bigint, n bigint, ends string"), "members")
    return members.join(convs.select(F.col("conv_id").alias("low"), "keys", "bytes"), "low")


class DoubleArray:
    """Trie of integer sequences: the child of node s by code c is BASE[s] + c, if CHECK of it is s.

    Slots are numbered from 1; the root is slot 0.
    """

    def __init__(self, size: int) -> None:
        self.base = np.zeros(size + 2, np.int64)
        self.check = np.full(size + 2, -1, np.int64)
        self.check[0] = 0
        self._free = 1  # every slot below is taken

    def _grow(self, size: int) -> None:
        more = max(size - len(self.check), len(self.check))
        self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _free_slots(self, n: int) -> np.ndarray:
        """The first n free slots."""
        free = np.flatnonzero(self.check[self._free :] < 0) + self._free
        if len(free) < n:
            self._grow(len(self.check) + n)
            free = np.flatnonzero(self.check[self._free :] < 0) + self._free
        self._free = int(free[0])
        return free[:n]

    def add_level(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """The children of one level's nodes; pairs are distinct and sorted by parent, then code."""
        node, at, n = np.unique(parents, return_index=True, return_counts=True)
        for s, first, many in zip(node[n > 1].tolist(), at[n > 1].tolist(), n[n > 1].tolist()):
            own = codes[first : first + many]
            base = self._place(own)
            self.base[s] = base
            self.check[base + own] = s
        single, code = node[n == 1], codes[at[n == 1]]
        if len(single):
            slots = self._free_slots(len(single))
            self.base[single] = slots - code
            self.check[slots] = single

    def _place(self, codes: np.ndarray) -> int:
        """A base that has free slots for all ``codes``: tried from the first free slots on, then the end."""
        for slot in self._free_slots(32).tolist():
            slots = codes + (slot - codes[0])
            if slots[-1] >= len(self.check):
                self._grow(int(slots[-1]) + 1)
            if (self.check[slots] < 0).all():
                return slot - int(codes[0])
        taken = int(np.flatnonzero(self.check >= 0)[-1])
        base = taken + 1 - int(codes[0])
        if base + int(codes[-1]) >= len(self.check):
            self._grow(base + int(codes[-1]) + 1)
        return base

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Child slots of ``nodes`` by ``codes``; -1 where there is none."""
        slots = self.base[nodes] + codes
        inside = (slots > 0) & (slots < len(self.check))
        slots = np.where(inside, slots, 0)
        return np.where(inside & (self.check[slots] == nodes), slots, -1)


def pack(codes: np.ndarray, bounds: np.ndarray) -> DoubleArray:
    """The double-array trie of sequences ``codes[bounds[i]:bounds[i + 1]]``, built level by level."""
    trie = DoubleArray(len(codes))
    length = np.diff(bounds)
    at = np.zeros(len(length), np.int64)
    alive = np.flatnonzero(length > 0)
    depth = 0
    while len(alive):
        c = codes[bounds[alive] + depth]
        pairs = np.unique(np.stack([at[alive], c]), axis=1)
        trie.add_level(pairs[0], pairs[1])
        at[alive] = trie.step(at[alive], c)
        depth += 1
        alive = alive[length[alive] > depth]
    return trie


def _shard(low, n, ends, keys, bytes_, bounds) -> pa.RecordBatch:
    """The nodes of one shard: whole ones, and (with their path) those it may share.

    Arguments: smallest member, members and hash of ids of every sequence (sorted by their digests);
    digests and text bytes of all turns; the sequences' bounds in these.
    """
    _, codes = np.unique(keys, return_inverse=True)
    codes = codes.astype(np.int64)
    trie = pack(codes, bounds)
    size, length, count = len(trie.check), np.diff(bounds), len(low)
    members, smallest = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depth, width, ended = np.full(size, -1), np.zeros(size, np.int64), np.full(size, -1)
    shared = np.zeros(size, bool)
    paths: dict[int, bytes] = {}  # slot of a shared node -> digest of its path
    at, alive, level = np.zeros(count, np.int64), np.arange(count), 0
    chain = {0: _ROOT, count - 1: _ROOT}
    while len(alive):
        if level:
            turn = bounds[alive] + level - 1
            at[alive] = trie.step(at[alive], codes[turn])
            width[at[alive]] = bytes_[turn]
        here = at[alive]
        depth[here] = level
        np.add.at(members, here, n[alive])
        np.minimum.at(smallest, here, low[alive])
        done = alive[length[alive] == level]
        ended[at[done]] = done
        for edge in chain:  # the first and the last sequence
            if length[edge] >= level:
                if level:
                    chain[edge] = hashlib.md5(chain[edge] + keys[bounds[edge] + level - 1].tobytes()).digest()
                shared[at[edge]] = True
                paths[int(at[edge])] = chain[edge]
        alive = alive[length[alive] > level]
        level += 1
    slots = np.flatnonzero(depth >= 0)
    slots = slots[np.argsort(-depth[slots], kind="stable")]
    whole = ~shared
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    cuts = np.flatnonzero(np.diff(depth[slots])) + 1
    for group in np.split(slots, cuts):  # deepest first: children are complete before their parents
        own = group[whole[group]]
        leaves[own] += children[own] == 0
        saved[own] += (members[own] - 1) * width[own]
        if depth[group[0]]:
            up = trie.check[group]
            np.add.at(children, up, whole[group].astype(np.int64))
            np.add.at(leaves, up, leaves[group])
            np.add.at(saved, up, saved[group])
    up = np.where(depth[slots] > 0, trie.check[slots], 0)
    is_shared, parent_shared = shared[slots], shared[up] & (depth[slots] > 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(smallest[slots]), pa.array(depth[slots].astype(np.int64)),
            pa.array([paths[int(u)] if s else None for u, s in zip(up, parent_shared)], pa.binary()),
            pa.array(smallest[up], mask=parent_shared | (depth[slots] == 0)), pa.array(members[slots]),
            pa.array(children[slots]), pa.array(leaves[slots]), pa.array(saved[slots]),
            pa.array([ends[e] if e >= 0 else None for e in ended[slots].tolist()], pa.string()),
            pa.array([paths[int(s)] if y else None for s, y in zip(slots, is_shared)], pa.binary()),
            pa.array(width[slots]),
        ],
        names=[f.strip().split(" ")[0] for f in _PART.split(",")],
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the sorted sequences of a partition into shards."""
    rows, turns = [], 0
    for batch in slices(batches):
        for row in zip(*[batch.column(c).to_pylist() for c in ("low", "n", "ends", "keys", "bytes")]):
            if rows and turns + len(row[3]) > SHARD_TURNS:
                yield _of_rows(rows)
                rows, turns = [], 0
            rows.append(row)
            turns += len(row[3])
    if rows:
        yield _of_rows(rows)


def _of_rows(rows: list[tuple]) -> pa.RecordBatch:
    low, n, ends, keys, bytes_ = zip(*rows)
    bounds = np.cumsum([0, *map(len, keys)])
    flat = np.frombuffer(b"".join(b"".join(k) for k in keys), "V16")
    flat = flat.view([("h", ">u8"), ("l", ">u8")]).copy()
    return _shard(
        np.array(low, np.int64), np.array(n, np.int64), ends, flat, np.array([b for x in bytes_ for b in x], np.int64), bounds
    )


def shared_nodes(parts: DataFrame) -> DataFrame:
    """The nodes that shards share, merged by the digest of their path; sums over their subtrees."""
    merged = parts.filter(F.col("path").isNotNull()).groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("whole_children"), F.sum("n_leaves").alias("whole_leaves"),
        F.sum("saved_tokens").alias("whole_saved"), F.max("ends_sha256").alias("ends_sha256"), F.first("bytes").alias("bytes"),
    )
    merged = kept(merged, "shared")
    below = merged.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("more"))
    merged = merged.join(below, "path", "left").withColumn("n_children", F.col("whole_children") + F.coalesce("more", F.lit(0)))
    merged = merged.withColumns(
        {
            "n_leaves": F.col("whole_leaves"), "saved_tokens": F.col("whole_saved"),
            "leaf": (F.col("n_children") == 0).cast("bigint"), "own": (F.col("n_convs") - 1) * F.col("bytes"),
        }
    )
    merged = kept(merged.drop("whole_children", "whole_leaves", "whole_saved", "more", "bytes"), "shared-nodes")
    # The sums of whole nodes below are already those of all shared ancestors in the same shard, so only
    # what the shared nodes themselves add is carried up.
    reach = merged.select("path", F.col("parent").alias("jump"), "leaf", "own")
    while not reach.filter("jump IS NOT NULL").isEmpty():
        inc = reach.filter("jump IS NOT NULL").groupBy(F.col("jump").alias("path"))
        inc = inc.agg(F.sum("leaf").alias("leaf_below"), F.sum("own").alias("own_below"))
        further = reach.select(F.col("path").alias("jump"), F.col("jump").alias("next"))
        reach = reach.join(inc, "path", "left").join(further, "jump", "left").select(
            "path", F.col("next").alias("jump"), (F.col("leaf") + F.coalesce("leaf_below", F.lit(0))).alias("leaf"),
            (F.col("own") + F.coalesce("own_below", F.lit(0))).alias("own"),
        )
        reach = kept(reach, "reach")
    sums = reach.select("path", F.col("leaf").alias("leaves_added"), F.col("own").alias("own_added"))
    out = merged.drop("leaf", "own").join(sums, "path").withColumns(
        {"n_leaves": F.col("n_leaves") + F.col("leaves_added"), "saved_tokens": F.col("saved_tokens") + F.col("own_added")}
    )
    up = merged.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return kept(out.drop("leaves_added", "own_added").join(up, "parent", "left"), "shared-sums")


_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(turns: DataFrame, group: int = GROUP, span: int = SPAN) -> DataFrame:
    """One row per node of the prefix trie of all rebuilt conversations."""
    sequences = distinct_sequences(rebuilt(turns, group, span))
    parts = sequences.repartitionByRange("keys").sortWithinPartitions("keys").mapInArrow(_shards, _PART)
    parts = kept(parts, "trie")
    shared = shared_nodes(parts)
    whole = parts.filter(F.col("path").isNull())
    # A hot first turn is the parent of very many nodes: they are dealt over many tasks.
    up = shared.select(F.hex("path").alias("key"), F.col("conv_id").alias("up_conv_id"))
    hung = whole.filter(F.col("parent").isNotNull()).withColumn("key", F.hex("parent"))
    hung = join_dealt(hung, up, "key", ["conv_id", "depth"], "left").withColumn("parent_conv_id", F.col("up_conv_id"))
    out = whole.filter(F.col("parent").isNull()).select(*_RESULT)
    out = out.unionByName(hung.select(*_RESULT)).unionByName(shared.select(*_RESULT))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(table(spark, sf_dir, "conversations"))


# crc32 bit by bit: every byte is xor-ed in, then eight shifts (marked -1) follow.
_CRC = """list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
      lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS BIGINT)) ELSE a // 2 END)"""

SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS bytes,
         md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT c, list(struct_pack(k := k, b := CAST(bytes AS BIGINT)) ORDER BY turn NULLS FIRST, k, bytes) AS own FROM t GROUP BY c),
h AS (SELECT c, own, c - c % {GROUP} AS base, xor({_CRC}, 4294967295) % {SPAN} AS h FROM o),
r AS (
  SELECT h.c, list_concat(CASE WHEN h.h > 0 THEN coalesce(b.own[1:h.h], []) ELSE [] END, h.own[h.h + 1:]) AS s
  FROM h LEFT JOIN o b ON b.c = h.base),
p AS (SELECT c, len(s) AS n, s, unnest(range(0, len(s) + 1)) AS d FROM r),
m AS (
  SELECT c, n, d, list_transform(s[1:d], lambda x: x.k) AS path,
         CASE WHEN d > 0 THEN s[d].b ELSE 0 END AS bytes FROM p),
g AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM m GROUP BY path, d),
ch AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL),
f AS (
  SELECT g.*, coalesce(ch.n_children, 0) AS n_children, u.conv_id AS parent_conv_id
  FROM g LEFT JOIN ch ON ch.path = g.path LEFT JOIN g u ON g.d > 0 AND u.d = g.d - 1 AND u.path = g.path[1:g.d - 1]),
a AS (SELECT path[1:e] AS path, n_children, n_convs, bytes FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM f)),
s AS (
  SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens FROM a GROUP BY path)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM f JOIN s ON s.path = f.path
"""
