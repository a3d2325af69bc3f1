"""Approximate nearest neighbours (operator 3): randomly rotated one-bit codes.

Index: a vector's difference from the centre is rotated by a random orthogonal matrix and keeps one
bit per dimension, packed, with two correction scalars (its length, and the inner product of the
rotated unit vector with its own code).  From them the inner product with a query is estimated
without bias, with an error bound that holds with a probability set by ``EPSILON``.

Search: queries and vectors are dealt out in blocks, and every block of queries meets every block
of vectors.  Within a pair of blocks the packed bits give an estimate for each vector; those with the
smallest estimates are measured exactly, and then every vector whose lower bound is not above the
k-th distance so far is measured too.  Only the k nearest of a pair of blocks go on.

The centre is fitted on at most ``SAMPLE`` vectors (those with the lowest hash of vec_id); every
vector is indexed.

Defined cases.  Vectors that are null, zero, or hold null or non-finite components take no part,
nor do vectors whose length isn't the most frequent one (ties: the longer).  A null vec_id is no
candidate.  Repeated rows are candidates each; a repeated query is answered once.  With fewer than
k candidates all are returned; an empty table gives no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import kept, table

K = 10
SAMPLE = 4096
#: Vectors and queries in a block.
VECTOR_BLOCK = 16_384
QUERY_BLOCK = 1024
#: Queries estimated at once within a pair of blocks.
SLICE = 64
#: Width of the error bound in standard deviations of the estimate.
EPSILON = 4.0
SEED = 20_240_501


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, a function of ``dim`` only."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of the unit vectors with their codes."""
    rest = (vectors - centre) @ turn
    length = np.sqrt((rest * rest).sum(axis=1))
    unit = rest / np.where(length > 0, length, 1.0)[:, None]
    own = np.abs(unit).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(rest > 0, axis=1), length, np.where(length > 0, own, 1.0)


def estimates(bits: np.ndarray, length: np.ndarray, own: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of every query (rotated difference from the centre) to every code, and
    the error bounds."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    inner = (queries.astype(np.float32) @ signs.T).astype(np.float64) / np.sqrt(dim) / own
    size = np.sqrt((queries * queries).sum(axis=1))
    square = length**2 + size[:, None] ** 2 - 2 * length * inner
    spread = np.sqrt(np.maximum(0.0, 1 - own**2)) / own / np.sqrt(max(1, dim - 1))
    return square, 2 * EPSILON * size[:, None] * (length * spread) + 1e-5 * (length**2 + size[:, None] ** 2)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, components added in order."""
    total = np.zeros(len(vectors))
    for j in range(vectors.shape[1]):
        step = vectors[:, j] - query[j]
        total += step * step
    return np.sqrt(total)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _indexer(centre: np.ndarray):
    turn = rotation(len(centre))

    def run(batches):
        for batch in batches:
            x = _matrix(pa.chunked_array([batch.column("embedding")]), len(centre))
            bits, length, own = codes(x, centre, turn)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("embedding"), pa.array([b.tobytes() for b in bits], pa.binary()),
                    pa.array(length), pa.array(own),
                ],
                names=["vec_id", "embedding", "code", "length", "own"],
            )

    return run


def _searcher(centre: np.ndarray, k: int):
    dim, turn = len(centre), rotation(len(centre))
    names = ["query_id", "vec_id", "score"]

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found = ([], [], [])
        if vectors.num_rows and queries.num_rows:
            x, ids = _matrix(vectors["embedding"], dim), vectors["vec_id"].to_numpy()
            raw = b"".join(vectors["code"].to_pylist())
            bits = np.frombuffer(raw, np.uint8).reshape(len(ids), -1)
            length, own = vectors["length"].to_numpy(), vectors["own"].to_numpy()
            y, names_ = _matrix(queries["embedding"], dim), queries["query_id"].to_numpy()
            for at in range(0, len(y), SLICE):
                square, error = estimates(bits, length, own, (y[at : at + SLICE] - centre) @ turn)
                for row in range(len(square)):
                    query, name = y[at + row], names_[at + row]
                    usable = ids != name
                    guess = np.where(usable, square[row], np.inf)
                    most = min(k, int(usable.sum()))
                    if not most:
                        continue
                    first = np.argpartition(guess, most - 1)[:most]
                    worst = distances(x[first], query).max()
                    near = np.flatnonzero(usable & (square[row] - error[row] <= worst * worst))
                    exact = distances(x[near], query)
                    best = np.lexsort((ids[near], exact))[:k]
                    found[0].append(np.full(len(best), name))
                    found[1].append(ids[near[best]])
                    found[2].append(exact[best])
        kinds = (np.int64, np.int64, np.float64)
        columns = [np.concatenate(f) if f else np.zeros(0, t) for f, t in zip(found, kinds, strict=True)]
        return pa.table([pa.array(c.astype(t)) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    v = F.col("embedding")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(finite & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.filter(F.size("embedding") == (sizes["dim"] if sizes else 0))


def build_index(rows: DataFrame) -> tuple[DataFrame, np.ndarray] | None:
    """The index of usable vectors (written), and the centre; nothing without vectors."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()
    if not sample:
        return None
    centre = np.array([r["embedding"] for r in sample]).mean(axis=0)
    schema = "vec_id bigint, embedding array<double>, code binary, length double, own double"
    return kept(rows.mapInArrow(_indexer(centre), schema), "index"), centre


def search(index: DataFrame, centre: np.ndarray, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each of ``queries`` (query_id, embedding)."""
    queries = queries.dropDuplicates(["query_id"])
    deal = lambda df, size: max(1, -(-df.count() // size))
    v_blocks, q_blocks = deal(index, VECTOR_BLOCK), deal(queries, QUERY_BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("v", F.pmod(F.xxhash64("vec_id"), F.lit(v_blocks)).cast("int")).withColumn("q", every(q_blocks))
    right = queries.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int")).withColumn("v", every(v_blocks))
    pairs = left.groupBy("v", "q").cogroup(right.groupBy("v", "q"))
    found = pairs.applyInArrow(_searcher(centre, k), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    built = build_index(rows)
    if built is None:
        empty = rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
        return empty.limit(0)
    index, centre = built
    asked = index.filter(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return search(index, centre, asked)


SQL = f"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, v.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                                                   lambda a, b: a + b)) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS "rank", vec_id, score
FROM d QUALIFY "rank" <= {K}
"""
