"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component: the smallest node.

    In each round every node points to the neighbour (or itself) that comes first in a hashed
    order, edges are relabelled and loops dropped; the pointers of all rounds are composed at
    the end.  The hashed order makes the edges shrink by a constant share a round, chains of
    consecutive ids included.  Minima are partial aggregates and both relabelling joins are plain
    equi-joins, so a node with very many links is combined before the shuffle or split by AQE.
    Each round's edges and pointers are written below spark.checkpoint.dir.
    """
    first = lambda c: F.min(F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n")))
    e = kept(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    label = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(first("b").alias("m"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("n"))
        step = kept(step.select(F.col("a").alias("node"), F.least("m", own)["n"].alias("to")), "pointers")
        if label is None:
            label = step
        else:
            on = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
            label = label.join(on, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        a = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        b = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = e.join(a, "a").join(b, "b").filter("x <> y")
        e = kept(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if label is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    label = kept(label, "labels")
    low = label.groupBy("to").agg(F.min("node").alias("component"))
    return label.join(low, "to").select("node", "component")
