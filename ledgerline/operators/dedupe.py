"""Keep one row per business key with an explicit, total tie-break."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every ``keys`` group under ``order``.

    Expressed as ``row_number() = 1`` over a window so Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle: every map task already cuts each key down to one
    row, so even a key holding a third of the input ships only one row per task.
    ``order`` must be total (append every remaining column) or the kept copy depends on the
    order the file was read in.
    """
    rn = "__dedupe_rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def dedupe_and_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], sums: Mapping[str, Column]
) -> DataFrame:
    """The first row of every ``keys`` group (by ``order``, ascending, NULLs last), with ``sums`` over
    all rows of the group, in one aggregation.

    The same rows as ``dedupe_by_key``, for callers that also have to know something of the copies
    that go.  Both sides of the shuffle aggregate, so a key with very many copies ships one row a
    task.  ``order`` must be total over the columns that are in neither ``keys`` nor ``sums``.  Those
    that it names by text are shuffled once, as part of the rank; the others beside it.
    """
    rest = [c for c in df.columns if c not in keys and c not in sums]
    ranked = {c: f"v{i}" for i, c in enumerate(order) if isinstance(c, str)}
    rank = [
        part for i, c in enumerate(order) for v in [F.col(c) if isinstance(c, str) else c]
        for part in (v.isNull().alias(f"n{i}"), v.alias(f"v{i}"))
    ]
    beside = [c for c in rest if c not in ranked]
    firsts = [F.min(F.struct(*rank)).alias("__rank")]
    firsts += [F.min_by(F.struct(*beside), F.struct(*rank)).alias("__beside")] if beside else []
    one = df.groupBy(*keys).agg(*firsts, *[F.sum(c).alias(name) for name, c in sums.items()])
    at = {c: f"__rank.{ranked[c]}" if c in ranked else f"__beside.{c}" for c in rest}
    return one.select(*keys, *[F.col(at[c]).alias(c) for c in rest], *sums)
