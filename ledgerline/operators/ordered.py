"""Dense numbering and running sums over a total order, without funnelling rows into one task.

``row_number() OVER (ORDER BY ...)`` and ``sum(...) OVER (ORDER BY ... ROWS UNBOUNDED PRECEDING)``
have no partition key, so Spark runs them in a single task.  The reference uses them for surrogate
keys (D1) and for the ABC curve (A3).  Here, for every size of input:

1. the rows are range-partitioned on the whole order, sorted within each partition and written
   once, each with its partition's number and its place in the partition (Spark's row id after the
   sort holds both);
2. counts and sums per partition make the offsets of the partitions, a table of as many rows as
   there are partitions, which is broadcast;
3. number = place + offset.  A running sum needs a window inside the partition as well; only then
   are the (narrow) rows shuffled a second time, by the partition's number.

The order has to be total: append every remaining column, then ties are equal rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize, shuffles_removed

# ``monotonically_increasing_id`` holds the partition above 33 bits of place in the partition.
_PLACE_BITS = 33


def natural_order(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """``(column, descending)`` pairs -> sort columns, NULLs last in both directions."""
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in order]


def ordered_scan(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    number: str | None = None,
    running: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add a dense 1..n ``number`` in ``order``, inclusive ``running`` sums and grand ``totals``.

    ``running`` and ``totals`` map output column -> numeric source column; exact types (integers,
    decimals) give sums that don't depend on the partitions.  A running sum is NULL while only
    NULLs were seen, as a plain running sum is.
    """
    running, totals = dict(running or {}), dict(totals or {})
    keys = natural_order(order)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    with shuffles_removed(df.sparkSession):
        ranged = materialize(ranged.withColumn("__row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__row", _PLACE_BITS)
    placed = ranged.withColumn("__part", part)

    sources = sorted(set(running.values()) | set(totals.values()))
    wide = {s: _widen(df.schema[s].dataType) for s in sources}
    stats = placed.groupBy("__part").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(s).cast(wide[s]).alias(f"__s_{s}") for s in sources]
    )
    # One row per partition: a plain window over them is bounded by the partition count.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = stats.select(
        "__part",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__rows_before"),
        *[F.sum(f"__s_{s}").over(before).cast(wide[s]).alias(f"__before_{s}") for s in sources],
        *[F.sum(f"__s_{s}").over(everything).cast(wide[s]).alias(f"__total_{s}") for s in sources],
    )
    out = placed.join(F.broadcast(offsets), "__part")
    added = {}
    if number:
        place = F.col("__row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
        added[number] = (F.col("__rows_before") + place + F.lit(1)).cast("bigint")
    within = Window.partitionBy("__part").orderBy("__row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, s in running.items():
        own, prior, zero = F.sum(s).over(within).cast(wide[s]), F.col(f"__before_{s}"), F.lit(0).cast(wide[s])
        both = F.coalesce(own, zero) + F.coalesce(prior, zero)
        added[name] = F.when(own.isNotNull() | prior.isNotNull(), both).cast(wide[s])
    for name, s in totals.items():
        added[name] = F.col(f"__total_{s}")
    return out.select(*df.columns, *[c.alias(n) for n, c in added.items()])


def _widen(t: T.DataType) -> T.DataType:
    """Type of a sum of ``t`` that cannot overflow in practice."""
    if isinstance(t, T.DecimalType):
        return T.DecimalType(38, t.scale)
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()
