"""Joins against dimension tables: broadcast by measured size, hot keys dealt out otherwise."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROWS = "spark.ledgerline.broadcastMaxRows"
_BYTES = "spark.ledgerline.broadcastMaxBytes"
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Bytes of a row besides its text: row header, and a fixed slot per column.
_ROW_BYTES, _SLOT_BYTES = 16, 16
# A key is hot from this share of a mean partition on; so at most this many times the partitions
# can be hot.
_HOT_SHARE = 4
# Entries that the frequency sketch tracks for each one it reports.
_SKETCH_SHARE = 32


def measured(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count of ``df`` and the bytes of every text column, in one aggregate."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sums = [F.coalesce(F.sum(F.octet_length(c).cast("bigint")), F.lit(0)).alias(c) for c in texts]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *sums).first()
    return row["__rows"], {c: row[c] for c in texts}


def fits_broadcast(df: DataFrame, rows: int, text_bytes: dict[str, int]) -> bool:
    """Whether the columns of ``df``, of measured size, are within the row and byte bounds."""
    conf = df.sparkSession.conf
    size = rows * (_ROW_BYTES + _SLOT_BYTES * len(df.columns)) + sum(text_bytes.get(c, 0) for c in df.columns)
    return rows <= int(conf.get(_ROWS, str(DEFAULT_BROADCAST_MAX_ROWS))) and size <= int(
        conf.get(_BYTES, str(DEFAULT_BROADCAST_MAX_BYTES))
    )


def _partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def frequent(spark: SparkSession, key: str) -> Column:
    """An aggregate, for ``hot_keys``, of the most frequent values of ``key``: a sketch of bounded size
    (at most a million entries), so several codes can be summed up in a pass that is made anyway."""
    top = min(100_000, _HOT_SHARE * _partitions(spark) + 1)
    tracked = min(1_000_000, max(1024, _SKETCH_SHARE * top))
    return F.expr(f"approx_top_k({key}, {top}, {tracked})")


def hot_keys(spark: SparkSession, found: Sequence, rows: int) -> list[tuple[str, int]]:
    """(key, salts) of the keys with more than a quarter of a mean partition among ``rows`` rows, from
    a ``frequent`` aggregate.  Counts are good to a fraction of that share; they only set how
    many tasks a key is dealt over."""
    unit = max(1.0, rows / (_partitions(spark) * _HOT_SHARE))
    return [(r["item"], math.ceil(r["count"] / unit)) for r in found if r["item"] is not None and r["count"] > unit]


def _counted_hot_keys(facts: DataFrame, key: str) -> DataFrame:
    parts = _partitions(facts.sparkSession)
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    unit = counts.agg(F.greatest(F.lit(1.0), F.sum("__n") / F.lit(parts * _HOT_SHARE))).scalar()
    hot = counts.withColumn("__unit", unit).filter(F.col("__n") > F.col("__unit"))
    return hot.select(key, F.ceil(F.col("__n") / F.col("__unit")).cast("int").alias("__salts"))


def join_dealt(
    facts: DataFrame, dim: DataFrame, key: str, spread: Sequence[str], how: str = "inner",
    hot: Sequence[tuple[str, int]] | None = None,
) -> DataFrame:
    """Equi-join of ``facts`` and ``dim`` on the text column ``key`` in which no key lands in one task.

    Keys that hold more than a quarter of a mean partition are hot; there are at most four times as
    many as partitions, which bounds the broadcast list.  They are given by ``hot`` (see ``hot_keys``)
    or else found by a count (partial sums, so the count itself is not skewed; it runs ``facts`` a
    second time).  Their fact rows are dealt over salts by a hash of ``spread``, and only their
    dimension rows are repeated, once a salt.  NULL keys match nothing: they are dealt over all
    partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    parts = _partitions(facts.sparkSession)
    if hot is None:
        hot = _counted_hot_keys(facts, key)
    else:
        hot = facts.sparkSession.createDataFrame(list(hot), f"`{key}` string, __salts int")
    hot = F.broadcast(hot)

    dealt = F.xxhash64(*spread)
    salt = F.coalesce(F.pmod(dealt, F.col("__salts")), F.lit(0)).cast("int")
    left = facts.join(hot, key, "left")
    # A NULL key never equals a dimension's: its rows get negative salts, which no dimension has.
    left = left.withColumn("__salt", F.when(F.col(key).isNull(), -1 - F.pmod(dealt, F.lit(parts * 64)).cast("int")).otherwise(salt))
    left = left.withColumn("__key", F.coalesce(key, F.lit(""))).drop("__salts")
    right = dim.join(hot, key, "left")
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
    right = right.filter(F.col(key).isNotNull()).withColumn("__key", F.col(key)).drop("__salts", key)
    return left.join(right, ["__key", "__salt"], how).drop("__key", "__salt")
