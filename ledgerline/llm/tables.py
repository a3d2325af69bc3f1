"""Reading the given tables and cutting lineage, shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialize

WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below spark.checkpoint.dir and read back (survives lost executors)."""
    return materialize(df, f"llm-{name}")


def numbered(df: DataFrame, keep: Collection[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns numbered but for those in ``keep``, and the new name of each column: Python
    functions over batches take no column that has a dot in its name."""
    names = {c: c if c in keep else f"__c{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may learn from: crc32 of the id as text divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, label, text) of at most ``most`` labelled rows outside the held-out fold: those with the
    lowest hash of doc_id, with the higher label of a doc_id labelled twice, and of one with different
    texts the first in binary order."""
    marked = labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("bigint").alias("label"))
    marked = marked.filter("label IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most ``most`` ids and labels are broadcast.
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
