"""Corpus pipeline: quality rules, toxicity, near-duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs.  All stages but the last return the columns of ``documents``.

Defined cases.  Null, empty or blank texts fail the quality rules, and so do documents of rejected
hosts; they go.  Rows without doc_id are judged like others, have no label and no copies, and are
packed.  Repeated rows share one verdict; all rows with the doc_id that stays of a group do stay.  Very
long texts are read whole by every stage.  An empty table stays one.  Extra columns come back from all
stages but the last; one that is named like a result of a stage (``kept``, ``score``) holds that result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import minhash, packing, quality_rules, substring_dedup, toxicity
from ledgerline.llm.tables import kept, table


def _only(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`") for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host does (null texts fail)."""
    return _only(quality_rules.apply_rules(docs).filter("kept"), docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from the labelled ones among them."""
    scored = toxicity.score_rows(docs, table(spark, sf_dir, "labels"))
    return _only(scored.filter("predicted = 0"), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies."""
    return minhash.drop_near_copies(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; n_chars is counted anew."""
    out = _only(substring_dedup.remove_repeats(docs), docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, packing.vocabulary(), with_ids=False)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("near_dedup", near_copies),
    ("substring_dedup", passages),
    ("packing", packed),
]

#: Trees, sentence runs and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
