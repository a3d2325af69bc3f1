"""Quality rules with host verdicts (operator 5): DataFrame functions only.

Every document gets counts over its whole text and a base verdict; failures are then summed by
host, each host's failure rate is shrunk towards a beta prior fitted to all hosts (empirical
Bayes), and the host's verdict is joined back to its documents.

Defined cases.  A null or empty text has zero words and fails the base rule.  Null hosts form
one host of their own.  Repeated rows count as often as they occur.  Other columns of the input
are not looked at and come back unchanged from ``apply_rules``; an input column that has the
name of a result column is replaced by it.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import WORD_BREAK, kept, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PCT = 30
#: A host is rejected when its shrunk failure rate is at least this.
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\f\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*MEASURES, "base_failed", "host_rate", "host_failed", "kept"]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts of every whole text.

    Repeated windows: the hashes of all 8-word windows of a text are numbered by position and
    sorted, so equal windows become neighbours; only texts that do hold an equal pair pay for
    that sort.  A word is covered once however many repeated windows it lies in.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.withColumn("__words", F.filter(F.split(t, WORD_BREAK), lambda w: w != ""))
    base = base.withColumn("__hash", F.transform("__words", lambda w: F.xxhash64(w)))
    n = F.size("__words")
    last = n - F.lit(WINDOW)
    window = lambda i: F.xxhash64(*[F.get("__hash", i + F.lit(j)) for j in range(WINDOW)])
    base = base.withColumn(
        "__windows", F.when(last >= 1, F.transform(F.sequence(F.lit(0), last), window)).otherwise(F.array().cast("array<bigint>"))
    )
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    keyed = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    base = base.withColumn("__sorted", F.when(repeats, F.array_sort(keyed)))
    same = lambda i, j: F.get("__sorted", i)["h"] == F.get("__sorted", j)["h"]
    again = F.filter(
        "__sorted",
        lambda x, i: F.coalesce(same(i, i + F.lit(1)), F.lit(False))
        | F.coalesce(F.when(i > 0, same(i, i - F.lit(1))), F.lit(False)),
    )
    base = base.withColumn("__at", F.array_sort(F.transform(again, lambda x: x["i"])))
    gap = lambda x, i: F.when(i == 0, F.lit(WINDOW)).otherwise(
        F.least(F.lit(WINDOW), x - F.get("__at", i - F.lit(1)))
    )
    covered = F.aggregate(F.transform("__at", gap), F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(_without(x, _BLANKS)) > 0)
    base = base.withColumn("__lines", lines)
    chars = F.length(t)
    return base.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in RESULTS],
        n.cast("bigint").alias("n_words"),
        F.length(_without(t, _BLANKS)).cast("bigint").alias("word_chars"),
        (chars - F.length(_without(t, SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    ).withColumn("base_failed", base_failed())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PCT)


def host_verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: documents, failures, shrunk rate, verdict.

    Prior: beta with the mean and variance of the hosts' own failure rates (method of moments).
    With fewer than two hosts, or rates that do not vary, or vary more than a beta can, the prior
    weighs as much as one document.  The sums over hosts are one aggregate row.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("bigint")).alias("n_failed")
    )
    rate = F.col("n_failed").cast("double") / F.col("n_docs")
    # Sums of rates scaled to whole numbers: the same in whatever order hosts are added.
    scaled = F.rint(rate * 1e6).cast("decimal(20,0)")
    prior = hosts.agg(
        F.count(F.lit(1)).cast("double").alias("k"), F.sum(scaled).cast("double").alias("s1"),
        F.sum((scaled * scaled).cast("decimal(30,0)")).cast("double").alias("s2"),
    ).select(
        (F.col("s1") / 1e6 / F.greatest("k", F.lit(1.0))).alias("mean"),
        F.greatest(F.lit(0.0), F.col("s2") / 1e12 / F.greatest("k", F.lit(1.0))
                   - F.pow(F.col("s1") / 1e6 / F.greatest("k", F.lit(1.0)), F.lit(2.0))).alias("var"),
    )
    spread = F.col("mean") * (1 - F.col("mean"))
    weight = F.when((F.col("var") > 0) & (F.col("var") < spread), spread / F.col("var") - 1).otherwise(F.lit(1.0))
    prior = prior.select("mean", F.greatest(weight, F.lit(1.0)).alias("weight"))
    mean, weight = prior.select("mean").scalar(), prior.select("weight").scalar()
    shrunk = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.select(
        "host", "n_docs", "n_failed", shrunk.alias("host_rate"), (shrunk >= MAX_HOST_RATE).alias("host_failed")
    )


def apply_rules(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, the host's rate and verdict, and ``kept``.

    The counts are written once and read twice (host sums, join), so texts are scanned once.
    """
    return with_verdicts(kept(measure(docs, text), "rules"), host)


def with_verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """Join the hosts' verdicts back to measured documents (a hot host is split by AQE)."""
    verdict = host_verdicts(measured, host).select(F.col("host").alias("__host"), "host_rate", "host_failed")
    out = measured.join(verdict, F.col(host).eqNullSafe(F.col("__host")), "left").drop("__host")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over ``documents``; only counts are written, no text."""
    docs = table(spark, sf_dir, "documents")
    measured = kept(measure(docs.select("doc_id", "source", "text")).drop("text"), "rules")
    return with_verdicts(measured).select("doc_id", *MEASURES, "base_failed", "kept")


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cover AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cover c ON c.doc_id = d.doc_id),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PCT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM f GROUP BY source),
r AS (SELECT CAST(round_even(k::DOUBLE / n * 1e6, 0) AS DECIMAL(20, 0)) AS x FROM h),
s AS (SELECT count(*)::DOUBLE AS c, sum(x)::DOUBLE AS s1, sum(x * x)::DOUBLE AS s2 FROM r),
p AS (SELECT s1 / 1e6 / greatest(c, 1) AS mu,
             greatest(0, s2 / 1e12 / greatest(c, 1) - pow(s1 / 1e6 / greatest(c, 1), 2)) AS v FROM s),
b AS (SELECT mu, CASE WHEN v > 0 AND v < mu * (1 - mu) THEN greatest(mu * (1 - mu) / v - 1, 1) ELSE 1 END AS wt FROM p),
verdict AS (SELECT source, (k + mu * wt) / (n + wt) >= {MAX_HOST_RATE} AS host_failed FROM h, b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept
FROM f JOIN verdict v ON f.source IS NOT DISTINCT FROM v.source
"""
