"""Lineage cuts: write a DataFrame as Parquet under the shared scratch folder and read it back."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch_dir

_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
# By session: how many ask for the removal now, and the setting before the first of them.
_ASKED: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs in here go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and the jobs of a build add up
    on disk.  It is a setting of the session, so queries that other threads run meanwhile lose theirs at
    their ends as well; one that is run again makes them again.
    """
    key = spark._jsparkSession.sessionUUID()
    with _LOCK:
        asked, before = _ASKED.get(key) or (0, spark.conf.get(_REMOVAL, None))
        _ASKED[key] = asked + 1, before
        spark.conf.set(_REMOVAL, "true")
    try:
        yield
    finally:
        with _LOCK:
            asked, before = _ASKED.pop(key)
            if asked > 1:
                _ASKED[key] = asked - 1, before
            elif before is None:
                spark.conf.unset(_REMOVAL)
            else:
                spark.conf.set(_REMOVAL, before)


def materialize(df: DataFrame, name: str, path: str | None = None, folders: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and return a DataFrame reading the written files.

    Later jobs read the files instead of recomputing the lineage, and a lost executor costs a
    re-read, not a recomputation of every shuffle above it.  The folder lives under
    ``spark.checkpoint.dir`` (shared storage on a cluster), never on a machine-local disk.  Columns
    in ``folders`` become sub-folders, which a filter on them prunes.
    """
    spark = df.sparkSession
    target = path or new_scratch_dir(spark, name)
    df.write.mode("overwrite").partitionBy(*folders).parquet(target)
    # The schema is known: reading it back needs no footer-inference job.
    out = spark.read.schema(df.schema).parquet(target)
    return out.select(df.columns) if folders else out


def materialize_passes(passes: Iterable[DataFrame], path: str, folders: Sequence[str] = ()) -> DataFrame:
    """``materialize`` of a table that comes in several parts, written one after the other into ``path``.

    A part's shuffle files are gone before the next one is made, so on disk there is one part's at a
    time.  The files are compressed with Zstandard: they stay as long as the model does.
    """
    df = None
    for df in passes:
        with shuffles_removed(df.sparkSession):
            writer = df.write.mode("append").option("compression", "zstd").partitionBy(*folders)
            writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    return out.select(df.columns) if folders else out


_PASS_BYTES = "spark.ledgerline.passBytes"
DEFAULT_PASS_BYTES = 64 * 1024 * 1024
MAX_PASSES = 8


def pass_count(df: DataFrame) -> int:
    """In how many passes to work through ``df``, by the bytes of the files that it reads.

    What a pass shuffles lies on disk until it ends, and is several times the input.  More passes
    would save little more disk and read the files again each.  Rows that are in no file, whose size
    Spark doesn't know, are one pass.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(s for s in sizes if s < 1 << 62)
    unit = int(df.sparkSession.conf.get(_PASS_BYTES, str(DEFAULT_PASS_BYTES)))
    return max(1, min(MAX_PASSES, -(-known // max(1, unit))))


def in_passes(df: DataFrame, keys: Sequence[str], passes: int) -> Iterator[DataFrame]:
    """``df`` in parts, by a hash of ``keys``: rows with equal keys (NULLs too) are in one part."""
    if passes == 1:
        yield df
        return
    for i in range(passes):
        yield df.filter(F.pmod(F.xxhash64(*keys), F.lit(passes)) == F.lit(i))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever Spark's file systems reach it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def files_digest(spark: SparkSession, paths: Sequence[str]) -> tuple[int, int, int, int]:
    """Number, bytes and a 128-bit digest of the files under ``paths``, by path, length and change time.

    Spark lists the files and hashes what the listing says of each; none is opened, and only one row
    comes back.  A file that is rewritten under its name changes the digest.
    """
    about = ["path", "length", "modificationTime"]
    files = spark.read.format("binaryFile").load(list(paths)).select(*about)
    mixed = [F.coalesce(F.bit_xor(F.xxhash64(F.lit(i), *about)), F.lit(0)) for i in range(2)]
    return tuple(files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), *mixed).first())
