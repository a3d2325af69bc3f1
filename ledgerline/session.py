"""Session helpers: building a session for tests/bench and locating the shared scratch folder."""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should run with.  ANSI stays on (Spark 4 default):
# bad casts fail loudly instead of turning into NULL silently, and every place where the
# reference relies on a lenient cast uses an explicit try_* form.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def job_session(app: str = "ledgerline") -> SparkSession:
    """The session of a job: whatever spark-submit or the caller has set up.

    No master, partition count or memory is set here; only what the rules depend on is, and only
    for a session of our own making.
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    return SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or "app"


def _is_local(spark: SparkSession) -> bool:
    """One JVM: ``local``, ``local[n]`` or ``local[n, m]``, but not ``local-cluster[...]``."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def _own_folder(root: str, app: str) -> str:
    """The application's folder, directly under the shared one: with a folder between them that the
    first user makes, the next user's application could not write."""
    return f"{root.rstrip('/')}/ledgerline-{app}"


# (application, path) of folders that were found to be shared.
_SHARED: set[tuple[str, str]] = set()


def _plain(path: str) -> str:
    """A path as Spark tells it, without ``file:``, doubled slashes and dots."""
    return posixpath.normpath("/" + path.removeprefix("file:").lstrip("/"))


def _holds(folder: str, path: str | None) -> bool:
    return path is not None and _plain(path).startswith(_plain(folder).rstrip("/") + "/")


def _is_shared(spark: SparkSession, path: str) -> bool:
    """Whether what the executors write under ``path`` is there for the driver and for each other.

    Spark has to have taken the folder up (its own checkpoint folder lies in it).
    Then more tasks than the cluster has cores write a file each, and the driver must find all of
    them: a task on a machine with a disk of its own leaves its file there.  Machines that join
    later are not tried.
    """
    from .sources.scratch import remove_folder

    key = (app_id(spark), path)
    if key in _SHARED:
        return True
    if not _holds(path, spark.sparkContext.getCheckpointDir()):
        return False
    tasks = max(16, 2 * spark.sparkContext.defaultParallelism)
    probe = f"{_own_folder(path, key[0])}/probe-{uuid.uuid4().hex[:12]}"
    spark.range(0, tasks, 1, tasks).write.parquet(probe)
    found = len(spark.read.schema("id bigint").parquet(probe).inputFiles())
    remove_folder(spark, probe)
    if found != tasks:
        return False
    _SHARED.add(key)
    return True


def _absolute(spark: SparkSession, path: str) -> str:
    """A relative path as Spark takes it: below the working folder of the default file system."""
    if path.startswith("/") or ":" in path.split("/")[0]:
        return path
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    qualified = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    return qualified.removeprefix("file:")


def _set_later(spark: SparkSession, path: str | None) -> str | None:
    """The folder named by ``SparkContext.setCheckpointDir``, when that is not the setting's."""
    own = spark.sparkContext.getCheckpointDir()
    if own is None or (path and _holds(path, own)):
        return None
    at_start = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at_start and _holds(_absolute(spark, at_start), own):
        return None
    return posixpath.dirname(own)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and materialised model tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir`` (read from the
    session).  A path without a scheme, while the cluster's default file system is ``file:``, may
    be a shared mount or each machine's own disk: it is tried out once a session.  (``file:``
    spelled out is taken to be a shared mount.)  Where the setting is missing or not shared, the
    folder that the program named by ``setCheckpointDir`` is taken, tried out likewise; without one
    there is an error.  A local session without the setting gets one folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not _is_local(spark):
        if path:
            path = _absolute(spark, path)
            default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            tried = "://" not in path and not path.startswith("file:") and default.startswith("file:")
            if not tried or _is_shared(spark, path):
                return path
        later = _set_later(spark, path)
        # Spark puts ``file:`` before a path without a scheme.
        if later and (not later.startswith("file:") or _is_shared(spark, later)):
            return later
        found = f", not {path!r} on each machine's disk" if path else " on a cluster"
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder{found}")
    if path:
        return path
    key = app_id(spark)
    if key not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_ROOTS[key]


def new_scratch_dir(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused sub-folder of the shared scratch root."""
    return f"{_own_folder(scratch_root(spark), app_id(spark))}/{kind}-{uuid.uuid4().hex[:12]}"
