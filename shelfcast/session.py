"""Spark session helpers.

The library never creates a session on its own inside an operator; callers pass one in.
``get_session`` is for tests, the bench and command-line use.  Cluster deployments
configure memory, shuffle partitions and the checkpoint folder themselves; we only fill
in values that are unset.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package.  AQE re-plans joins at run time
# (SortMergeJoin -> BroadcastHashJoin when a side turns out small, measured on the real
# shuffle output), splits skewed join partitions and coalesces tiny shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelfcast") -> SparkSession:
    """Return the active session or build a local one for tests / bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SHELFCAST_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; a cluster without one shares its
    warehouse, so scratch tables go below that.  Only a local-mode session without either
    setting (tests, laptops) gets a fresh scratch folder; a cluster with neither is an error,
    because a machine-local folder would not survive executor loss."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return _shared(spark, current)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            configured = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
        elif warehouse := spark.conf.get("spark.sql.warehouse.dir", None):
            configured = f"{_shared(spark, warehouse).rstrip('/')}/shelfcast-scratch"
        else:
            raise RuntimeError("neither spark.checkpoint.dir nor the warehouse is set; point the first at a "
                               "shared folder (HDFS / object store) before running shelfcast on a cluster")
    sc.setCheckpointDir(_shared(spark, configured))
    return sc.getCheckpointDir()


def _shared(spark: SparkSession, folder: str) -> str:
    """Refuse a folder of one machine on a cluster.  A ``file:`` path is shared if every machine
    mounts it: ``spark.shelfcast.fileCheckpointIsShared=true`` says so, else tasks write there
    and the driver looks for their rows, once per application and folder."""
    local = folder.startswith("file:") or "://" not in folder and folder.startswith("/")
    if not local or spark.sparkContext.master.startswith("local"):
        return folder
    mounted = spark.conf.get("spark.shelfcast.fileCheckpointIsShared", "false") == "true"
    if not mounted and not _seen_by_all(spark, folder):
        raise RuntimeError(f"scratch tables would go to {folder}, a path of one machine; set spark.checkpoint.dir to a shared "
                           "folder, or spark.shelfcast.fileCheckpointIsShared=true if all machines mount this one")
    return folder


def _seen_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether rows that tasks on all cores write below ``folder`` are there for the driver and
    for other tasks.  A path of which the driver's machine has nothing is no mount; one that
    is still to be created below a folder it has (a fresh warehouse) is tried like any other."""
    at = Path(unquote(urlparse(folder).path))
    if not any(p.is_dir() for p in (at, *at.parents[:-1])):
        return False
    sc = spark.sparkContext
    seen = sc.__dict__.setdefault("_shelfcast_seen", {})
    if folder not in seen:
        n, path = max(2, 2 * sc.defaultParallelism), f"{folder.rstrip('/')}/shelfcast-probe-{uuid.uuid4().hex}"
        try:
            spark.range(0, n, 1, n).write.parquet(path)
            seen[folder] = spark.read.schema("id long").parquet(path).count() == n
        except (Py4JJavaError, PySparkException):  # a task cannot write there or read what the driver lists
            return False
        finally:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    return seen[folder]


# paths of the tables that this thread's calls have materialised and not yet released
_scratch = threading.local()


def scratch_path(spark: SparkSession, kind: str = "tables/mat") -> str:
    """A fresh path below the shared checkpoint folder, remembered for ``release_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    if not hasattr(_scratch, "paths"):
        _scratch.paths = []
    _scratch.paths.append(path)
    return path


def forget_scratch(path: str) -> None:
    """Leave ``path`` out of later releases: it became a result."""
    paths = getattr(_scratch, "paths", [])
    if path in paths:
        paths.remove(path)


def scratch_mark() -> int:
    """How many paths this thread has taken so far; see ``scratch_since``."""
    return len(getattr(_scratch, "paths", []))


def scratch_since(mark: int = 0) -> list[str]:
    """The paths this thread has taken since ``mark`` and not yet released."""
    return list(getattr(_scratch, "paths", [])[mark:])


def release_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete tables this thread materialised: ``paths``, or all of them.  Call it once nothing
    lazy reads them any more, after the result is written.  Returns how many."""
    own = getattr(_scratch, "paths", [])
    gone = [p for p in (list(own) if paths is None else paths) if p in own]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        own.remove(path)
    return len(gone)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, Spark removes an execution's shuffle files as soon as it ends; else they stay until
    the driver collects its garbage, and the steps of a query pile up on disk.  For writes and
    other actions whose DataFrame is not run again (one that is computes its shuffles anew).  A
    session that sets the option itself keeps its choice."""
    if spark.conf.get(FREE_SHUFFLES, None) is not None:
        yield
        return
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES)


def scratch_read(df: DataFrame) -> list[str]:
    """Those of this thread's unreleased tables that ``df`` reads."""
    read = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    return [p for p in scratch_since() if p.rsplit("/", 1)[-1] in read]


def cut_lineage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and return a
    DataFrame reading it.  Used where a plan is read by several branches or actions.

    Like a reliable checkpoint it survives executor loss (never a local checkpoint), and
    unlike ``Dataset.checkpoint`` (row-serialised files scanned whole) later reads get
    Parquet column pruning and filter push-down.  The shuffle files of the write go with it.
    ``codec``: Parquet compression other than the session's."""
    spark = df.sparkSession
    path = scratch_path(spark)
    with shuffles_freed(spark):
        df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)
