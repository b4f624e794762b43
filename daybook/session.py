"""Session settings and the shared working folder.

Everything here is plain Spark configuration. The settings matter at scale:

* AQE re-plans joins at runtime: a join side that turns out small after its
  shuffle is broadcast, a large one stays a sort-merge join, and a partition
  holding a hot key (one customer, or all guest lines) is split into several
  tasks by the skew-join rule.
* Off local mode, shuffles start with many partitions and AQE coalesces them
  to the advisory size, so one setting serves a small table and a 100 TB one.
* The session time zone defaults to UTC so ``to_date`` of a timestamp is
  reproducible.

These are defaults: what spark-submit, spark-defaults or the caller sets wins.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Listing a table with thousands of day folders runs as a Spark job;
    # a bounded task count keeps each task listing a useful batch of folders.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files (the single-day job checkpoints one day of customer
    # rows) are removed once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


#: Partitions that a shuffle starts with on a cluster, before AQE merges small ones.
INITIAL_PARTITIONS = 8000


def build_session(
    master: str | None = None,
    app_name: str = "daybook",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset (spark-submit provides it) and size
    ``shuffle_partitions`` to the input, e.g. input bytes / 128 MB; AQE then
    coalesces small ones.
    """
    SparkContext._ensure_initialized()
    given = SparkConf()  # what spark-submit and spark-defaults set
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = dict(SCALE_CONF)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    elif not is_local(master or given.get("spark.master", "local")):
        defaults["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(INITIAL_PARTITIONS)
    for key, value in defaults.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be storage every
    executor can reach; without it this raises. Only in local mode, where
    driver and executors are one process, a private folder is created when it
    is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured and not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="daybook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_location(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/daybook-{label}-{uuid.uuid4().hex[:12]}"


def remove_location(spark: SparkSession, location: str) -> None:
    """Delete a folder that a job made for itself, through its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Let Spark send this package to Python workers that could not import it.

    Workers see the driver's PYTHONPATH and working folder, or what
    ``--py-files`` shipped; only where the package is on neither path is it
    zipped and added to the session, once.
    """
    root = Path(__file__).resolve().parent.parent
    known = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    if root in known or not (root / "daybook").is_dir() or getattr(spark.sparkContext, "_daybook_shipped", False):
        return
    spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/daybook", "zip", root, "daybook"))
    spark.sparkContext._daybook_shipped = True
