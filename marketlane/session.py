"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import logging
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# What a task takes in, where the session leaves it to Spark. A compressed byte of a
# shuffle stands for some 25 in a sort or hash table: 64 MB of it, Spark's own size, do not
# fit four tasks of a 10 GB executor, which then spill. A small table in day folders is
# written by all cores, not by one task for all its folders. Folders of a table are listed
# by this many tasks at most, not by one task for each.
TASK_SIZES = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": ("10000", "64"),
    "spark.sql.files.maxPartitionBytes": ("134217728b", "32m"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "16m"),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": ("1048576b", "16k"),
}
_SHUFFLES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Stored input behind one shuffle partition: a relation may be shuffled at some four times its size.
INPUT_PER_PARTITION = 4 << 20

_RUN_ID = uuid.uuid4().hex[:12]
_SIZED: set[tuple[str, str]] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """The one setting results depend on, and how much a task takes in.

    Everything else is the session's own choice, and so are these sizes where it sets them.
    """
    for key, (default, ours) in TASK_SIZES.items():
        if spark.conf.get(key, None) in (None, default):
            spark.conf.set(key, ours)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        log.warning("session time zone set to UTC: dates follow it")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """As many shuffle partitions as the stored input calls for, so that a task's share does
    not grow with it; AQE merges small ones. A number the session has set itself stays."""
    key = (spark.sparkContext.applicationId, spark.conf.get(_SHUFFLES, None))
    if key[1] is not None and key not in _SIZED:
        return
    wanted = max(input_bytes // INPUT_PER_PARTITION, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(_SHUFFLES, str(wanted))
    _SIZED.add((key[0], str(wanted)))


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and for the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marketlane")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # Facts join several one-row-per-order relations in a row; splitting a hot order
        # in the first join is worth the extra shuffle before the next.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    Where that is unset, the warehouse directory serves if it is on a shared file system.
    A temporary folder serves on a local master only; a cluster without either is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return _own_folder()
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or ""
    if "://" in warehouse and not warehouse.startswith("file:"):
        return warehouse.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="marketlane-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def run_folder(spark: SparkSession, *parts: str) -> str:
    """A folder of this run below the shared folder."""
    return "/".join([shared_folder(spark), f"marketlane-{_RUN_ID}", *parts])


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder below the shared folder that no earlier call returned."""
    return run_folder(spark, f"{label}-{uuid.uuid4().hex[:12]}")
