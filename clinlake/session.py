"""Spark session settings for the warehouse.

The settings are the ones the plans rely on: UTC session time zone (all
event times are ``timestamp_ntz`` and must not shift), ANSI mode (bad casts
raise, so parsing uses ``try_*`` functions), and adaptive execution with
skew-join splitting and runtime broadcast conversion.  Broadcasts are never
forced on data that grows with the input: a join side is broadcast only when
Catalyst's size estimate or AQE's measured shuffle size is under the
threshold, which is the size check (see :data:`BROADCAST_CONF`).
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # partial aggregation must stay on: hot keys collapse map-side
    "spark.sql.execution.useObjectHashAggregateExec": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Catalyst's estimate of a side that has not run is the size of its compressed
# files, cut down to the columns it uses; it knows nothing of rows that a
# generator adds.  The relation that the driver builds was up to 40 times as
# large, and the suite builds several at once, so the estimate is held to what
# tables of fixed size have.  Any other side is broadcast by its measured size
# alone (bytes of its rows before compression, half of what their hash table takes).
BROADCAST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "4m",
}
DEFAULT_BROADCAST = ("10485760b", "10485760", "10m", "10MB")  # Spark's own

# Core settings (fixed when the context starts, so only set by build_session):
# checkpoint files are deleted once the checkpointed data is unreachable.
CORE_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Cluster profile for ~100 TB inputs on ~1000 executors.  Size the shuffle
# partitions by the largest shuffle: its bytes / 256 MB, up to what the
# shuffle service bears.  40,000 are 256 MB each for a 10 TB shuffle (keys,
# periods, distinct events); a fact's full rows of a 100 TB input are 2.5 GB
# each, which sorts with spill.  AQE coalesces smaller shuffles toward the
# advisory size instead of maximising parallelism; scans
# read 512 MB splits; dimensions up to 64 MB broadcast (by measured size),
# larger ones sort-merge; partitions over 512 MB and 5x the median are
# split as skewed.  Decommissioning migrates shuffle and cached blocks off
# a departing executor so losing it does not force recomputation.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clinlake", profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the warehouse settings.

    On a cluster ``master`` is left to spark-submit; locally pass
    ``local[N]``.  ``shuffle_partitions`` is only a starting point: AQE
    coalesces small partitions and splits skewed ones at runtime.
    ``profile="cluster"`` adds :data:`CLUSTER_CONF` (values already set by
    spark-submit win).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if profile == "cluster":
        from pyspark import SparkConf

        submitted = SparkConf()  # what spark-submit / spark-defaults already set
        for k, v in CLUSTER_CONF.items():
            if not submitted.contains(k):
                b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false")
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = configure(b.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the warehouse settings to a session created elsewhere.

    Thresholds of broadcasts are only set where the session leaves Spark's default."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    if spark.conf.get("spark.sql.autoBroadcastJoinThreshold") in DEFAULT_BROADCAST:
        for k, v in BROADCAST_CONF.items():
            spark.conf.set(k, v)
    return spark


# An action's shuffle files are deleted when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup = threading.Lock()


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Actions started inside delete their shuffle files when they end: for writes, whose result is read from the table.

    The session's own setting comes back when the last of several threads leaves."""
    notes = spark.__dict__.setdefault("_clinlake_cleanup", {"inside": 0})
    with _cleanup:
        if not notes["inside"]:
            notes["own"] = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        notes["inside"] += 1
    try:
        yield
    finally:
        with _cleanup:
            notes["inside"] -= 1
            if not notes["inside"]:
                spark.conf.set(SHUFFLE_CLEANUP, notes["own"])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names that folder; it is only set here when it is unset
    and the session runs in local mode (tests, local benchmarks).  On a
    cluster an unset folder is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints on a cluster must "
                           "survive the loss of the machine that wrote them")
    local = tempfile.mkdtemp(prefix="clinlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local
