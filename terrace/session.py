"""Session settings and the shared scratch area.

Library functions take the caller's ``SparkSession``; ``build_session`` is only
a convenience for tests, the benchmark and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this library relies on.  AQE re-plans joins at runtime
# and splits skewed join partitions and skewed write partitions.  Broadcasts
# are decided on *measured* sizes only: the static, estimate-based threshold
# is off (file-size estimates ignore compression and filter selectivity and
# can pick the fact side), the adaptive threshold converts a shuffle join to
# a broadcast join once the small side's shuffle output is known to be small.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # An aggregate never takes over a coarser partitioning of its input (say, a join's on one of the
    # grouping columns), where a hot value would hold its rows in one task that nothing can split.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # A write task has the rows of a few partitions: it keeps that many files open and sorts only what is beyond them.
    "spark.sql.maxConcurrentOutputFileWriters": "24",
    "spark.sql.parquet.mergeSchema": "false",
}

# For aggregates whose keys hardly repeat: the small map that Spark probes before the hash map meets none of them.
UNIQUE_KEYS_CONF = {"spark.sql.codegen.aggregate.map.twolevel.enabled": "false"}

# For writes whose frames nobody runs again: a write's shuffle files go when it ends, not when the driver happens to
# collect its garbage.  (A frame that is run again after all makes them anew.)
CLEAN_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def apply_conf(spark: SparkSession, conf: dict | None = None) -> None:
    """Apply the library's SQL settings to an existing session (all runtime-settable)."""
    for k, v in (conf or RECOMMENDED_CONF).items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


@contextmanager
def session_conf(spark: SparkSession, conf: dict) -> Iterator[None]:
    """SQL settings for the jobs that run inside the block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    apply_conf(spark, conf)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "terrace", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("TERRACE_DRIVER_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 16),
        # Local tuning only: lets AQE keep several write tasks for small batches.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster it must be set: a folder of one machine would scatter staged
    tables over the executors' own disks.  Only a local master gets a folder
    made, registered with the SparkContext so that ``DataFrame.checkpoint``
    uses the same place.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrace-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, on its own file system."""
    return f"{shared_dir(spark)}/terrace/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staging path this library created (Hadoop FileSystem API)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
