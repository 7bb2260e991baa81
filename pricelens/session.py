"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on. Sizes are chosen for large inputs:
# AQE re-plans joins at runtime (broadcast only when the measured side is
# under the threshold), splits skewed shuffle partitions and coalesces small
# ones; file splits stay at 256 MB so a task reads a bounded slice.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "pricelens", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs (cluster jobs get theirs from the submitter)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("PRICELENS_DRIVER_MEMORY", "8g")))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage; leaving it unset there
    is an error, because a machine-local folder is lost with its machine. A
    local session, where driver and executors are one process, gets a default.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = "/tmp/checkpoints/pricelens"
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


#: Bytes of a generated method beyond which the JVM leaves it uncompiled.
METHOD_BYTES = "8000"


@contextmanager
def compiled_code(spark: SparkSession):
    """While a job over many columns runs: a stage whose generated method would be too long for
    the JVM's compiler is run as operators of their own, whose code Spark splits into methods."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, METHOD_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """While a job writes its rows: its shuffle files go when it ends, not when the driver next
    collects garbage, so that jobs which follow one another don't add up on disk."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def writing(spark: SparkSession):
    """What holds while rows are written: ``compiled_code`` and ``freed_shuffles``."""
    with compiled_code(spark), freed_shuffles(spark):
        yield


#: Bytes of files that a task reads to write them sorted by partition, so that the sort stays in memory.
SORTED_BYTES = 32 * 1024 * 1024


@contextmanager
def small_splits(spark: SparkSession):
    """While rows are written to partitions as they come from files: tasks read ``SORTED_BYTES`` at most."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(name, str(min(size, SORTED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pricelens/{name}-{uuid.uuid4().hex[:12]}"
