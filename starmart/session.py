"""Session construction and the shared folder for lineage cuts and tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library wants. They are only applied by
# ``get_spark``; a session handed in by a caller is used as it is.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def launched() -> bool:
    """Was this process started by spark-submit, which then names the master?"""
    return "PYSPARK_GATEWAY_PORT" in os.environ


def get_spark(cpus: int | str = "*", shuffle_partitions: int | None = None,
              app: str = "starmart", extra: dict | None = None) -> SparkSession:
    """A local session for tests, the bench and the examples.

    On a cluster, build the session with the cluster's launcher instead and
    pass it in; nothing in the library depends on local mode.
    """
    builder = SparkSession.builder.appName(app)
    if launched():  # by spark-submit: master, sizes and memory are the launcher's
        if shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1) * 2)
        builder = (builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(parts))
                   .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_for_scale(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
                   broadcast_bytes: int = 64 << 20) -> dict:
    """Size the runtime SQL settings for a job reading ``input_bytes``.

    * shuffle partitions: enough that each holds about
      ``target_partition_bytes`` (AQE coalesces them when a stage is small,
      so over-provisioning is cheap and under-provisioning spills);
    * AQE advisory size and skew thresholds on the same scale, so a hot key
      (a customer, an order, a store with a large share of the rows) is split
      into several tasks by the skew-join rule;
    * scan splits of the same size, so a task reads about one target;
    * the broadcast threshold: dimensions under it are broadcast, larger
      ones are joined by shuffle (the check of size is Spark's, on table
      statistics at planning and on actual sizes under AQE).

    Returns the settings applied. Only runtime SQL settings are changed, so
    this works on a running session.
    """
    parts = max(200, int(input_bytes // target_partition_bytes) + 1)
    conf = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset (a bare local test session)
    is a private folder created, and only in local mode: a cluster must name a
    shared folder, since a machine-local one is not visible to other
    executors and does not survive their loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="starmart-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staging folder of the library's own."""
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)
