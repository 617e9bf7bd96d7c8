"""Session construction and lineage-cut location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session clock (timestamps are zone-less),
# ANSI arithmetic (overflow and bad casts raise instead of wrapping), AQE for
# runtime coalescing / skew splitting / broadcast conversion behind a measured
# size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, minimum: int = 8) -> int:
    """Shuffle partition count so each partition holds about ``target_bytes``
    of the largest shuffled input (e.g. 100 TB of lines -> ~400k partitions;
    AQE coalesces the small ones and splits skewed ones at runtime)."""
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder, wherever Spark can read it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tillpoint",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    The launcher's master is kept unless one is given, and so is its number of
    shuffle partitions; ``shuffle_partitions_for`` sizes one to the input (AQE
    coalesces small partitions and splits skewed ones).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage-cut folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local master without one (tests)
    gets a private scratch folder; elsewhere executors could not share it, so
    its absence is an error.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tillpoint-ckpt-")
    sc.setCheckpointDir(local)
    return local


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for lineage-cut tables written by the jobs (shared on a cluster)."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint location; what is written
    there is removed when the application ends."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path
