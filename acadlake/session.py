"""Session construction and shared-storage helpers.

Every job in the package is lazily planned DataFrame code; this module only
decides configuration.  On a cluster the session comes from the platform and
only the settings that are unset get a default here (``ensure_defaults``).
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  UTC pins epoch -> text conversions (F5) and
# parquet timestamps; AQE lets joins against small dimensions turn into
# broadcast joins at run time and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Dimension tables (courses, units, the course-code map, coordinators) are tiny
# and bounded by the institution, not by the data volume.  The automatic
# broadcast threshold stays at Spark's default so a dimension that grows past
# it falls back to a sort-merge join instead of being shipped to every task.
AUTO_BROADCAST_BYTES = str(10 * 1024 * 1024)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "acadlake") -> SparkSession:
    """Local/test session.  On a cluster use ``ensure_defaults(spark)``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.autoBroadcastJoinThreshold", AUTO_BROADCAST_BYTES)
    builder = builder.config("spark.driver.memory", os.environ.get("ACADLAKE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply BASE_CONF keys that the session does not set yet (runtime-settable only)."""
    for key, value in BASE_CONF.items():
        if key == "spark.ui.enabled":
            continue
        try:
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        except Exception:  # static conf on a shared cluster session: leave it
            pass
    # timestamps must be interpreted in UTC for the epoch/text conversions
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and versioned tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, fault
    tolerant folder there).  Only when it is unset on a local master, as in tests,
    a folder under the system temp directory is chosen; any other master fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder: executors of "
                               f"{master} do not see each other's disks")
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "acadlake-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/acadlake/{label}-{uuid.uuid4().hex[:12]}"


def source_state(spark: SparkSession, sf_dir: str, *tables: str) -> tuple:
    """A key for things derived from tables: application, checkpoint folder, and the input files
    with their lengths and times (read through Spark's file system, so any store works)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = []
    for name in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            continue
        for status in fs.listStatus(path):
            files.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None), sf_dir, tuple(sorted(files)))


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Cut lineage through a Parquet table written in the shared checkpoint folder.

    One computation of ``df`` and columnar I/O (an RDD ``checkpoint()`` computes the
    plan twice and serialises rows); a lost executor re-reads the files instead of
    recomputing upstream stages.  Never a machine-local folder on a cluster.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def sizing(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a run that reads ``input_bytes`` on ``cores`` task slots.

    Shuffle partitions are sized so one partition holds about ``target_partition_bytes``
    of the largest input (it fits an executor task without spilling), never fewer than two
    waves of tasks; scan splits and AQE's advisory size use the same target, and the
    bucketed mirrors get the same count so their joins stay co-located.
    At 100 TB and 256 MiB this gives ~400k partitions; with AQE coalescing, small stages
    shrink automatically.
    """
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "acadlake.mirror.buckets": str(parts),
    }


def apply_sizing(spark: SparkSession, input_bytes: int, cores: int | None = None) -> dict[str, str]:
    conf = sizing(input_bytes, cores or spark.sparkContext.defaultParallelism)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
