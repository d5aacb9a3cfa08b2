"""Session defaults and the shared checkpoint folder.

The library never creates its own cluster settings on a real cluster: it reads
what the session already has. Only when a setting is unset (local runs, tests)
does it fill in a local default.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: AQE re-plans joins and coalesces small
# shuffle partitions at run time, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # image and vector stages hold whole pictures per row: an Arrow batch ends at
    # 2048 rows or 64 MB, whichever comes first (the byte cap also splits
    # mapInPandas input: 100 KB rows arrive 672 to a batch)
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def local_session(
    master: str | None = None,
    app: str = "featureflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests, the bench and the examples (UI off)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FEATUREFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in DEFAULT_CONF for keys the session leaves unset."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    Uses the session's ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session without one gets a fresh folder under
    the system temp dir; on a cluster an unset value is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="featureflow-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # a local run's own folder
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) before running")


def materialize(df):
    """Write ``df`` once as a reliable checkpoint in the shared checkpoint
    folder and return the checkpointed frame (lineage cut, so later jobs and
    task retries read these files instead of redoing the work)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


PARTITION_BYTES = 256 << 20


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths``, from file-system metadata
    (no data is read)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    jvm, hconf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(hconf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


MAX_SHUFFLE_PARTITIONS = 100_000


def scale_conf(total_bytes: int, partition_bytes: int = PARTITION_BYTES,
               max_partitions: int = MAX_SHUFFLE_PARTITIONS) -> dict[str, str]:
    """Settings that keep every task near ``partition_bytes``: file splits of
    that size, and a starting shuffle width of input / ``partition_bytes``
    that AQE then coalesces toward the same advisory size. The width is
    capped (shuffle bookkeeping grows with map tasks x reduce partitions), so
    past ``max_partitions x partition_bytes`` partitions grow and spill
    instead."""
    n = min(max_partitions, max(1, -(-int(total_bytes) // int(partition_bytes))))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
    }


def size_for_input(spark: SparkSession, paths, partition_bytes: int = PARTITION_BYTES,
                   max_partitions: int = MAX_SHUFFLE_PARTITIONS) -> dict[str, str]:
    """Apply ``scale_conf`` for the inputs under ``paths`` to every key the
    session leaves unset; returns what was set."""
    applied = {}
    for k, v in scale_conf(input_bytes(spark, paths), partition_bytes, max_partitions).items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
            applied[k] = v
    return applied
