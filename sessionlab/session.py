"""SparkSession construction and cluster-wide settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job of the library relies on.  AQE re-plans joins and
# coalesces partitions at runtime; skew-join splits hot join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files are removed once their RDD is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sessionlab", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    ``master="local[8]"``.  ``spark.checkpoint.dir`` is only set when the
    cluster did not name one (tests), see :func:`checkpoint_dir`.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``; when it is unset, a local master
    falls back to a folder under ``$SESSIONLAB_SCRATCH`` or ``/tmp``, and a
    cluster is refused: executors would write to their own disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = os.path.join(os.environ.get("SESSIONLAB_SCRATCH", "/tmp"), "sessionlab-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


# Target bytes of input per shuffle partition when sizing from the input.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def input_bytes(df) -> int:
    """Total size of the files behind ``df``: Spark lists them, on the
    executors where they are many, and sums up; no data is read."""
    from pyspark.sql import functions as F

    from sessionlab.sources.sinks import input_roots
    files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(input_roots(df))
    return files.agg(F.sum("length")).first()[0] or 0


def size_shuffle_partitions(spark: SparkSession, df, target_bytes: int = TARGET_PARTITION_BYTES,
                            minimum: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about one partition per
    ``target_bytes`` of input (at least the default parallelism), unless the
    job set it explicitly.  AQE then coalesces small partitions at runtime;
    it cannot split too-large ones, so the start value must scale with the
    data (100 TB -> ~800k partitions of 128 MB)."""
    if "spark.sql.shuffle.partitions" in spark.conf.getAll:  # set by the job or cluster
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = minimum or spark.sparkContext.defaultParallelism
    n = max(floor, -(-input_bytes(df) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
