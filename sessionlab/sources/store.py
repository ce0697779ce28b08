"""Staged intermediate tables in the cluster's shared checkpoint folder.

A table reused by several jobs (the adapted click log, a feature table read
by two selection passes) is written once as parquet under
``spark.checkpoint.dir`` and read back: the lineage is cut, a lost executor
does not trigger recomputation from the raw events, and later reads get
column pruning and pushed-down filters (the split date filter reaches the
parquet scan).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sessionlab.session import checkpoint_dir


_STAGED: dict[str, list[str]] = {}


def new_folder(spark, name: str) -> str:
    """A path in the shared folder that nothing was written to yet; deleted by
    ``release``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release(spark) -> int:
    """Delete every table this application staged (call when the results
    that read them are written).  Returns the number of tables removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)
