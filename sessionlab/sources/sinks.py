"""Sinks and the feature store.

All writes are DataFrame writes of distributed data (no collect): parquet
by default, CSV with header where a flat file is the product.  The feature
store keeps one table per split in a folder per build, and a manifest under
the fingerprint of configuration and inputs; without a complete build of that
fingerprint, or when ``force`` is set, all tables are built anew.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlab.schema import SESSION, TARGET
from sessionlab.sources.clicklog import TIME_FORMAT, csv_reader, csv_writer


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = csv_writer(df, mode) if fmt == "csv" else df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A table written by ``write_table``; CSV needs its schema (columns are
    read by position, no pass over the data infers types)."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    if schema is None:
        raise ValueError("a CSV table is read with its schema")
    return csv_reader(spark).option("mode", "FAILFAST").option("timestampNTZFormat", TIME_FORMAT).schema(schema).csv(path)


def save_processed(train: DataFrame, val: DataFrame, test: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The three processed sets as one table partitioned by ``split``
    (a reader filtering on split prunes the other partitions).  A set without
    a column of another gets it as null."""
    u = (train.withColumn("split", F.lit("train"))
         .unionByName(val.withColumn("split", F.lit("validation")), allowMissingColumns=True)
         .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))
    write_table(u, path, fmt, partition_by=["split"])


def read_processed(spark: SparkSession, path: str, split: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """One split back (partition pruned by the filter); ``schema``,
    for CSV, is that of the training set."""
    if fmt == "csv":
        schema = T.StructType([*schema.fields, T.StructField("split", T.StringType())])
    return read_table(spark, path, fmt, schema).filter(F.col("split") == split).drop("split")


def write_text(spark: SparkSession, lines: list[str], path: str) -> None:
    """A short plain-text file (a list of names, a report), lines in order."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> list[str]:
    """The lines of ``write_text``, in order (one file, read whole)."""
    return "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()).splitlines()


def write_feature_list(spark: SparkSession, features: list[str], path: str) -> None:
    """Plain text, one name per line."""
    write_text(spark, features, path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """The list back in order (bounded by the feature count)."""
    return read_text(spark, path)


def write_predictions(scored: DataFrame, path: str, label: str = TARGET, pred: str = "prediction",
                      fmt: str = "parquet") -> None:
    """(user_session, actual, predicted)."""
    write_table(scored.select(SESSION, F.col(label).alias("actual"), F.col(pred).alias("predicted")), path, fmt)


def submission_frame(scored: DataFrame, pred: str = "prediction") -> DataFrame:
    """(user_session, session_value) with predictions floored at 0."""
    return scored.select(SESSION, F.greatest(F.col(pred).cast("double"), F.lit(0.0)).alias(TARGET))


def create_submission(scored: DataFrame, path: str, pred: str = "prediction", fmt: str = "csv") -> DataFrame:
    sub = submission_frame(scored, pred)
    write_table(sub, path, fmt)
    return sub


# ---------------------------------------------------------------- S5

def _plan(df: DataFrame) -> list:
    """The analysed plan as JSON with expressions numbered in order of
    appearance: literals, columns and operators in full, nothing that differs
    between two sessions."""
    numbers: dict = {}

    def plain(x):
        if isinstance(x, dict):
            if x.get("product-class", "").endswith(".ExprId"):
                return numbers.setdefault((x["id"], x["jvmId"]), len(numbers))
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return plain(json.loads(df._jdf.queryExecution().analyzed().toJSON()))


def input_roots(df: DataFrame) -> list[str]:
    """Files or folders that ``df`` reads, from its analysed plan (a cached
    frame has them too).  A frame with any other leaf, as rows made on the
    driver or a checkpoint, has no files to be recognised by."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        try:
            paths = leaf.relation().location().rootPaths()
        except Py4JError as e:
            raise ValueError("an input that reads no files cannot be recognised again") from e
        roots.update(paths.apply(j).toString() for j in range(paths.size()))
    return sorted(roots)


def input_fingerprint(*dfs: DataFrame) -> str:
    """Hash of what is read (path, size and modification time of every input
    file) and how (the plan).  Spark lists the files, on the executors where
    they are many, and reduces them to one row; no data is read.  Functions
    written in Python count by their names."""
    items = []
    for df in dfs:
        files = (df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(input_roots(df))
                 .select(F.xxhash64("path", "length", F.unix_micros("modificationTime")).alias("h")))
        found = files.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
        items.append([_plan(df), [str(v) for v in found]])
    return hashlib.sha256(json.dumps(items, sort_keys=True).encode()).hexdigest()


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, path: str, stamp: str) -> list[str]:
    """Complete builds of a fingerprint, the newest last."""
    fs, found = _file_system(spark, f"{path}/manifests/{stamp}/*/_SUCCESS")
    done = sorted((s.getModificationTime(), s.getPath().getParent().getName()) for s in (fs.globStatus(found) or []))
    return [name for _, name in done]


def cached_feature_tables(spark: SparkSession, path: str, builders: dict, config: dict,
                          inputs: list[DataFrame], force: bool = False) -> dict[str, DataFrame]:
    """``builders`` maps split name -> zero-argument callable returning
    that split's feature DataFrame; all tables are reused or all are built.

    A build goes to a folder of its own, and the manifest that names it, under
    the fingerprint of configuration and inputs, is written last: a build that
    dies is never found, two writers do not disturb each other, and readers of
    an earlier build keep their files.  ``force`` first withdraws the manifests
    of the fingerprint, so that a forced build that dies is not answered by an
    earlier one.  ``prune_versions`` deletes old builds."""
    stamp = hashlib.sha256(json.dumps([config, input_fingerprint(*inputs), sorted(builders)], sort_keys=True).encode()).hexdigest()
    done = _versions(spark, path, stamp)
    if force or not done:
        if force:
            fs, at = _file_system(spark, f"{path}/manifests/{stamp}")
            fs.delete(at, True)
        version = uuid.uuid4().hex
        for s, build in builders.items():
            build().write.parquet(f"{path}/versions/{version}/{s}")
        (spark.createDataFrame([(json.dumps({"config": config, "splits": sorted(builders)}, sort_keys=True),)], "manifest string")
         .coalesce(1).write.text(f"{path}/manifests/{stamp}/{version}"))
        done = [version]
    return {s: spark.read.parquet(f"{path}/versions/{done[-1]}/{s}") for s in builders}


def prune_versions(spark: SparkSession, path: str) -> int:
    """Delete every build but the newest complete one of each fingerprint, and
    builds without a manifest; call it while no writer is at work.  Returns
    the number of deleted builds."""
    fs, at = _file_system(spark, f"{path}/manifests")
    keep = set()
    for stamp in (fs.listStatus(at) if fs.exists(at) else []):
        name = stamp.getPath().getName()
        newest = _versions(spark, path, name)[-1:]
        keep.update(newest)
        for m in fs.listStatus(stamp.getPath()):
            if m.getPath().getName() not in newest:
                fs.delete(m.getPath(), True)
    gone = 0
    fs, at = _file_system(spark, f"{path}/versions")
    for v in (fs.listStatus(at) if fs.exists(at) else []):
        if v.getPath().getName() not in keep:
            fs.delete(v.getPath(), True)
            gone += 1
    return gone
