"""Corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup,
benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.llm import decontam, langid, packing, simhash, substring
from sessionlab.llm.common import fold
from sessionlab.llm.queries import tokenizer_path
from sessionlab.sources.store import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of undetermined language (no text or no letter) go."""
    model = langid.fit(docs.where(fold(F.col("doc_id"), 3) != 1))
    return langid.determined(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays, that of the smallest id."""
    return simhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 100 that occurred before go; ``n_chars`` follows."""
    out = substring.rewrite(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    return packing.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# classifier, fingerprints and tokenizer have no SQL form: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
