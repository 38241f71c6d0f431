"""The corpus pipeline: quality, near-duplicates, repeated strings, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoweave.llm import packing, quality, secrets, simhash, suffixes
from isoweave.llm.common import free_name, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    names = free_name(docs.columns, "quality_score"), free_name(docs.columns, "keep")
    return quality.classify(spark, docs, names=names).where(names[1]).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id (of these, the smallest hash) of every group of near-duplicates, and one row of those with the same id and text.

    SimHash proposes pairs, prefixes those that its radius misses, exact similarity decides.
    Rows that share an id but no similar text all stay.  Documents with a null id stay.
    """
    groups = simhash.similar(spark, docs)
    sha = free_name(docs.columns, "sha")
    gone = groups.where("NOT first").select("doc_id", F.col("sha").alias(sha)).distinct()
    kept = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256)).join(gone, ["doc_id", sha], "left_anti")
    if groups.where("first").groupBy("doc_id", "sha").count().where("count > 1").limit(1).count():
        kept = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", sha]).unionByName(kept.where("doc_id IS NULL"))
    return kept.select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 100 bytes and more that stand earlier out of the texts."""
    return suffixes.without_repeats(spark, docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mask in place of every secret."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, one row per piece of a document."""
    return packing.packed(spark, docs)


STAGES = [("quality", keep_quality), ("near_duplicates", keep_distinct), ("repeats", cut_repeats), ("secrets", mask_secrets), ("packing", pack)]

#: EM, graph search and tokenisation are beyond SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(spark, docs, f"pipeline-{name}")
    return docs
