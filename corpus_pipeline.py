"""A corpus pipeline: quality rules, near duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Its result is written and read again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import encode_documents
from tessera.llm.common import fresh_path, remove, scratch, table
from tessera.llm.mixing import mix
from tessera.llm.near_duplicates import one_of_each
from tessera.llm.pii import redact
from tessera.llm.quality_rules import apply_quality_rules


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return apply_quality_rules(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays."""
    return one_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts become their kind in brackets."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated up to 1.5 times; every document stays, in the order of the mixture."""
    return mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mixture."""
    return encode_documents(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("pii", pii), ("mixing", mixing), ("bpe", bpe)]

#: SQL can't express verified MinHash classes, block permutations or byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage wrote on its way goes when it has ended, its input when the next table stands."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        with scratch(spark, f"{name}-steps"):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
