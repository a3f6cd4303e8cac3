"""The corpus pipeline: from raw documents to a decontaminated, deduplicated mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import decontaminate, jaccard, lines, mixing, toxicity
from stopwise.llm.common import in_small_batches, restored_batches, table
from stopwise.storage import fresh_dir, save


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier does not reject."""
    in_small_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines; n_chars follows the text."""
    left = lines.drop_boilerplate(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    in_small_batches(spark)
    return jaccard.first_of_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, with the words the mix takes of it."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    root = fresh_dir(spark, "pipeline")
    with restored_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = save(stage(spark, docs, sf_dir), f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier is trained, which SQL cannot say; tests compare the stages with brute force.
ORACLE_SQL = None
