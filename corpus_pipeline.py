"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all documents the one before kept. All but the last
return the columns of docs. run() writes each stage as Parquet into the shared checkpoint folder and reads it
back, so a lost executor repeats tasks of one stage only. Texts go to Python in small batches, in the jobs that a
stage runs itself and in those that run() writes its result by.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from playmart.llm import decontaminate, line_dedup, packing, quality, simhash
from playmart.llm.common import shared_folder, small_batches, table
from playmart.llm.queries import WORD_VOCABULARY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    with small_batches(spark):
        return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    with small_batches(spark):
        return line_dedup.line_dedup(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints, that of the smallest id."""
    with small_batches(spark):
        return simhash.first_of_groups(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    with small_batches(spark):
        return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequence and place."""
    with small_batches(spark):
        return packing.pack_documents(docs, WORD_VOCABULARY)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# SimHash, tiling and tokenising are beyond SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        with small_batches(spark):
            docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
