"""The corpus pipeline: stages of the operators of ``askquarry.llm``, each over what the one before kept.

Between stages the rows are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from askquarry.llm import exact_dup, mixing, packing, quality
from askquarry.llm import near_dup as near
from askquarry.llm.common import Stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Null and empty texts have a score too, repeated rows the same one."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest doc_id; null texts are empty, of repeated rows one stays."""
    return exact_dup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest doc_id: five-word shingles, similarity of 0.8.

    Null ids are the last choice; rows without words all stay.
    """
    return near.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document taken more than once is repeated. Null is a source of its own."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places; a null text is empty, repeated rows are packed each."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", classify),
    ("exact_dedup", exact),
    ("near_dedup", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned scores and random draws are beyond SQL; tests hold the rows that each stage keeps against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of what all stages keep; empty documents give none. A stage is deleted once the next is written."""
    stages = Stages(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = stages.save(stage(spark, docs, sf_dir), name)
        stages.drop(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
