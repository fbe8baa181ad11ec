"""Documents made ready for training: rated, told by language, freed of exact and near copies, and packed.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes what a stage returns as
Parquet in the shared folder and reads it again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import bin_completion, block_naming, langid_ppm, probminhash, quality_ordinal
from folioscope.llm.scratch import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the top grade is at least ``quality_ordinal.LEAST_TAIL``."""
    ratings = quality_ordinal.graded(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_ordinal.accepted_documents(docs, quality_ordinal.fit(docs, ratings))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language's statistics explain."""
    return langid_ppm.accepted_documents(docs, langid_ppm.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return block_naming.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return probminhash.without_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the sequences to train on."""
    return bin_completion.packed(docs)


STAGES = [("quality classifier", quality), ("language ID", language), ("exact dedup", exact), ("MinHash near-dedup", near), ("best-fit packing", packing)]

#: The classifier, the language model, near copies and the search for packings have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing of what every stage before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
