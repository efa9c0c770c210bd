"""A training corpus from documents: quality, near duplicates, mix, packing.

Each stage is a function of (spark, docs, sf_dir). ``run`` writes what a stage returns as
Parquet to the shared folder and hands the table that it reads back to the next one. All
but the last return the columns of documents; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perennial.llm import kneser_ney, odd_sketch, pareto_mix, variable_bins
from perennial.llm.shared import settle, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney model of the trusted ones does not reject."""
    return kneser_ney.keep_good(docs, kneser_ney.trusted_ids(table(spark, sf_dir, "labels")))


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with similar sets of five-word shingles (0.8 or more)."""
    return odd_sketch.drop_near_duplicates(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice has two rows."""
    return pareto_mix.mixed(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in sequences of the permitted lengths, one row per piece of a document."""
    return variable_bins.packed_documents(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("minhash_near_dedup", different_documents),
    ("mixing", mixed_documents),
    ("best_fit_packing", packed_documents),
]

# The classifier, the hashes and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
