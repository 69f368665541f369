"""From raw documents to packed training sequences.

Each stage gets what the one before kept, as a table, and its decisions take effect in what it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import exact_dedup, mixing, packing, quality, simhash
from cohortlens.llm.common import documents, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules go, and all of hosts whose shrunk failure rate is too high."""
    return quality.passing_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints (three-word shingles) that link at two or fewer differing bits."""
    return simhash.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; the one at a source's cut is shortened."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources", mixture),
    ("best-fit packing", sequences),
]
# Fingerprints and token ids are beyond SQL; tests/llm/test_pipeline.py holds the stages and the run against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for at, (name, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = stage(docs, name.replace(" ", "-").lower())
    return docs
