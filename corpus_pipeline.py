"""Clean, de-duplicate, mix and pack the documents of a corpus.

Each stage takes (spark, docs, sf_dir) and returns documents with all their columns, the last one the pieces of the packed
sequences. ``run`` writes each stage's rows to the shared folder and reads them again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from tidemark.llm.common import kept, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model of the labels of the documents at hand."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of all documents with the same text but for white space."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near-duplicates, which share 80 of 100 shingles or more (op2: 85)."""
    return near_dedup.without_near_copies(docs, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", copies),
    ("near_dedup", near_copies),
    ("mixing", mixture),
    ("packing", packed),
]

#: Tokens, sketches and the fit of a model are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
