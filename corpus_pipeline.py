"""From raw documents to packed training sequences: five stages over the operators in `bedfeed.llm`.

Each stage takes all that its predecessor kept. The first three drop documents (low quality, near copies, benchmark
passages), the fourth takes personal data out of the texts, and the last places what is left in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bedfeed.llm import decontaminate, near_dedup, packing, pii, quality
from bedfeed.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.first_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_of(docs, table(spark, sf_dir, "benchmark"), window=13)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", packing_stage),
]

# The components of near-duplicates and the plan of a packing are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bin_id, position, capacity): the packed pieces of the documents that stay."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
