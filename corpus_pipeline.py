"""Training-corpus pipeline: five stages over ``documents``, each written as
Parquet and read again by the next.

Rows with null or empty texts, repeated rows and null ids are treated as the
operators' docstrings say; extra columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseflow.llm import exact_dedup, mixing, near_dedup, pieces, quality
from caseflow.llm.common import documents, labels, ship_package, stored

# Five-word sets link from this likeness on; 85 is of the query op4 alone.
NEAR_PERCENT = 80


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship_package(spark)
    return quality.keep_rows(docs, labels(spark, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.keep_rows(docs, exact_dedup.new_index(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    ship_package(spark)
    return near_dedup.keep_rows(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeat, go or are cut so that sources reach their target sizes."""
    return mixing.apply_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's number of ids, and digests of its ids and decoded text."""
    ship_package(spark)
    return pieces.encode_digests(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode_pieces),
]

# SQL expresses neither the classifier nor the codec.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return rows
