"""The corpus pipeline: stages over the documents table, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parceltrail.llm import bpe, cube_mix, exact_dedup, quality, simhash
from parceltrail.llm.common import documents, ship, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on this input and its labels, doesn't reject."""
    return quality.keep_good(docs, quality.labels_of(spark, sf_dir))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z) the row of the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of four-word SimHash fingerprints within four bits the row of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, words=4, radius=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: a row per copy."""
    return cube_mix.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every row of the mix."""
    return bpe.digests(docs)


STAGES = [
    ("quality", good),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mix", mixed),
    ("bpe", encoded),
]

#: Trained models and sampling have no SQL form; tests/llm/test_pipeline.py compares each stage to a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
