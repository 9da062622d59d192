"""Training-corpus pipeline: STAGES are applied in order to ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmarts.llm.common import materialise, table
from sparkmarts.llm.decontaminate import remove_contaminated
from sparkmarts.llm.line_crf import accept
from sparkmarts.llm.packing import pack
from sparkmarts.llm.secret_scan import redact
from sparkmarts.llm.simhash_bktree import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    return accept(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest doc_id."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def scrub_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' sequences with their bucket, batch and slot."""
    return pack(docs, with_text=True)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", scrub_secrets),
    ("packing", packing),
]

#: a trained classifier and XXH64 fingerprints are beyond SQL; tested against
#: brute force in tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
