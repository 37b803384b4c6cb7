"""From raw documents to packed training sequences: each stage works on all that the one before has kept.

    quality_classifier  documents that score below 0.3 go
    near_dedup          of documents alike in 80 % of their five-word shingles the one with the smallest id stays
    decontamination     documents that contain a benchmark item go
    secret_scan         secrets are replaced by a mark
    packing             token ids are cut and packed into sequences of 2048
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ramure.llm.common import stored, table
from ramure.llm.decontaminate import decontaminate
from ramure.llm.near_dedup import Similarity, deduplicate
from ramure.llm.packing import pack_documents
from ramure.llm.quality_classifier import accept, train
from ramure.llm.secrets import redact_secrets

#: Every document has to score at least so much.
LEAST_SCORE = 0.3
SIMILARITY = Similarity(shingle=5, percent=80)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels, held-out ones excepted, accepts."""
    labels = table(spark, sf_dir, "labels").where("crc32(cast(doc_id as string)) % 5 <> 0")
    return accept(docs, train(docs, labels), LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return deduplicate(docs, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and their characters counted again."""
    masked = redact_secrets(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars"))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and their place in a sequence."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: A fitted classifier can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
