"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result
is written as Parquet and read back as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.llm.decontaminate import clean_documents
from logledger.llm.packing import pack
from logledger.llm.quality_rules import keep_good
from logledger.llm.queries import table
from logledger.llm.secrets import redacted
from logledger.llm.similar import similar_documents
from logledger.llm.simhash import one_of_each
from logledger.llm.staging import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rule or a learned rule rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near-duplicates: texts that share at least 0.8 of
    their shingles of five words. SimHash with Golay keys links the nearest, MinHash what lies beyond
    its bits. (op2's bound of two bits binds only its query.)"""
    return one_of_each(docs, similar_documents(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a window of a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents; secrets in their texts become marks."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts and packs the documents: one row per piece, with its ids and its place in a sequence.
    ``packing.sequences`` puts the pieces of each sequence together."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", packing),
]

#: Learned rules, fingerprints and token ids are beyond SQL; the tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}
