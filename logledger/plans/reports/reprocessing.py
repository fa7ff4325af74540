"""What an operator looks at before files are loaded again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.operators.ledger import repeated_files
from logledger.plans.reprocess import UNFINISHED


def unfinished_files(ledger: DataFrame, statuses: Sequence[str] = UNFINISHED) -> DataFrame:
    found = ledger.filter(F.col("status").isin(*statuses))
    return found.select("gcs_uri", "processed_timestamp", "status", "error_message").orderBy(
        F.desc("processed_timestamp"), "gcs_uri"
    )


def file_state(ledger: DataFrame, uri: str) -> DataFrame:
    return ledger.filter(F.col("gcs_uri") == uri).select(
        "gcs_uri", "processed_timestamp", "rows_loaded", "status"
    )


def files_in_range(ledger: DataFrame, start: v.Instant, end: v.Instant) -> DataFrame:
    """Files processed between two instants, both included."""
    span = F.col("processed_timestamp").between(v.instant(start), v.instant(end))
    return (
        ledger.filter(span)
        .select("gcs_uri", "processed_timestamp", "rows_loaded", "status")
        .orderBy("processed_timestamp", "gcs_uri")
    )


def reload_preview(ledger: DataFrame) -> DataFrame:
    return ledger.agg(
        F.lit("FULL RELOAD WARNING").alias("warning"),
        F.count("*").alias("files_to_reprocess"),
        F.sum("rows_loaded").alias("rows_to_delete"),
    )


def duplicate_ledger_entries(ledger: DataFrame) -> DataFrame:
    return repeated_files(ledger)
