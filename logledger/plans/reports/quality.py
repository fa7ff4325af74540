"""Is the data right: nulls, failed casts, duplicates, archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions import json_lines as jl
from logledger.functions import values as v
from logledger.operators.assemble import one_row
from logledger.plans.reports.common import LAST_DAY, recent, top


def null_check(base: DataFrame, now: v.Instant) -> DataFrame:
    # Result column -> base column.
    checked = {
        "null_load_time": "load_time_dt",
        "null_filename": "originating_filename",
        "null_event_dt": "event_dt",
        "null_source": "source",
        "null_action": "action",
    }
    return recent(base, "load_time_dt", v.instant(now), *LAST_DAY).agg(
        F.lit("Null Value Check").alias("check_name"),
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(n) for n, c in checked.items()],
    )


def cast_failures(base: DataFrame, now: v.Instant) -> DataFrame:
    """Empty numbers although the raw text mentions them."""
    # Result column -> base column and the word looked for.
    checked = {
        "possible_bytes_parse_errors": ("bytes", "Bytes"),
        "possible_custid_parse_errors": ("cust_id", "CustId"),
        "possible_hash_parse_errors": ("hash_code", "HashCode"),
    }
    return recent(base, "load_time_dt", v.instant(now), *LAST_DAY).agg(
        F.lit("Parse Error Check").alias("check_name"),
        F.count("*").alias("total_rows"),
        *[
            F.count_if(F.col(c).isNull() & F.col("raw_data").contains(word)).alias(n)
            for n, (c, word) in checked.items()
        ],
    )


def duplicate_files(ledger: DataFrame, limit: int = 10) -> DataFrame:
    counted = ledger.groupBy("gcs_uri").agg(F.count("*").alias("times_processed"))
    repeated = counted.filter("times_processed > 1")
    return top(repeated, limit, F.desc("times_processed"), "gcs_uri").select(
        F.lit("Duplicate File Check").alias("check_name"), "gcs_uri", "times_processed"
    )


def duplicate_rows(base: DataFrame, now: v.Instant, limit: int = 20) -> DataFrame:
    key = F.coalesce(F.col("hash_fingerprint"), F.col("hash_code").cast("string"))
    keyed = recent(base, "load_time_dt", v.instant(now), *LAST_DAY).select(key.alias("dedupe_key"))
    counted = keyed.filter("dedupe_key IS NOT NULL").groupBy("dedupe_key")
    repeated = counted.agg(F.count("*").alias("occurrences")).filter("occurrences > 1")
    return top(repeated, limit, F.desc("occurrences"), "dedupe_key").select(
        F.lit("Duplicate Row Check (by hash)").alias("check_name"), "dedupe_key", "occurrences"
    )


def archive_completeness(base: DataFrame, archive: DataFrame) -> DataFrame:
    """Files and rows of both tables. Rows are counted per file first, so the distinct count
    works on one row per file."""

    def totals(rows: DataFrame, name: str) -> DataFrame:
        per_file = rows.groupBy("gcs_uri").agg(F.count("*").alias("n"))
        return per_file.agg(
            F.count("gcs_uri").alias(f"{name}_files"),
            F.coalesce(F.sum("n"), F.lit(0)).alias(f"{name}_rows"),
        )

    counts = one_row(totals(base, "base"), totals(archive, "archive"))
    return counts.select(
        F.lit("Archive vs Base Comparison").alias("check_name"),
        "base_files",
        "archive_files",
        "base_rows",
        "archive_rows",
    )


def archive_validity(archive: DataFrame, limit: int = 10) -> DataFrame:
    """Is the JSON of the newest archived lines valid; with the start of each line."""
    newest = top(archive, limit, F.desc("archived_timestamp"), "gcs_uri", "raw_json")
    return newest.select(
        "originating_filename",
        jl.is_json(F.col("raw_json")).alias("is_valid_json"),
        F.left("raw_json", F.lit(100)).alias("json_preview"),
    )


def file_visibility(lines: DataFrame) -> DataFrame:
    """Lines per raw file."""
    return lines.groupBy("gcs_uri").agg(F.count("*").alias("row_count"))
