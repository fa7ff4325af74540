"""Ledger rows: one per file, with expected and loaded rows and a status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.schemas import LEDGER

# Error texts.
NO_ROWS_FOUND = "No non-empty rows found in file"
NO_ROWS_LOADED = "No rows loaded from file"
ERROR_TEXT_LIMIT = 1000


def _status(expected: Column, loaded: Column) -> tuple[Column, Column]:
    partial = F.concat(
        F.lit("Parsed "), loaded.cast("string"), F.lit(" of "), expected.cast("string"), F.lit(" rows")
    )
    status = (
        F.when((expected == 0) | (loaded == 0), "FAILED")
        .when(expected > loaded, "PARTIAL")
        .otherwise("SUCCESS")
    )
    message = (
        F.when(expected == 0, NO_ROWS_FOUND)
        .when(loaded == 0, NO_ROWS_LOADED)
        .when(expected > loaded, partial)
    )
    return status, message


def _as_ledger(files: DataFrame, **columns: Column) -> DataFrame:
    columns.setdefault("originating_filename", v.load_id(F.col("gcs_uri")))
    columns.setdefault("gcs_uri", F.col("gcs_uri"))
    return files.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER]
    )


def rows_per_file(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("gcs_uri").agg(F.count("*").alias(name))


def ledger_rows(
    files: DataFrame,
    expected: DataFrame,
    loaded: DataFrame,
    run_ts: v.Instant,
    seconds: Column | None = None,
) -> DataFrame:
    """One ledger row per file of ``files``.

    expected: (gcs_uri, rows_expected), loaded: (gcs_uri, rows_loaded); a file missing there
    has 0. All three are one row per file.
    """
    counted = files.join(expected.select("gcs_uri", "rows_expected"), "gcs_uri", "left").join(
        loaded.select("gcs_uri", "rows_loaded"), "gcs_uri", "left"
    )
    want = F.coalesce(F.col("rows_expected"), F.lit(0))
    have = F.coalesce(F.col("rows_loaded"), F.lit(0))
    status, message = _status(want, have)
    return _as_ledger(
        counted,
        processed_timestamp=v.instant(run_ts),
        rows_loaded=have,
        rows_expected=want,
        parse_errors=F.greatest(want - have, F.lit(0)),
        status=status,
        error_message=message,
        processing_duration_seconds=F.lit(0) if seconds is None else seconds,
    )


def uncounted_rows(files: DataFrame, loaded: DataFrame, run_ts: v.Instant) -> DataFrame:
    """Ledger rows of the variant that takes every file for a success."""
    counted = files.join(loaded.select("gcs_uri", "rows_loaded"), "gcs_uri", "left")
    return _as_ledger(
        counted,
        processed_timestamp=v.instant(run_ts),
        rows_loaded=F.coalesce(F.col("rows_loaded"), F.lit(0)),
        status=F.lit("SUCCESS"),
    )


def failure_rows(
    files: DataFrame, error: BaseException, run_ts: v.Instant, expected: DataFrame | None = None
) -> DataFrame:
    """FAILED rows for files whose load raised an error, with the expected rows if the load
    came far enough to count them."""
    known = {}
    if expected is not None:
        files = files.join(expected.select("gcs_uri", "rows_expected"), "gcs_uri", "left")
        want = F.coalesce(F.col("rows_expected"), F.lit(0))
        known = {"rows_expected": want, "parse_errors": want}
    return _as_ledger(
        files,
        processed_timestamp=v.instant(run_ts),
        rows_loaded=F.lit(0),
        status=F.lit("FAILED"),
        error_message=F.lit(str(error)[:ERROR_TEXT_LIMIT]),
        **known,
    )


def not_in_ledger(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files without a ledger row. Spark broadcasts the ledger while it is small and
    sort-merges beyond that."""
    return files.join(ledger.select("gcs_uri"), "gcs_uri", "left_anti")


def merge_new(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert-only merge: the rows whose file has no ledger row yet."""
    return not_in_ledger(rows, ledger)


def latest_rows(ledger: DataFrame) -> DataFrame:
    """Ledger without superseded rows: per file the newest, all of them if tied."""
    window = Window.partitionBy("gcs_uri").orderBy(F.desc("processed_timestamp"))
    return ledger.withColumn("_rank", F.rank().over(window)).filter("_rank = 1").drop("_rank")


def repeated_files(ledger: DataFrame) -> DataFrame:
    """Files with several ledger rows, and when they were processed."""
    # Times are gathered for repeated files only.
    repeated = ledger.groupBy("gcs_uri").agg(F.count("*").alias("n")).filter("n > 1")
    return (
        ledger.join(repeated.select("gcs_uri"), "gcs_uri", "left_semi")
        .groupBy("gcs_uri")
        .agg(
            F.count("*").alias("times_processed"),
            F.array_sort(F.collect_list("processed_timestamp")).alias("processing_times"),
        )
    )
