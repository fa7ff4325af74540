"""Pieces several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v


def recent(rows: DataFrame, column: str, now: Column, amount: int, unit: str) -> DataFrame:
    """Rows whose instant lies within the trailing window. On the base table a limit on the
    event time is also a limit on the partition date, which skips older folders."""
    start = v.before(now, amount, unit)
    kept = rows.filter(F.col(column) >= start)
    if column == "event_dt" and "event_date" in rows.columns:
        kept = kept.filter(F.col("event_date") >= F.to_date(start))
    return kept


def top(rows: DataFrame, limit: int, *order: Column | str) -> DataFrame:
    """The first rows of an order. Plans as a top-k: no full sort."""
    return rows.orderBy(*order).limit(limit)


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Raw files without a ledger row, with the time their name carries. ``files`` may hold
    a file once or once per line."""
    names = files.select("gcs_uri").distinct()
    waiting = names.join(ledger.select("gcs_uri"), "gcs_uri", "left_anti")
    return waiting.withColumn("estimated_file_time", v.file_time(F.col("gcs_uri")))


def not_success() -> Column:
    return F.col("status") != "SUCCESS"


def by_status() -> list[Column]:
    return [
        F.count_if(F.col("status") == s).alias(n)
        for s, n in (("SUCCESS", "successful"), ("FAILED", "failed"), ("PARTIAL", "partial"))
    ]


LAST_HOUR = (1, "HOURS")
LAST_DAY = (24, "HOURS")
LAST_WEEK = (7, "DAYS")
