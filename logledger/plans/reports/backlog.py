"""Files that wait for too long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.operators.assemble import one_row
from logledger.plans.reports.common import pending, top
from logledger.plans.reports.health import STALE_AFTER_MINUTES

# Fixed value: how many stale files are named.
SAMPLES = 5


def stale_files(files: DataFrame, ledger: DataFrame, now: v.Instant) -> DataFrame:
    """Pending files, those over 30 minutes old, the oldest age and the five oldest names.
    The names are a top-k before they are collected into the array."""
    now = v.instant(now)
    waiting = pending(files, ledger).filter("estimated_file_time IS NOT NULL")
    age = v.minutes_between(F.col("estimated_file_time"), now)
    counts = waiting.agg(
        F.count_if(age > STALE_AFTER_MINUTES).alias("stale_file_count"),
        F.count("*").alias("pending_count"),
        F.max(age).alias("oldest_pending_minutes"),
    )
    oldest = top(waiting, SAMPLES, "estimated_file_time", "gcs_uri")
    in_order = F.array_sort(F.collect_list(F.struct("estimated_file_time", "gcs_uri")))
    # NULL, not an empty array, when nothing is pending.
    names = oldest.agg(
        F.when(F.count("*") > 0, in_order["gcs_uri"]).alias("sample_stale_files")
    )
    old = F.coalesce(F.col("oldest_pending_minutes") > STALE_AFTER_MINUTES, F.lit(False))
    return one_row(counts, names).select(
        now.alias("check_time"),
        "stale_file_count",
        "pending_count",
        "oldest_pending_minutes",
        "sample_stale_files",
        F.when(old, "ALERT: Stale files detected!").otherwise("OK").alias("status"),
    )
