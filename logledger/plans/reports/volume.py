"""How much data: per day, hour and source, against the days before, and on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.plans.reports.common import LAST_WEEK, recent, top
from logledger.sources.warehouse import Warehouse

# Fixed value: share of the mean from which a day is unusual.
DEVIATION_LIMIT = 0.5


def daily_volume(ledger: DataFrame, limit: int = 30) -> DataFrame:
    days = ledger.groupBy(F.to_date("processed_timestamp").alias("processing_date")).agg(
        F.count("*").alias("files_processed"),
        F.sum("rows_loaded").alias("total_rows"),
        F.avg("rows_loaded").alias("avg_rows_per_file"),
        F.min("rows_loaded").alias("min_rows"),
        F.max("rows_loaded").alias("max_rows"),
    )
    return top(days, limit, F.desc("processing_date"))


def hourly_distribution(ledger: DataFrame, now: v.Instant) -> DataFrame:
    """Hours of the day, over 7 days."""
    rows = recent(ledger, "processed_timestamp", v.instant(now), *LAST_WEEK)
    hours = rows.groupBy(F.hour("processed_timestamp").alias("hour_of_day"))
    return hours.agg(
        F.count("*").alias("files_processed"), F.sum("rows_loaded").alias("total_rows")
    ).orderBy("hour_of_day")


def source_volume(base: DataFrame, now: v.Instant) -> DataFrame:
    """Events and active days per source, over 7 days. Grouping by source and day first
    makes the distinct count a plain count and spreads a source that dominates."""
    rows = recent(base, "event_dt", v.instant(now), *LAST_WEEK)
    days = rows.groupBy("source", F.to_date("event_dt").alias("day")).agg(
        F.count("*").alias("n"), F.min("event_dt").alias("lo"), F.max("event_dt").alias("hi")
    )
    return (
        days.groupBy("source")
        .agg(
            F.sum("n").alias("event_count"),
            F.count("day").alias("active_days"),
            F.min("lo").alias("first_event"),
            F.max("hi").alias("last_event"),
        )
        .orderBy(F.desc("event_count"), "source")
    )


def volume_anomaly(ledger: DataFrame, now: v.Instant) -> DataFrame:
    """Rows of today against the mean of the preceding days of an 8-day window, which may
    begin within a day; no row if nothing was processed today."""
    now = v.instant(now)
    today = F.to_date(now)
    rows = recent(ledger, "processed_timestamp", now, 8, "DAYS")
    days = rows.groupBy(F.to_date("processed_timestamp").alias("day")).agg(
        F.sum("rows_loaded").alias("n")
    )
    before = F.when(F.col("day") < today, F.col("n"))
    stats = days.agg(
        F.max(F.when(F.col("day") == today, F.col("day"))).alias("processing_date"),
        F.max(F.when(F.col("day") == today, F.col("n"))).alias("today_rows"),
        F.avg(before).alias("avg_daily_rows"),
    ).filter("processing_date IS NOT NULL")
    off = F.try_divide(
        F.abs(F.col("today_rows") - F.col("avg_daily_rows")), F.col("avg_daily_rows")
    )
    unusual = F.coalesce(off > DEVIATION_LIMIT, F.lit(False))
    return stats.select(
        now.alias("check_time"),
        "processing_date",
        "today_rows",
        "avg_daily_rows",
        F.round(off * 100, 2).alias("pct_deviation"),
        F.when(unusual, "WARNING: Unusual volume").otherwise("OK").alias("status"),
    )


def volume_statistics(ledger: DataFrame, now: v.Instant) -> DataFrame:
    """Mean and sample deviation of the daily rows the anomaly report compares with."""
    now = v.instant(now)
    rows = recent(ledger, "processed_timestamp", now, 8, "DAYS")
    days = rows.groupBy(F.to_date("processed_timestamp").alias("day")).agg(
        F.sum("rows_loaded").alias("n")
    )
    return days.filter(F.col("day") < F.to_date(now)).agg(
        F.avg("n").alias("avg_daily_rows"), F.stddev_samp("n").alias("stddev_rows")
    )


def storage_growth(warehouse: Warehouse) -> DataFrame:
    """Size, rows and last change of each table, largest first."""
    return warehouse.storage()
