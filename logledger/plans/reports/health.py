"""Is the pipeline running, and how well: reports on the ledger, the backlog and snapshots.

``files`` are the raw files (gcs_uri), from ``Landing.files``. ``now`` is given by the
caller, never read from a clock.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.operators.assemble import one_row
from logledger.plans.reports.common import (
    LAST_DAY,
    LAST_HOUR,
    by_status,
    not_success,
    pending,
    recent,
    top,
)
from logledger.schemas import MONITORING

# Thresholds.
ERROR_RATE_LIMIT = 0.05
LATENCY_LIMIT_MINUTES = 15
STALE_AFTER_MINUTES = 30


def pipeline_status(ledger: DataFrame, now: v.Instant) -> DataFrame:
    """Files, rows and errors of the last 24 hours."""
    return recent(ledger, "processed_timestamp", v.instant(now), *LAST_DAY).agg(
        F.lit("Pipeline Status - Last 24 Hours").alias("report"),
        F.count("*").alias("total_files"),
        *by_status(),
        F.sum("rows_loaded").alias("total_rows_loaded"),
        F.sum("parse_errors").alias("total_parse_errors"),
        F.avg("rows_loaded").alias("avg_rows_per_file"),
    )


def pending_count(files: DataFrame, ledger: DataFrame) -> DataFrame:
    return pending(files, ledger).agg(
        F.lit("Unprocessed Files").alias("report"), F.count("*").alias("pending_files")
    )


def recent_files(ledger: DataFrame, now: v.Instant, limit: int = 10) -> DataFrame:
    """The files processed last."""
    newest = top(ledger, limit, F.desc("processed_timestamp"), "gcs_uri")
    return newest.select(
        "originating_filename",
        "processed_timestamp",
        "rows_loaded",
        "rows_expected",
        "parse_errors",
        "status",
        v.minutes_between(F.col("processed_timestamp"), v.instant(now)).alias("minutes_ago"),
    )


def last_loads(ledger: DataFrame, limit: int = 5) -> DataFrame:
    """What a manual run prints at its end."""
    newest = top(ledger, limit, F.desc("processed_timestamp"), "gcs_uri")
    return newest.select("gcs_uri", "rows_loaded", "status", "processed_timestamp")


def files_with_errors(ledger: DataFrame, limit: int = 50) -> DataFrame:
    bad = ledger.filter(not_success() | (F.col("parse_errors") > 0))
    return top(bad, limit, F.desc("processed_timestamp"), "gcs_uri").select(
        F.lit("Files With Parse Errors").alias("report"),
        "gcs_uri",
        "originating_filename",
        "processed_timestamp",
        "rows_expected",
        "rows_loaded",
        "parse_errors",
        "status",
        "error_message",
    )


def row_reconciliation(
    ledger: DataFrame, base: DataFrame, archive: DataFrame, uri: str
) -> DataFrame:
    """Counts of one file in the three tables. The file filter reaches the Parquet scans."""
    same = F.col("gcs_uri") == uri
    noted = ledger.filter(same).agg(
        F.max("rows_expected").alias("expected_rows"),
        F.max("rows_loaded").alias("tracked_rows"),
        F.max("parse_errors").alias("parse_errors"),
    )
    stored = base.filter(same).agg(F.count("*").alias("base_table_rows"))
    kept = archive.filter(same).agg(F.count("*").alias("archive_rows"))
    counts = one_row(noted, stored, kept)
    return counts.select(F.lit("Row Count Validation").alias("check_name"), "*")


def heartbeat(files: DataFrame, ledger: DataFrame, now: v.Instant) -> DataFrame:
    """Files processed in the last hour against the backlog."""
    now = v.instant(now)
    done = recent(ledger, "processed_timestamp", now, *LAST_HOUR).agg(
        F.count("*").alias("files_processed_last_hour")
    )
    waiting = pending(files, ledger).agg(F.count("*").alias("files_pending"))
    stuck = (F.col("files_processed_last_hour") == 0) & (F.col("files_pending") > 0)
    return one_row(done, waiting).select(
        now.alias("check_time"),
        "files_processed_last_hour",
        "files_pending",
        F.when(stuck, "ALERT: Pipeline may be stuck!").otherwise("OK").alias("status"),
    )


def processing_latency(files: DataFrame, ledger: DataFrame, now: v.Instant) -> DataFrame:
    """Delay from file creation to processing, one value per raw file and ledger row."""
    now = v.instant(now)
    done = recent(ledger, "processed_timestamp", now, *LAST_DAY)
    done = done.withColumn("created", v.file_time(F.col("gcs_uri"))).filter("created IS NOT NULL")
    # The window drops files without a ledger row, so the outer join with the raw files is
    # a semi-join from the ledger, which is the smaller side.
    done = done.join(files.select("gcs_uri"), "gcs_uri", "left_semi")
    delay = v.minutes_between(F.col("created"), F.col("processed_timestamp"))
    late = F.coalesce(F.col("max_latency_minutes") > LATENCY_LIMIT_MINUTES, F.lit(False))
    return (
        done.agg(
            F.avg(delay).alias("avg_latency_minutes"),
            F.max(delay).alias("max_latency_minutes"),
            F.count_if(delay > LATENCY_LIMIT_MINUTES).alias("files_over_15min"),
        )
        .withColumn(
            "status", F.when(late, "WARNING: High latency detected").otherwise("OK")
        )
        .select(now.alias("check_time"), "*")
    )


def error_rate(ledger: DataFrame, now: v.Instant) -> DataFrame:
    now = v.instant(now)
    share = F.try_divide(F.count_if(not_success()).cast("double"), F.count("*").cast("double"))
    rates = recent(ledger, "processed_timestamp", now, *LAST_DAY).agg(
        F.count("*").alias("total_processed_24h"),
        *by_status(),
        F.round(share * 100, 2).alias("error_rate_pct"),
        F.when(share > ERROR_RATE_LIMIT, "ALERT: Error rate exceeds 5%!")
        .otherwise("OK")
        .alias("status"),
    )
    return rates.select(now.alias("check_time"), "*")


def dashboard(files: DataFrame, ledger: DataFrame, now: v.Instant) -> DataFrame:
    """One row on everything. The ledger is read once, with conditional aggregates."""
    now = v.instant(now)
    hour = F.col("processed_timestamp") >= v.before(now, *LAST_HOUR)
    day = F.col("processed_timestamp") >= v.before(now, *LAST_DAY)
    done = ledger.agg(
        F.count_if(hour).alias("files_1h"),
        F.count_if(day).alias("files_24h"),
        F.sum(F.when(day, F.col("rows_loaded"))).alias("rows_24h"),
        F.count_if(day & not_success()).alias("errors_24h"),
        F.max("processed_timestamp").alias("last_processed"),
    )
    waiting = pending(files, ledger).agg(F.count("*").alias("pending_files"))
    # The three status texts.
    status = (
        F.when(
            (F.col("files_1h") == 0) & (F.col("pending_files") > 0),
            "🔴 CRITICAL: Pipeline appears stuck",
        )
        .when(
            F.col("errors_24h") > F.col("files_24h") * ERROR_RATE_LIMIT,
            "🟡 WARNING: High error rate",
        )
        .otherwise("🟢 HEALTHY")
    )
    return one_row(done, waiting).select(
        F.lit("Pipeline Health Dashboard").alias("report"),
        now.alias("generated_at"),
        "files_24h",
        "rows_24h",
        "pending_files",
        "errors_24h",
        "last_processed",
        status.alias("overall_status"),
    )


def monitoring_snapshot(files: DataFrame, ledger: DataFrame, now: v.Instant) -> DataFrame:
    """The row a check appends to the monitoring table. Its latency is the age of the oldest
    pending file, unlike the processing delay of ``processing_latency``."""
    now = v.instant(now)
    hour = F.col("processed_timestamp") >= v.before(now, *LAST_HOUR)
    age = v.minutes_between(F.col("estimated_file_time"), now)
    done = ledger.filter(F.col("processed_timestamp") >= v.before(now, *LAST_DAY)).agg(
        F.count_if(hour).alias("files_processed_last_hour"),
        v.percent(F.count_if(not_success()), F.count("*")).alias("error_rate_pct"),
    )
    waiting = pending(files, ledger).agg(
        F.count("*").alias("files_pending"),
        F.max(age).alias("max_latency_minutes"),
        F.count_if(age > STALE_AFTER_MINUTES).alias("stale_file_count"),
    )
    alert = (
        ((F.col("files_processed_last_hour") == 0) & (F.col("files_pending") > 0))
        | F.coalesce(F.col("error_rate_pct") > 100 * ERROR_RATE_LIMIT, F.lit(False))
        | F.coalesce(F.col("max_latency_minutes") > LATENCY_LIMIT_MINUTES, F.lit(False))
        | (F.col("stale_file_count") > 0)
    )
    # Labels of the numbers in the details text.
    labels = {
        "processed_last_hour": "files_processed_last_hour",
        "pending": "files_pending",
        "error_rate_pct": "error_rate_pct",
        "max_latency_min": "max_latency_minutes",
        "stale_files": "stale_file_count",
    }
    pairs = [F.concat(F.lit(f"{k}="), v.number_text(F.col(c))) for k, c in labels.items()]
    rows = (
        one_row(done, waiting)
        .withColumn("check_time", now)
        .withColumn("status", F.when(alert, "ALERT").otherwise("OK"))
        .withColumn("details", F.concat_ws(", ", *pairs))
    )
    return rows.select(*MONITORING.names)


def latest_alert(monitoring: DataFrame) -> DataFrame:
    """Status and details of the newest snapshot; one NO_ROWS row if there is none."""
    newest = top(monitoring, 1, F.desc("check_time")).select("check_time", "status", "details")
    found = newest.agg(F.max("status").alias("status"), F.max("details").alias("details"))
    return found.select(
        F.coalesce("status", F.lit("NO_ROWS")).alias("status"), "details"
    )


def metric_table(ledger: DataFrame, base: DataFrame, archive: DataFrame) -> DataFrame:
    parts = (
        ("Files Processed", ledger),
        ("Rows in Base Table", base),
        ("Rows in Archive", archive),
    )
    rows = [t.agg(F.lit(n).alias("metric"), F.count("*").alias("value")) for n, t in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
