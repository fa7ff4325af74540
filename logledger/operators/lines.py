"""Operators on raw lines: DataFrames with the columns ``gcs_uri`` and ``data``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions import json_lines as jl
from logledger.functions import values as v
from logledger.options import IngestOptions
from logledger.schemas import ARCHIVE, BASE, RAW_KEYS

# Base column -> raw key.
TEXT_FIELDS = {
    "action": "Action",
    "filename": "Filename",
    "ip_address": "IpAddress",
    "partner_name": "PartnerName",
    "session_id": "SessionId",
    "source": "Source",
    "user_name": "UserName",
    "server_response": "ServerResponse",
    "raw_data": "RawData",
}
NUMBER_FIELDS = {"bytes": "Bytes", "cust_id": "CustId", "hash_code": "HashCode"}


def read_records(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """Adds the 14 raw fields as text columns; lines that are no record are dropped."""
    generate = jl.each_record_lenient if lenient else jl.each_record
    found = lines.withColumn("_record", generate())
    return found.select(*lines.columns, *[F.col("_record")[k].alias(k) for k in RAW_KEYS])


def parse_lines(
    lines: DataFrame, run_ts: v.Instant, options: IngestOptions = IngestOptions()
) -> DataFrame:
    """Raw lines to base rows (18 columns). One pass, no shuffle."""
    run_ts = v.instant(run_ts)
    records = read_records(lines, options.lenient)
    event_dt = v.event_time(F.col("EventDt"), options.timestamp_rule)
    mark = F.lit(None).cast("string")
    if options.fingerprint_keys:
        texts = F.struct(*options.fingerprint_keys)
        mark = v.fingerprint(texts, options.fingerprint_keys)
    columns = {
        "load_time_dt": run_ts,
        "source_file_dt": F.coalesce(event_dt, run_ts),
        "originating_filename": v.load_id(F.col("gcs_uri")),
        "gcs_uri": F.col("gcs_uri"),
        "event_dt": event_dt,
        "hash_fingerprint": mark,
    }
    columns |= {name: F.col(key) for name, key in TEXT_FIELDS.items()}
    columns |= {name: v.safe_long(F.col(key)) for name, key in NUMBER_FIELDS.items()}
    return records.select(*[columns[f.name].alias(f.name) for f in BASE])


def archive_lines(lines: DataFrame, run_ts: v.Instant) -> DataFrame:
    """Every non-empty raw line, readable or not."""
    run_ts = v.instant(run_ts)
    columns = {
        "raw_json": F.col("data"),
        "archived_timestamp": run_ts,
        "process_dt": run_ts,
        "originating_filename": v.load_id(F.col("gcs_uri")),
        "gcs_uri": F.col("gcs_uri"),
    }
    kept = lines.filter(~v.is_blank(F.col("data")))
    return kept.select(*[columns[f.name].alias(f.name) for f in ARCHIVE])


def archived_as_lines(archive: DataFrame) -> DataFrame:
    """The archive read as raw lines again: parse_lines on it rebuilds the base rows."""
    return archive.select("gcs_uri", F.col("raw_json").alias("data"))


def reextract(archive: DataFrame) -> DataFrame:
    """Archived lines with their raw fields, StatusCode included, read anew."""
    lines = archive.select(
        "gcs_uri", "originating_filename", "raw_json", F.col("raw_json").alias("data")
    )
    return read_records(lines).drop("data")


def file_stats(lines: DataFrame) -> DataFrame:
    """Expected rows (non-empty lines) of every file, blank files included."""
    return lines.groupBy("gcs_uri").agg(
        F.count_if(~v.is_blank(F.col("data"))).alias("rows_expected")
    ).select("gcs_uri", v.load_id(F.col("gcs_uri")).alias("originating_filename"), "rows_expected")


def visible_files(lines: DataFrame) -> DataFrame:
    """Lines per raw file, as the source shows them."""
    return lines.groupBy("gcs_uri").agg(F.count("*").alias("row_count"))
