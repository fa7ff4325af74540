"""Table schemas. Every read and write names its schema; nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, LONG, DOUBLE, TIMESTAMP = StringType(), LongType(), DoubleType(), TimestampType()


def _column(name, data_type, comment, required=False):
    return StructField(name, data_type, not required, {"comment": comment})


# Column names, types and NOT NULL marks of the four tables.
BASE = StructType(
    [
        _column("load_time_dt", TIMESTAMP, "run that loaded the row", required=True),
        _column("source_file_dt", TIMESTAMP, "event time, or the run time if there is none"),
        _column("originating_filename", STRING, "load id: file name without .json", required=True),
        _column("gcs_uri", STRING, "full path of the raw file"),
        _column("action", STRING, "what the user did"),
        _column("bytes", LONG, "bytes moved"),
        _column("cust_id", LONG, "customer number, 0 for partner logins"),
        _column("event_dt", TIMESTAMP, "event time (UTC)"),
        _column("filename", STRING, "path acted upon, '-' if none"),
        _column("hash_code", LONG, "row hash delivered by the sender"),
        _column("hash_fingerprint", STRING, "SHA-256 of the identifying fields, hex"),
        _column("ip_address", STRING, "client address"),
        _column("partner_name", STRING, "partner, null for customers"),
        _column("session_id", STRING, "session"),
        _column("source", STRING, "server that wrote the event"),
        _column("user_name", STRING, "login name"),
        _column("server_response", STRING, "server's answer as text"),
        _column("raw_data", STRING, "original log text"),
    ]
)
ARCHIVE = StructType(
    [
        _column("raw_json", STRING, "the raw line, unchanged", required=True),
        _column("archived_timestamp", TIMESTAMP, "run that archived the line", required=True),
        _column("process_dt", TIMESTAMP, "run time", required=True),
        _column("originating_filename", STRING, "load id", required=True),
        _column("gcs_uri", STRING, "full path of the raw file"),
    ]
)
LEDGER = StructType(
    [
        _column("gcs_uri", STRING, "full path of the raw file", required=True),
        _column("originating_filename", STRING, "load id", required=True),
        _column("processed_timestamp", TIMESTAMP, "run that processed the file", required=True),
        _column("rows_loaded", LONG, "rows of the file in the base table"),
        _column("rows_expected", LONG, "non-empty lines of the file"),
        _column("parse_errors", LONG, "expected minus loaded, never below 0"),
        _column("status", STRING, "SUCCESS, PARTIAL or FAILED"),
        _column("error_message", STRING, "why the file is not SUCCESS"),
        _column("processing_duration_seconds", DOUBLE, "seconds from run start to ledger write"),
    ]
)
MONITORING = StructType(
    [
        _column("check_time", TIMESTAMP, "time of the check", required=True),
        _column("files_processed_last_hour", LONG, "ledger rows of the last hour"),
        _column("files_pending", LONG, "raw files without a ledger row"),
        _column("error_rate_pct", DOUBLE, "non-SUCCESS share of the last 24 h"),
        _column("max_latency_minutes", LONG, "age of the oldest pending file"),
        _column("stale_file_count", LONG, "files pending for over 30 minutes"),
        _column("status", STRING, "OK or ALERT"),
        _column("details", STRING, "the numbers as text"),
    ]
)

# Keys of the raw record. StatusCode is read but not loaded.
RAW_KEYS = (
    "UserName",
    "CustId",
    "PartnerName",
    "EventDt",
    "Action",
    "Filename",
    "SessionId",
    "IpAddress",
    "Source",
    "Bytes",
    "StatusCode",
    "ServerResponse",
    "RawData",
    "HashCode",
)
REQUIRED_KEYS = (
    "UserName",
    "CustId",
    "EventDt",
    "Action",
    "Filename",
    "SessionId",
    "IpAddress",
    "Source",
    "Bytes",
    "StatusCode",
)


@dataclass(frozen=True)
class Table:
    """A stored table: its columns, the date it is partitioned by, its sort order in files, and
    the columns that single values are looked up by without the order helping."""

    name: str
    schema: StructType
    partition: str | None = None
    partition_source: str | None = None
    sort: tuple[str, ...] = ()
    lookup: tuple[str, ...] = ()

    def partition_value(self) -> Column:
        return F.to_date(self.partition_source)


TABLES = {
    t.name: t
    for t in (
        Table(
            "base",
            BASE,
            "event_date",
            "event_dt",
            ("source", "cust_id"),
            ("gcs_uri", "hash_fingerprint"),
        ),
        Table("archive", ARCHIVE, "archived_date", "archived_timestamp", lookup=("gcs_uri",)),
        Table("ledger", LEDGER, sort=("gcs_uri",)),
        Table("monitoring", MONITORING),
    )
}
