"""Scalar column expressions. All are built-in Spark expressions: no Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name and time patterns.
LOAD_ID_PATTERN = r"/([^/]+)\.json$"
FILE_TIME_PATTERN = r"-(\d{8}-\d{6})"
FILE_TIME_FORMAT = "yyyyMMdd-HHmmss"
EVENT_TIME_FORMATS = {
    "four_formats": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]['Z']",
    "sql": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
FINGERPRINT_KEYS = ("EventDt", "Source", "Filename", "Bytes", "UserName")


Instant = datetime | str | Column


def instant(value: Instant) -> Column:
    """A timestamp literal; naive datetimes and texts are UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value + "+00:00").cast("timestamp")


def before(now: Column, amount: int, unit: str) -> Column:
    """``now`` minus a whole number of units (HOURS, DAYS, ...)."""
    return now - F.expr(f"INTERVAL {int(amount)} {unit}")


def first_group(text: Column, pattern: str) -> Column:
    """Capture group 1, NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def load_id(uri: Column) -> Column:
    return F.coalesce(first_group(uri, LOAD_ID_PATTERN), F.lit("unknown"))


def file_time(uri: Column) -> Column:
    """Creation time carried by the file name, NULL when there is none."""
    return F.try_to_timestamp(first_group(uri, FILE_TIME_PATTERN), F.lit(FILE_TIME_FORMAT))


def from_millis(value: Column) -> Column:
    """Instant from milliseconds since 1970 (UTC), as object stores and table listings give
    them; NULL stays NULL."""
    return F.timestamp_millis(value)


def event_time(text: Column, rule: str = "four_formats") -> Column:
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMATS[rule]))


def safe_long(text: Column) -> Column:
    return text.try_cast("bigint")


def fingerprint(record: Column, keys: Iterable[str] = FINGERPRINT_KEYS) -> Column:
    parts = [F.coalesce(record[k], F.lit("")) for k in keys]
    return F.sha2(F.concat_ws("|", *parts), 256)


def hash64(text: Column) -> Column:
    """First 8 bytes of SHA-256 as a signed big-endian 64-bit integer."""
    digest = F.sha2(text, 256)
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes elapsed from start to end."""
    return F.timestamp_diff("MINUTE", start, end)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 with two decimals, NULL when whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 2)


def number_text(value: Column) -> Column:
    """Number as text without a trailing ``.0``; NULL becomes ``0``."""
    text = F.regexp_replace(value.cast("string"), r"\.0$", "")
    return F.coalesce(text, F.lit("0"))


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")

