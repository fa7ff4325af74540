"""Choices the ingestion leaves open, and the four named combinations of them."""

from __future__ import annotations

from dataclasses import dataclass

from logledger.functions.values import FINGERPRINT_KEYS


@dataclass(frozen=True)
class IngestOptions:
    """
    dedup_history       drop rows whose fingerprint the base table already holds
    history_by_date     look for them among equal event dates only; right as long as one
                        timestamp rule parsed the whole history, since the fingerprint
                        contains the event time text
    within_batch        also keep only one of several equal rows of one run
    lenient             load unreadable lines that start an object, with NULL fields
    timestamp_rule      "four_formats" (optional fraction, optional Z) or "sql" (no Z)
    fingerprint_keys    raw keys in the fingerprint; empty: none is written
    count_rows          False: the ledger takes every file for a SUCCESS and has no
                        expected and error counts
    record_failures     on an error, give the files FAILED ledger rows before re-raising
    """

    dedup_history: bool = True
    history_by_date: bool = True
    within_batch: bool = False
    lenient: bool = False
    timestamp_rule: str = "four_formats"
    fingerprint_keys: tuple[str, ...] = FINGERPRINT_KEYS
    count_rows: bool = True
    record_failures: bool = False


# The ingestion variants a user may come from.
VARIANTS = {
    "default": IngestOptions(),
    "procedure": IngestOptions(lenient=True, timestamp_rule="sql"),
    "script": IngestOptions(dedup_history=False, lenient=True, timestamp_rule="sql"),
    "triggered_script": IngestOptions(
        dedup_history=False,
        lenient=True,
        timestamp_rule="sql",
        fingerprint_keys=(),
        count_rows=False,
    ),
    "per_file": IngestOptions(dedup_history=False, record_failures=True),
}
