"""Appending a health snapshot to the monitoring table."""

from __future__ import annotations

import contextlib
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame

from logledger.plans.reports.health import latest_alert, monitoring_snapshot
from logledger.sources.landing import Landing
from logledger.sources.warehouse import VersionConflict, Warehouse


def record_snapshot(warehouse: Warehouse, landing: Landing, now: datetime) -> DataFrame:
    """Checks the pipeline, appends the snapshot, returns the latest alert row."""
    return append_snapshot(warehouse, landing.files(warehouse.spark), now)


def append_snapshot(warehouse: Warehouse, files: DataFrame, now: datetime) -> DataFrame:
    """The same for raw files (gcs_uri) that have been listed already."""
    row = monitoring_snapshot(files, warehouse.read("ledger"), now)
    name = f"check-{now:%Y%m%dT%H%M%S}-{uuid4().hex[:8]}"
    warehouse.append("monitoring", row, name)
    based_on = warehouse.version()
    # Merging is not urgent: if another check merges meanwhile, its result stands.
    with contextlib.suppress(VersionConflict):
        warehouse.commit_if_any(warehouse.compact("monitoring", name), based_on=based_on)
    return latest_alert(warehouse.read("monitoring"))
