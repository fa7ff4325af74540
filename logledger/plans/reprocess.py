"""Preparing files for another load, removing duplicates, and ordering stored rows.

Each operation removes ledger and base rows in one commit and keeps the archive; the next
ingestion run then loads the files again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.operators import dedup
from logledger.operators import ledger as lg
from logledger.sources.warehouse import ADDRESS, Warehouse

# Statuses that call for another try.
UNFINISHED = ("FAILED", "PARTIAL")

# Addresses of kept rows up to this size are broadcast; more are joined by shuffling.
BROADCAST_BYTES = 64 * 1024**2


def _batch(what: str) -> str:
    return f"{what}-{uuid4().hex[:12]}"


def _forget(warehouse: Warehouse, what: str, where: Column) -> int:
    """Removes ledger and base rows of the files that have a ledger row meeting the
    condition. The keys are read from the version before the change, so the order does not
    matter; all ledger rows of a file go, or it would not be loaded again."""
    based_on = warehouse.version()
    batch = _batch(what)
    keys = warehouse.read("ledger").filter(where).select("gcs_uri")
    changes = [warehouse.deletion(t, batch, keys=keys) for t in ("base", "ledger")]
    return warehouse.commit(*changes, based_on=based_on, reads=("base", "ledger"))


def reprocess_file(warehouse: Warehouse, uri: str) -> int:
    """Forgets one file, also if only base rows of it are left."""
    based_on = warehouse.version()
    batch = _batch("file")
    same = F.col("gcs_uri") == uri
    changes = [warehouse.deletion(t, batch, where=same) for t in ("ledger", "base")]
    return warehouse.commit(*changes, based_on=based_on, reads=("base", "ledger"))


def reprocess_unfinished(warehouse: Warehouse, statuses: Sequence[str] = UNFINISHED) -> int:
    """Forgets all files with one of the statuses."""
    return _forget(warehouse, "unfinished", F.col("status").isin(*statuses))


def reprocess_range(
    warehouse: Warehouse, start: datetime | str, end: datetime | str
) -> int:
    """Forgets the files processed between two instants, both included."""
    span = F.col("processed_timestamp").between(v.instant(start), v.instant(end))
    return _forget(warehouse, "range", span)


def full_reload(warehouse: Warehouse) -> int:
    """Empties ledger and base; every raw file is pending again."""
    based_on = warehouse.version()
    changes = [warehouse.truncation(t) for t in ("ledger", "base")]
    return warehouse.commit(*changes, based_on=based_on, reads=("base", "ledger"))


def drop_superseded_ledger_rows(warehouse: Warehouse) -> int:
    """Keeps the newest ledger row of each file."""
    based_on = warehouse.version()
    kept = lg.latest_rows(warehouse.read("ledger"))
    return warehouse.replace("ledger", kept, _batch("latest"), based_on)


def deduplicate_base(warehouse: Warehouse) -> int:
    """Keeps the earliest base row per file and row hash. All copies of a row lie in folders
    that hold a repeated key, so only these are read in full and written again. Which rows stay
    is found from keys, load times and addresses; the rows themselves are never sorted for it."""
    based_on = warehouse.version()
    batch = _batch("dedup")
    rows = warehouse.read_folders("base", warehouse.folders("base"), with_batch=True)
    copies = dedup.folders_with_copies(rows, ["batch", "event_date"])
    touched = warehouse.folders_of("base", copies)
    if not touched:
        return based_on
    scratch = f"{warehouse.root}/_runs/{batch}"
    rows = warehouse.read_folders("base", touched, with_address=True)
    first = dedup.stored(dedup.first_addresses(rows, ADDRESS), scratch)
    sizes = F.sum(sum((F.octet_length(c) for c in ("uri", "row", ADDRESS[0])), F.lit(32)))
    small = first.agg(F.coalesce(sizes, F.lit(0))).first()[0] <= BROADCAST_BYTES
    kept = dedup.keep_addressed(rows, first, ADDRESS, broadcast=small)
    change = warehouse.replace_rows("base", touched, kept, batch)
    version = warehouse.commit(change, based_on=based_on)
    warehouse.files.delete(scratch)
    return version


def cluster_base(warehouse: Warehouse, dates: Iterable[str]) -> int:
    """Writes the base rows of some dates anew, clustered by source and customer. Rows loaded
    meanwhile are no conflict; a deletion in these dates is."""
    return warehouse.commit_if_any(warehouse.cluster("base", dates, _batch("cluster")))
