"""Loading raw files into the tables: one run over everything pending.

Each load reads the text once. It writes the archive first, parses the archived lines into
base rows, removes rows already in history, and writes the ledger; one commit then makes the
three visible. Since the archive lines are the input of the parse, the counts of expected
and loaded rows come from two narrow columns of what was just written.
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.functions import values as v
from logledger.operators import dedup
from logledger.operators import ledger as lg
from logledger.operators.lines import archive_lines, archived_as_lines, parse_lines
from logledger.options import IngestOptions
from logledger.sources.landing import Landing
from logledger.sources.warehouse import Change, VersionConflict, Warehouse, partition_date

COMPACT_ABOVE = 64
LISTED = "gcs_uri string, length bigint, modified timestamp"
# Folder of a run with the files its micro-batches noted.
ARRIVED = "arrived"
LISTED_COLUMNS = [c.split()[0] for c in LISTED.split(", ")]


def load_files(
    warehouse: Warehouse,
    files: DataFrame,
    lines: DataFrame | Iterable[DataFrame],
    now: datetime,
    batch: str,
    options: IngestOptions = IngestOptions(),
    run: str | None = None,
    started: float | None = None,
) -> int:
    """Loads the lines of the given files (gcs_uri) as one batch and commits it. Returns the
    number of rows dropped as duplicates. Batches whose names start with ``run`` belong to
    the same run and are not its history. Lines that come in several parts are archived one
    part after the other, and go on from there together."""
    started = time.monotonic() if started is None else started
    run_ts = v.instant(now)
    based_on = warehouse.version()
    expected = None
    try:
        archive = Change("archive")
        for part in [lines] if isinstance(lines, DataFrame) else lines:
            more = {"more": True} if archive.added else {}
            archive = warehouse.stage("archive", archive_lines(part, run_ts), batch, **more)
        archived = warehouse.read_folders("archive", archive.added)
        expected = lg.rows_per_file(archived, "rows_expected")
        base = warehouse.stage(
            "base", parse_lines(archived_as_lines(archived), run_ts, options), batch
        )
        parsed = base
        if options.within_batch:
            rows = dedup.first_in_batch(warehouse.read_folders("base", base.added))
            base = warehouse.stage("base", rows, f"{batch}-once")
            # The run's earlier loads are part of the same batch to this option.
            same = _run_folders(warehouse, base, run or batch, options.history_by_date)
            base = _without(warehouse, base, same, f"{batch}-run", options.history_by_date)
        if options.dedup_history and options.fingerprint_keys:
            past = _history_folders(warehouse, base, run or batch, options.history_by_date)
            base = _without(warehouse, base, past, batch, options.history_by_date)
        rows = warehouse.read_folders("base", base.added)
        loaded = lg.rows_per_file(rows, "rows_loaded")
        if options.count_rows:
            seconds = F.lit(float(int(time.monotonic() - started)))
            new = lg.ledger_rows(files, expected, loaded, run_ts, seconds)
        else:
            new = lg.uncounted_rows(files, loaded, run_ts)
        ledger = warehouse.stage("ledger", new, batch)
        compared = options.within_batch or (options.dedup_history and options.fingerprint_keys)
        warehouse.commit(
            archive,
            base,
            ledger,
            based_on=based_on,
            reads=("base", "ledger") if compared else ("ledger",),
            clash=_load_clash(warehouse, files, base, options.history_by_date),
        )
        if base is parsed:
            return 0
        return warehouse.read_folders("base", parsed.added).count() - rows.count()
    except VersionConflict:
        raise
    except Exception as error:
        if options.record_failures:
            rows = lg.failure_rows(files, error, run_ts, expected)
            warehouse.append("ledger", rows, f"{batch}-failed")
        raise


def _load_clash(
    warehouse: Warehouse, files: DataFrame, base: Change, by_date: bool
) -> Callable[[str, list[str], list[str]], bool]:
    """What another writer may not have done since a load began: removed rows, loaded one of
    its files, or loaded rows of dates it was compared with."""
    dates = {partition_date(f) for f in base.added}

    def clash(table: str, added: list[str], removed: list[str]) -> bool:
        if removed:
            return True
        if table == "base":
            return any(not by_date or partition_date(f) in dates for f in added)
        theirs = warehouse.read_folders(table, added).select("gcs_uri")
        return not files.join(theirs, "gcs_uri", "left_semi").isEmpty()

    return clash


def _history_folders(
    warehouse: Warehouse, base: Change, run: str, by_date: bool
) -> list[str]:
    """Base folders of earlier runs, on request only those of the dates in the batch."""
    dates = {partition_date(f) for f in base.added} if by_date else None
    return [f for f in warehouse.folders("base", dates) if f"batch={run}" not in f]


def _run_folders(warehouse: Warehouse, base: Change, run: str, by_date: bool) -> list[str]:
    """Base folders of earlier loads of the same run."""
    dates = {partition_date(f) for f in base.added} if by_date else None
    return [f for f in warehouse.folders("base", dates) if f"batch={run}" in f]


def _without(
    warehouse: Warehouse, base: Change, past: list[str], batch: str, by_date: bool
) -> Change:
    """Drops staged rows that past folders hold. The staged batch lies on disk by date, so only
    two columns of it and of history are compared, and only dates that hold a seen row are
    written again."""
    if not past or not base.added:
        return base
    batch_keys = warehouse.read_folders("base", base.added).select("event_date", "hash_fingerprint")
    history = warehouse.read_folders("base", past).select("event_date", "hash_fingerprint")
    small = batch_keys.count() <= dedup.BROADCAST_KEYS
    seen = dedup.seen_keys(batch_keys, history, by_date, small)
    seen = dedup.stored(seen, f"{warehouse.root}/_runs/{batch}/seen")
    if by_date:
        # At most one value per date folder of the batch.
        found = {r[0] for r in seen.select("seen_date").distinct().collect()}
        names = {None if d is None else d.isoformat() for d in found}
        touched = [f for f in base.added if _date_or_none(partition_date(f)) in names]
    else:
        touched = base.added if seen.limit(1).count() else []
    if not touched:
        return base
    rows = dedup.drop_seen(warehouse.read_folders("base", touched), seen, by_date)
    fresh = warehouse.stage("base", rows, f"{batch}-fresh")
    kept = [f for f in base.added if f not in touched]
    return Change("base", kept + fresh.added)


def _date_or_none(value: str | None) -> str | None:
    return None if value is None or value.startswith("__HIVE") else value


def run_summary(
    warehouse: Warehouse, now: datetime | Column, files_processed: int, duplicates: int = 0
) -> DataFrame:
    """Summary row of a run. Rows of the last hour come from the base table; of that, only
    folders written since then are listed and opened."""
    since = now - timedelta(hours=1) if isinstance(now, datetime) else None
    now = v.instant(now)
    recent = warehouse.read("base", since=since)
    recent = recent.filter(F.col("load_time_dt") >= v.before(now, 1, "HOURS"))
    return recent.agg(F.count("*").alias("rows_loaded_last_hour")).select(
        F.lit("ETL Complete").alias("status"),
        now.alias("completed_at"),
        F.lit(files_processed).cast("bigint").alias("files_processed"),
        "rows_loaded_last_hour",
        F.lit(duplicates).cast("bigint").alias("rows_already_loaded"),
    )


def new_file_count(pending: DataFrame, now: datetime | Column) -> DataFrame:
    """Log row written before a load."""
    return pending.agg(F.countDistinct("gcs_uri").alias("new_files_to_process")).select(
        "new_files_to_process", v.instant(now).alias("run_timestamp")
    )


@dataclass
class Loaded:
    """What a call has loaded so far."""

    files: int = 0
    duplicates: int = 0


def ingest_batch(
    warehouse: Warehouse,
    landing: Landing,
    now: datetime,
    options: IngestOptions = IngestOptions(),
    attempts: int = 3,
    log: Callable[[str], None] | None = None,
) -> DataFrame:
    """Loads every raw file that has no ledger row yet and returns the summary row.

    A backlog too large for one load is loaded in waves, each committed on its own, so a
    failure repeats one wave at most. Waves of one run are no history to each other: how a
    backlog is cut does not change what is loaded. The files of a run are listed when it opens.
    If it breaks off, the next call first loads the rest of that list as part of that run, and
    then what came later as a run of its own, to which all earlier rows are history.
    """
    started = time.monotonic()
    scope = "batch-" + sha256("\n".join(landing.paths).encode()).hexdigest()[:16]
    loaded = Loaded()
    for attempt in range(attempts):
        try:
            while True:
                run, broken = open_run(warehouse, landing, scope, now)
                load_rest(warehouse, landing, run, broken, now, options, loaded, log, started)
                close_run(warehouse, scope, run)
                if not broken:
                    break
            break
        except VersionConflict:
            # Another writer came first. What it loaded is in the ledger now.
            if attempt == attempts - 1:
                raise
    tidy(warehouse, now)
    return run_summary(warehouse, now, loaded.files, loaded.duplicates)


def load_rest(
    warehouse: Warehouse,
    landing: Landing,
    run: str,
    broken: bool,
    now: datetime,
    options: IngestOptions,
    loaded: Loaded,
    log: Callable[[str], None] | None = None,
    started: float | None = None,
) -> None:
    """Loads the files of a run's list; of a broken one those that have no ledger row yet."""
    own = f"{run}-{uuid4().hex[:8]}"
    try:
        listed = f"{warehouse.root}/_runs/{run}/listed"
        pending = warehouse.spark.read.schema(LISTED).parquet(listed)
        if broken:
            arrived = f"{warehouse.root}/_runs/{run}/{ARRIVED}"
            noted = [f"{arrived}/{n}" for n in warehouse.files.children(arrived)]
            # A folder whose writing broke off has no files to read: its trigger comes again.
            noted = [f for f in noted if warehouse.files.exists(f"{f}/_SUCCESS")]
            if noted:
                later = warehouse.spark.read.schema(LISTED).parquet(*noted).filter("length > 0")
                # A file that was listed and noted is one file, whatever its size was by then.
                pending = pending.unionByName(later).dropDuplicates(["gcs_uri"])
            rest = lg.not_in_ledger(pending, warehouse.read("ledger"))
            pending = dedup.stored(rest, f"{warehouse.root}/_runs/{own}/pending")
        # A run that an earlier release opened has no list of all files.
        every = f"{warehouse.root}/_runs/{run}/found"
        known = warehouse.files.exists(every)
        found = warehouse.spark.read.schema(LISTED).parquet(every) if known else None
        for number, wave in enumerate(landing.waves(pending, found)):
            if log:
                log(f"loading {wave.count} files at {now}")
            loaded.duplicates += load_files(
                warehouse, wave.files, wave.parts(), now, f"{own}-{number}", options, run, started
            )
            loaded.files += wave.count
    finally:
        drop_scratch(warehouse, own)


def _marker(warehouse: Warehouse, scope: str) -> str:
    return f"{warehouse.root}/_runs/open-{scope}"


def open_run(
    warehouse: Warehouse, landing: Landing, scope: str, now: datetime
) -> tuple[str, bool]:
    """Name of the run in progress for a scope, and whether it is one that broke off before. A
    new run's list of files is stored before its name is."""
    marker = _marker(warehouse, scope)
    while True:
        if warehouse.files.exists(marker):
            return warehouse.files.read(marker), True
        run = f"{now:%Y%m%dT%H%M%S}-{uuid4().hex[:8]}"
        # Listing tasks find few names each: REBALANCE, or the list is as many files as tasks.
        found = landing.files(warehouse.spark).select(*LISTED_COLUMNS).hint("rebalance")
        found = dedup.stored(found, f"{warehouse.root}/_runs/{run}/found")
        fresh = lg.not_in_ledger(found, warehouse.read("ledger")).hint("rebalance")
        dedup.stored(fresh, f"{warehouse.root}/_runs/{run}/listed")
        if warehouse.files.create(marker, run):
            return run, False
        drop_scratch(warehouse, run)  # another writer was faster


def close_run(warehouse: Warehouse, scope: str, run: str) -> None:
    """Ends a run all of whose files are in the ledger. If two writers work on the same broken
    run, the first to be done closes it."""
    marker = _marker(warehouse, scope)
    if warehouse.files.exists(marker) and warehouse.files.read(marker) == run:
        warehouse.files.delete(marker)
    drop_scratch(warehouse, run, exact=True)


def drop_scratch(warehouse: Warehouse, own: str, exact: bool = False) -> None:
    """Removes run-scoped tables: that of this name, or of all names that begin so."""
    for name in warehouse.files.children(f"{warehouse.root}/_runs"):
        if name == own or not exact and name.startswith(own):
            warehouse.files.delete(f"{warehouse.root}/_runs/{name}")


def tidy(warehouse: Warehouse, now: datetime) -> None:
    """Merges folders where many runs have left many. Only between runs: a merged folder belongs
    to no run. Not urgent: if another writer commits meanwhile, the next run does it."""
    based_on = warehouse.version()
    name = f"{now:%Y%m%dT%H%M%S}-tidy-{uuid4().hex[:8]}"
    changes = [warehouse.compact(t, name, COMPACT_ABOVE) for t in ("ledger", "base", "archive")]
    with contextlib.suppress(VersionConflict):
        warehouse.commit_if_any(*changes, based_on=based_on)
