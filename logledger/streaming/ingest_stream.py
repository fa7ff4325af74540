"""Loading files as they arrive, with Structured Streaming.

Every micro-batch of a continuous stream is one load of ``plans.ingest``: the ledger is checked
first, and one commit makes the batch visible. The ledger makes a repeated micro-batch harmless,
also when batch runs share the tables. A scheduled run notes the files of its micro-batches and
loads those of several together, since each load is compared with history. Late events are accepted
without limit: each lands in the folder of its own date, so there is no watermark.

Spark's file source keeps every file it has seen in the driver. The source of these streams is
therefore the lists of files that arrived (``streaming.arrivals``): one list is a micro-batch.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime, timezone
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from logledger.operators.dedup import stored
from logledger.operators.ledger import not_in_ledger
from logledger.options import VARIANTS, IngestOptions
from logledger.plans.ingest import (
    ARRIVED,
    LISTED,
    LISTED_COLUMNS,
    Loaded,
    close_run,
    drop_scratch,
    load_files,
    load_rest,
    open_run,
    tidy,
)
from logledger.sources.landing import Landing
from logledger.sources.warehouse import VersionConflict, Warehouse
from logledger.streaming.arrivals import arrivals, list_arrivals

# Loads that the micro-batches of a scheduled run are put together to, unless they are larger.
LOADS = 8


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load_micro_batch(
    warehouse: Warehouse,
    options: IngestOptions,
    clock: Callable[[], datetime],
    attempts: int = 3,
    run: str | None = None,
    landing: Landing | None = None,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function. Micro-batches with a common ``run`` are no history to each
    other; without one, each trigger is a run of its own. A micro-batch is lines, or, of a
    ``landing``, files."""

    def load(arrived: DataFrame, epoch: int) -> None:
        for attempt in range(attempts):
            now = clock()
            own = run or f"{now:%Y%m%dT%H%M%S}-{uuid4().hex[:8]}"
            # Streams count their epochs alike: no two loads may share a name.
            batch = f"{own}-{uuid4().hex[:8]}-{epoch}"
            columns = LISTED_COLUMNS if landing else ["gcs_uri"]
            files = arrived.select(*columns).dropDuplicates(["gcs_uri"])
            files = not_in_ledger(files, warehouse.read("ledger"))
            # Which files are new must not change while their load writes ledger rows.
            files = stored(files, f"{warehouse.root}/_runs/{batch}/files")
            try:
                if files.isEmpty():
                    return
                if landing:
                    fresh = landing.parts(files)
                else:
                    fresh = arrived.join(files, "gcs_uri", "left_semi")
                load_files(warehouse, files, fresh, now, batch, options, own)
                if not run:
                    tidy(warehouse, now)
                return
            except VersionConflict:
                if attempt == attempts - 1:
                    raise
            finally:
                warehouse.files.delete(f"{warehouse.root}/_runs/{batch}")

    return load


def start_stream(
    warehouse: Warehouse,
    landing: Landing,
    checkpoint: str,
    options: IngestOptions = VARIANTS["default"],
    clock: Callable[[], datetime] = utc_now,
    every: str | None = "30 seconds",
    files_per_trigger: int = 1000,
    run: str | None = None,
) -> StreamingQuery:
    """Starts the stream. ``every=None`` loads what is there and stops: run it from any
    scheduler for micro-batches every few minutes. In a continuous stream each trigger is a
    run: copies that arrive with different triggers are history to each other, as they are
    when scheduled runs see them one after the other."""
    spark = warehouse.spark

    def look() -> None:
        list_arrivals(spark, checkpoint, landing.one_path().files(spark), files_per_trigger)

    look()
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    load = load_micro_batch(warehouse, options, clock, run=run, landing=landing)
    query = (
        arrivals(spark, checkpoint)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    if every is None:
        return query
    seconds = spark.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {every}) / 1000.0")
    return WatchedStream(query, look, float(seconds.first()[0]))


class WatchedStream(StreamingQuery):
    """A running stream, and a thread that looks for files at its interval. If it cannot look any
    more, the stream ends with that error."""

    def __init__(self, query: StreamingQuery, look: Callable[[], None], seconds: float):
        super().__init__(query._jsq)
        self._look, self._seconds = look, max(seconds, 0.1)
        self._looking, self._ended = threading.Lock(), threading.Event()
        self._error: Exception | None = None
        self._watch = threading.Thread(target=self._watching, daemon=True)
        self._watch.start()

    def _watching(self) -> None:
        while not self._ended.wait(self._seconds) and self.isActive:
            try:
                with self._looking:
                    self._look()
            except Exception as error:
                if not self._ended.is_set():
                    self._error = error
                    super().stop()
                return

    def processAllAvailable(self) -> None:
        """Loads all files that are there at this moment."""
        with self._looking:
            self._look()
        super().processAllAvailable()

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        ended = super().awaitTermination(timeout)
        if self._error:
            raise self._error
        return ended

    def exception(self):
        return super().exception() or self._error

    def stop(self) -> None:
        self._ended.set()
        if threading.current_thread() is not self._watch:
            self._watch.join()
        super().stop()


def note_micro_batch(
    warehouse: Warehouse,
    landing: Landing,
    options: IngestOptions,
    clock: Callable[[], datetime],
    run: str,
) -> tuple[Callable[[DataFrame, int], None], Callable[[], None]]:
    """For a run whose list of files is stored (``open_run``): the foreachBatch function, which
    stores the names that arrived, and a function that loads what was noted and not loaded. Names are
    stored below the run before a micro-batch counts as done, so what a run that breaks off has not
    loaded is in its lists. The first function loads them too once they make up one of LOADS equal
    parts of what was listed, or a wave: a backlog of many micro-batches takes a few loads, while one
    of a few micro-batches has one load for each."""
    known = f"{warehouse.root}/_runs/{run}"
    listed = warehouse.spark.read.schema(LISTED).parquet(f"{known}/listed").count()
    enough = min(landing.files_per_wave, max(1, listed // LOADS))
    noted: list[str] = []
    held = 0

    def note(files: DataFrame, epoch: int) -> None:
        nonlocal held
        # A micro-batch that is repeated replaces what it noted before.
        folder = f"{known}/{ARRIVED}/{epoch}"
        fresh = stored(files.select(*LISTED_COLUMNS), folder)
        if folder not in noted:
            noted.append(folder)
        held += fresh.count()
        if held >= enough:
            load()

    def load() -> None:
        nonlocal held
        if noted:
            files = warehouse.spark.read.schema(LISTED).parquet(*noted)
            load_noted(warehouse, landing, files, clock, options, run)
            noted.clear()
            held = 0

    return note, load


def load_noted(
    warehouse: Warehouse,
    landing: Landing,
    files: DataFrame,
    clock: Callable[[], datetime],
    options: IngestOptions,
    run: str,
    attempts: int = 3,
) -> None:
    """Loads those of the files that have no ledger row, as part of a run."""
    found = warehouse.spark.read.schema(LISTED).parquet(f"{warehouse.root}/_runs/{run}/found")
    for attempt in range(attempts):
        batch = f"{run}-{uuid4().hex[:8]}"
        try:
            # Empty files are neither pending nor processed.
            fresh = not_in_ledger(files.filter("length > 0"), warehouse.read("ledger"))
            # Which files are new must not change while their load writes ledger rows.
            fresh = stored(fresh.hint("rebalance"), f"{warehouse.root}/_runs/{batch}/files")
            for number, wave in enumerate(landing.waves(fresh, found)):
                name = f"{batch}-{number}"
                load_files(warehouse, wave.files, wave.parts(), clock(), name, options, run)
            return
        except VersionConflict:
            if attempt == attempts - 1:
                raise
        finally:
            drop_scratch(warehouse, batch)


def run_scheduled(
    warehouse: Warehouse,
    landing: Landing,
    checkpoint: str,
    options: IngestOptions = VARIANTS["default"],
    clock: Callable[[], datetime] = utc_now,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """One scheduled run: loads all arrived files, returns the ledger. It is one run however
    many triggers it takes. If it breaks off, the next call first loads the rest of the files
    that were there when it began or that its triggers noted, as part of that run; the stream then
    goes on with those that came later as a new run, and finds the others in the ledger.
    ``files_per_trigger`` bounds what a trigger notes, ``landing.files_per_wave`` a load."""
    scope = "stream-" + sha256(checkpoint.encode()).hexdigest()[:16]
    landing = landing.one_path()
    run, broken = open_run(warehouse, landing, scope, clock())
    while broken:
        load_rest(warehouse, landing, run, broken, clock(), options, Loaded())
        close_run(warehouse, scope, run)
        run, broken = open_run(warehouse, landing, scope, clock())
    found = warehouse.spark.read.schema(LISTED).parquet(f"{warehouse.root}/_runs/{run}/found")
    list_arrivals(warehouse.spark, checkpoint, found, files_per_trigger)
    note, load = note_micro_batch(warehouse, landing, options, clock, run)
    query = (
        arrivals(warehouse.spark, checkpoint)
        .writeStream.foreachBatch(note)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    load()
    close_run(warehouse, scope, run)
    tidy(warehouse, clock())
    return warehouse.read("ledger")
