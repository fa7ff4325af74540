"""Every operator and report as a query on the test tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from logledger.functions import values as v
from logledger.operators import conformance as cf
from logledger.operators import dedup
from logledger.operators import ledger as lg
from logledger.operators import lines as ln
from logledger.options import VARIANTS, IngestOptions
from logledger.plans import ingest, monitoring, reprocess
from logledger.plans.reports import backlog, business, health, quality, reprocessing, volume
from logledger.sources.files import shared_folder
from logledger.sources.landing import Landing
from logledger.sources.warehouse import Warehouse
from logledger.streaming.ingest_stream import run_scheduled, start_stream
from workload import fixture as fx

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_BUILT: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build: Callable):
    """Builds a stored input once per Spark application and data directory."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir)
    return _BUILT[key]


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fx.events(spark, sf_dir)  # sets the session up
        return fx.portable(function(spark, sf_dir))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    _QUERIES[function.__name__] = run
    return run


@dataclass
class Stored:
    """The stored tables, the raw files, and the moment reports refer to."""

    warehouse: Warehouse
    files: DataFrame
    lines: DataFrame
    now: datetime

    def loaded_last_day(self) -> DataFrame:
        """Base without the folders of older runs."""
        return self.warehouse.read("base", since=self.now - timedelta(days=1))

    def __getattr__(self, table: str) -> DataFrame:
        if table in ("base", "archive", "ledger", "monitoring"):
            return self.warehouse.read(table)
        raise AttributeError(table)


def stored(spark: SparkSession, sf_dir: str) -> Stored:
    warehouse = _once(spark, sf_dir, "tables", fx.build_tables)
    now = _once(spark, sf_dir, "now", fx.now_of)
    lines = fx.stored_lines(spark, sf_dir)
    return Stored(warehouse, fx.raw_files(spark, sf_dir), lines, now)


# -- operators on lines ---------------------------------------------------------------


@query
def parse_lines(spark, sf_dir):
    lines = fx.raw_lines(spark, sf_dir).withColumn("run_ts", fx.processed_at())
    return ln.parse_lines(lines, F.col("run_ts"))


@query
def parse_lines_lenient(spark, sf_dir):
    """Time rule without Z; unreadable lines that start an object become NULL rows."""
    lines = fx.raw_lines(spark, sf_dir).withColumn("run_ts", fx.processed_at())
    return ln.parse_lines(lines, F.col("run_ts"), VARIANTS["procedure"])


@query
def archive_lines(spark, sf_dir):
    lines = fx.raw_lines(spark, sf_dir).withColumn("run_ts", fx.processed_at())
    return ln.archive_lines(lines, F.col("run_ts"))


@query
def archive_reextract(spark, sf_dir):
    rows = ln.reextract(stored(spark, sf_dir).archive)
    return rows.select(
        "originating_filename",
        "raw_json",
        F.col("EventDt").alias("event_dt_text"),
        F.col("StatusCode").alias("status_text"),
        v.safe_long(F.col("Bytes")).alias("bytes_int"),
    )


@query
def row_hash64(spark, sf_dir):
    lines = fx.raw_lines(spark, sf_dir)
    return lines.select("gcs_uri", "slot", v.hash64(F.col("data")).alias("row_hash"))


@query
def file_stats(spark, sf_dir):
    return ln.file_stats(fx.raw_lines(spark, sf_dir))


@query
def ledger_rows(spark, sf_dir):
    lines = fx.raw_lines(spark, sf_dir)
    rows = ln.parse_lines(lines, F.lit(None).cast("timestamp"))
    files = fx.raw_files(spark, sf_dir)
    loaded = lg.rows_per_file(rows, "rows_loaded")
    return lg.ledger_rows(files, ln.file_stats(lines), loaded, fx.processed_at())


@query
def ledger_rows_uncounted(spark, sf_dir):
    """The variant that takes every file for a success."""
    lines = fx.raw_lines(spark, sf_dir)
    rows = ln.parse_lines(lines, F.lit(None).cast("timestamp"), VARIANTS["triggered_script"])
    files = fx.raw_files(spark, sf_dir)
    return lg.uncounted_rows(files, lg.rows_per_file(rows, "rows_loaded"), fx.processed_at())


@query
def ledger_merge(spark, sf_dir):
    """Rows an insert-only merge adds when all files are offered again."""
    s = stored(spark, sf_dir)
    files = s.files
    loaded = files.select("gcs_uri", F.lit(0).cast("bigint").alias("rows_loaded"))
    offered = lg.ledger_rows(files, ln.file_stats(s.lines), loaded, fx.processed_at())
    return lg.merge_new(s.ledger, offered)


@query
def ledger_latest(spark, sf_dir):
    return lg.latest_rows(stored(spark, sf_dir).ledger).drop("processing_duration_seconds")


# -- files ----------------------------------------------------------------------------


@query
def pending_files(spark, sf_dir):
    s = stored(spark, sf_dir)
    files = lg.not_in_ledger(s.files, s.ledger)
    uri = F.col("gcs_uri")
    return files.select(
        "gcs_uri",
        v.load_id(uri).alias("originating_filename"),
        v.file_time(uri).alias("estimated_file_time"),
    )


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """Real files: those of processed files below history/, the others below pending/."""

    def write(spark, sf_dir):
        folder = shared_folder(spark, "landing")
        part = F.when(fx.is_processed(), "history").otherwise("pending")
        fx.write_files(fx.raw_lines(spark, sf_dir), folder, part)
        return folder

    return _once(spark, sf_dir, "landing", write)


def history_landing(spark, sf_dir) -> Landing:
    return Landing((f"{_landing(spark, sf_dir)}/history",))


def whole_landing(spark, sf_dir) -> Landing:
    folder = _landing(spark, sf_dir)
    return Landing((f"{folder}/history", f"{folder}/pending"), path_pattern=r"/logs/.*\.json$")


@query
def new_files(spark, sf_dir):
    """Files on disk that a ledger does not hold, found by listing."""
    s = stored(spark, sf_dir)
    found = whole_landing(spark, sf_dir).files(spark)
    found = found.select(fx.public_uri().alias("gcs_uri"), "length")
    fresh = lg.not_in_ledger(found, s.ledger)
    return fresh.select(
        "gcs_uri",
        v.load_id(F.col("gcs_uri")).alias("originating_filename"),
        "length",
    )


@query
def scan_lines(spark, sf_dir):
    """Every line of every file on disk."""
    return whole_landing(spark, sf_dir).lines(spark).select(
        fx.public_uri().alias("gcs_uri"), "data"
    )


# -- duplicates -----------------------------------------------------------------------


def _pending_rows(s: Stored) -> DataFrame:
    lines = s.lines.filter(~fx.is_processed()).withColumn("run_ts", fx.processed_at())
    return dedup.with_event_date(ln.parse_lines(lines, F.col("run_ts")))


@query
def dedup_history(spark, sf_dir):
    s = stored(spark, sf_dir)
    scratch = shared_folder(spark, "seen")
    return dedup.drop_history(_pending_rows(s), s.base, scratch).drop("event_date")


@query
def dedup_history_any_date(spark, sf_dir):
    s = stored(spark, sf_dir)
    scratch = shared_folder(spark, "seen")
    return dedup.drop_history(_pending_rows(s), s.base, scratch, by_date=False).drop("event_date")


@query
def dedup_within_batch(spark, sf_dir):
    return dedup.first_in_batch(stored(spark, sf_dir).base).drop("event_date")


@query
def dedup_base(spark, sf_dir):
    return dedup.dedup_base(stored(spark, sf_dir).base).drop("event_date")


# -- ingestion on real files ----------------------------------------------------------

FIRST_RUN, SECOND_RUN, THIRD_RUN = (datetime(2024, 3, d, 12) for d in (1, 2, 3))


def _empty(spark) -> Warehouse:
    return Warehouse(spark, shared_folder(spark, "ingest")).create()


def _public_ledger(warehouse: Warehouse) -> DataFrame:
    rows = warehouse.read("ledger").withColumn("gcs_uri", fx.public_uri())
    return rows.drop("processing_duration_seconds")


def _history_then_all(spark, sf_dir, options=IngestOptions()) -> tuple[Warehouse, DataFrame]:
    warehouse = _empty(spark)
    ingest.ingest_batch(warehouse, history_landing(spark, sf_dir), FIRST_RUN, options)
    summary = ingest.ingest_batch(warehouse, whole_landing(spark, sf_dir), SECOND_RUN, options)
    return warehouse, summary


@query
def ingest_batch_ledger(spark, sf_dir):
    """Ledger after two runs; rows of the first are history to the second."""
    return _public_ledger(_history_then_all(spark, sf_dir)[0])


@query
def ingest_batch_base(spark, sf_dir):
    rows = _history_then_all(spark, sf_dir)[0].read("base")
    return rows.withColumn("gcs_uri", fx.public_uri()).drop("event_date")


@query
def ingest_batch_waves(spark, sf_dir):
    """The second run cut into several loads: same ledger."""
    warehouse = _empty(spark)
    ingest.ingest_batch(warehouse, history_landing(spark, sf_dir), FIRST_RUN)
    whole = whole_landing(spark, sf_dir)
    count = whole.new_files(spark, warehouse.read("ledger")).count()
    cut = Landing(whole.paths, files_per_wave=max(1, count // 3))
    ingest.ingest_batch(warehouse, cut, SECOND_RUN)
    return _public_ledger(warehouse)


@query
def ingest_archive(spark, sf_dir):
    rows = _history_then_all(spark, sf_dir)[0].read("archive")
    return rows.withColumn("gcs_uri", fx.public_uri()).drop("archived_date")


@query
def run_summary(spark, sf_dir):
    return _history_then_all(spark, sf_dir)[1]


@query
def ingest_batch_waves_within_batch(spark, sf_dir):
    """One row per fingerprint and run, the second run cut into several loads."""
    warehouse, once = _empty(spark), IngestOptions(within_batch=True)
    ingest.ingest_batch(warehouse, history_landing(spark, sf_dir), FIRST_RUN, once)
    whole = whole_landing(spark, sf_dir)
    count = whole.new_files(spark, warehouse.read("ledger")).count()
    cut = Landing(whole.paths, files_per_wave=max(1, count // 3))
    ingest.ingest_batch(warehouse, cut, SECOND_RUN, once)
    return _public_ledger(warehouse)


@query
def ingest_after_failure(spark, sf_dir):
    """The first run breaks off after one of its loads. The next call ends it, and loads what
    came later as a run of its own: the same ledger, times apart."""
    warehouse, whole = _empty(spark), whole_landing(spark, sf_dir)
    first = Landing(whole.paths, path_pattern=r"/history/.*\.json$")
    count = first.files(spark).count()
    cut = Landing(first.paths, path_pattern=first.path_pattern, files_per_wave=max(1, count // 2))
    said = []

    def lost_after_one_load(text: str) -> None:
        said.append(text)
        if len(said) == 2:
            raise RuntimeError("lost")

    with contextlib.suppress(RuntimeError):
        ingest.ingest_batch(warehouse, cut, FIRST_RUN, log=lost_after_one_load)
    ingest.ingest_batch(warehouse, whole, SECOND_RUN)
    return _public_ledger(warehouse).drop("processed_timestamp")


@query
def ingest_again(spark, sf_dir):
    """A third run over the same files adds nothing."""
    warehouse, _ = _history_then_all(spark, sf_dir)
    ingest.ingest_batch(warehouse, whole_landing(spark, sf_dir), THIRD_RUN)
    return _public_ledger(warehouse)


@query
def new_file_count(spark, sf_dir):
    """Log row at the start of a run."""
    s = stored(spark, sf_dir)
    return ingest.new_file_count(lg.not_in_ledger(s.files, s.ledger), SECOND_RUN)


@query
def failure_ledger_rows(spark, sf_dir):
    """What the ledger gets when the load of the pending files breaks off."""
    s = stored(spark, sf_dir)
    pending = lg.not_in_ledger(s.files, s.ledger)
    archived = ln.archive_lines(s.lines.select("gcs_uri", "data"), v.instant(SECOND_RUN))
    expected = lg.rows_per_file(archived, "rows_expected")
    rows = lg.failure_rows(pending, RuntimeError("disk full"), v.instant(SECOND_RUN), expected)
    return rows.drop("processing_duration_seconds")


@query
def stored_tables(spark, sf_dir):
    """Table listing with what each table holds."""
    tables = stored(spark, sf_dir).warehouse
    sizes = tables.storage().select("table_name", "row_count", (F.col("size_gb") >= 0).alias("has_size"))
    return tables.tables().select("table_name", "table_type").join(sizes, "table_name")


def _streamed(spark, sf_dir, files_per_trigger: int) -> Warehouse:
    """The two loads by a stream."""
    warehouse = _empty(spark)
    checkpoint = shared_folder(spark, "stream")
    size = {"files_per_trigger": files_per_trigger}
    for number, (landing, run) in enumerate(
        (
            (history_landing(spark, sf_dir), FIRST_RUN),
            (Landing((f"{_landing(spark, sf_dir)}/pending",)), SECOND_RUN),
        )
    ):
        run_scheduled(
            warehouse, landing, f"{checkpoint}/{number}", clock=lambda now=run: now, **size
        )
    return warehouse


@query
def ingest_stream_ledger(spark, sf_dir):
    return _public_ledger(_streamed(spark, sf_dir, 1000))


@query
def ingest_stream_small_triggers(spark, sf_dir):
    """Several triggers make up one run: the same ledger."""
    count = whole_landing(spark, sf_dir).files(spark).count()
    return _public_ledger(_streamed(spark, sf_dir, max(2, count // 4)))


@query
def ingest_stream_base(spark, sf_dir):
    rows = _streamed(spark, sf_dir, 1000).read("base")
    return rows.withColumn("gcs_uri", fx.public_uri()).drop("event_date")


@query
def ingest_stream_archive(spark, sf_dir):
    rows = _streamed(spark, sf_dir, 1000).read("archive")
    return rows.withColumn("gcs_uri", fx.public_uri()).drop("archived_date")


@query
def ingest_stream_trigger(spark, sf_dir):
    """The two loads by a stream that looks for files at intervals."""
    warehouse, checkpoint = _empty(spark), shared_folder(spark, "stream")
    loads = ((history_landing(spark, sf_dir), FIRST_RUN),)
    loads += ((Landing((f"{_landing(spark, sf_dir)}/pending",)), SECOND_RUN),)
    for number, (landing, run) in enumerate(loads):
        stream = start_stream(
            warehouse,
            landing,
            f"{checkpoint}/{number}",
            clock=lambda now=run: now,
            every="1 second",
            files_per_trigger=10**9,
        )
        stream.processAllAvailable()
        stream.stop()
    return _public_ledger(warehouse)


@query
def ingest_late_events(spark, sf_dir):
    """The pending files first, then the others, most of whose events are older: rows per file
    and date of the event."""
    warehouse = _empty(spark)
    pending = Landing((f"{_landing(spark, sf_dir)}/pending",))
    ingest.ingest_batch(warehouse, pending, FIRST_RUN)
    ingest.ingest_batch(warehouse, history_landing(spark, sf_dir), SECOND_RUN)
    rows = warehouse.read("base").groupBy("gcs_uri", "event_date").agg(F.count("*").alias("n"))
    return rows.withColumn("gcs_uri", fx.public_uri())


def _state(warehouse: Warehouse) -> DataFrame:
    """Per file: base rows, archived lines, and when and how it was processed."""
    counts = (
        lg.rows_per_file(warehouse.read("archive"), "archive_rows")
        .join(lg.rows_per_file(warehouse.read("base"), "base_rows"), "gcs_uri", "left")
        .join(warehouse.read("ledger"), "gcs_uri", "left")
    )
    return counts.select(
        fx.public_uri().alias("gcs_uri"),
        "archive_rows",
        F.coalesce("base_rows", F.lit(0)).alias("base_rows"),
        "processed_timestamp",
        "rows_loaded",
        "status",
    )


@query
def reprocess_failed(spark, sf_dir):
    """All files in one run, then the unfinished ones again."""
    warehouse, landing = _empty(spark), whole_landing(spark, sf_dir)
    ingest.ingest_batch(warehouse, landing, FIRST_RUN)
    reprocess.reprocess_unfinished(warehouse)
    ingest.ingest_batch(warehouse, landing, SECOND_RUN)
    return _state(warehouse)


@query
def reprocess_range(spark, sf_dir):
    """Two runs; the files of the second are forgotten."""
    warehouse = _history_then_all(spark, sf_dir)[0]
    reprocess.reprocess_range(warehouse, SECOND_RUN - timedelta(hours=1), SECOND_RUN)
    return _state(warehouse)


@query
def reprocess_file(spark, sf_dir):
    """One file, the first by name among the PARTIAL ones, forgotten and loaded again."""
    warehouse, landing = _empty(spark), whole_landing(spark, sf_dir)
    ingest.ingest_batch(warehouse, landing, FIRST_RUN)
    partial = warehouse.read("ledger").filter("status = 'PARTIAL'")
    first = partial.orderBy(fx.public_uri()).select("gcs_uri").first()[0]
    reprocess.reprocess_file(warehouse, first)
    ingest.ingest_batch(warehouse, landing, SECOND_RUN)
    return _state(warehouse)


@query
def full_reload(spark, sf_dir):
    """Two runs, then everything again in one."""
    warehouse = _history_then_all(spark, sf_dir)[0]
    reprocess.full_reload(warehouse)
    ingest.ingest_batch(warehouse, whole_landing(spark, sf_dir), THIRD_RUN)
    return _state(warehouse)


@query
def deduplicate_base(spark, sf_dir):
    """All files in one run, then the stored base table without repeated rows."""
    warehouse = _empty(spark)
    ingest.ingest_batch(warehouse, whole_landing(spark, sf_dir), FIRST_RUN)
    reprocess.deduplicate_base(warehouse)
    rows = lg.rows_per_file(warehouse.read("base"), "base_rows")
    return rows.withColumn("gcs_uri", fx.public_uri())


@query
def drop_superseded_ledger(spark, sf_dir):
    """The stored ledger without superseded rows."""
    warehouse = fx.build_tables(spark, sf_dir)
    reprocess.drop_superseded_ledger_rows(warehouse)
    return warehouse.read("ledger").drop("processing_duration_seconds")


@query
def conformance(spark, sf_dir):
    counts = cf.conformance_counts(whole_landing(spark, sf_dir).lines(spark))
    return counts.withColumn("gcs_uri", fx.public_uri())


@query
def conformance_examples(spark, sf_dir):
    rows = cf.conformance_examples(whole_landing(spark, sf_dir).numbered_lines(spark))
    return rows.withColumn("gcs_uri", fx.public_uri())


@query
def conformance_report(spark, sf_dir):
    """Counts and first lines of every file from one reading of the text."""
    rows = cf.conformance(whole_landing(spark, sf_dir).numbered_lines(spark))
    told = F.transform(
        "examples",
        lambda e: F.concat(
            e["line"].cast("string"),
            F.lit(" "),
            F.coalesce(e["error"], F.concat_ws(" ", F.lit("ok"), e["cust_id"], e["filename"])),
        ),
    )
    rows = rows.withColumn("first_lines", F.array_join(told, ";")).drop("examples")
    return rows.withColumn("gcs_uri", fx.public_uri())


# -- tables ---------------------------------------------------------------------------


@query
def lookup_fingerprint(spark, sf_dir):
    """Base rows with one fingerprint, the greatest there is."""
    tables = stored(spark, sf_dir).warehouse
    greatest = tables.read("base").agg(F.max("hash_fingerprint")).first()[0]
    return tables.find("base", "hash_fingerprint", [greatest]).drop("event_date")


@query
def lookup_files(spark, sf_dir):
    """Base rows of the unfinished files among the first by name."""
    s = stored(spark, sf_dir)
    bad = s.ledger.filter("status = 'PARTIAL'").select("gcs_uri").distinct()
    names = [r[0] for r in bad.orderBy("gcs_uri").limit(3).collect()]
    return lg.rows_per_file(s.warehouse.find("base", "gcs_uri", names), "base_rows")


@query
def clustered_base(spark, sf_dir):
    """Base rows of the busiest source and its busiest customer, after all dates were clustered."""
    tables = fx.build_tables(spark, sf_dir)
    dates = tables.read("base").select(F.col("event_date").cast("string")).distinct().collect()
    reprocess.cluster_base(tables, [r[0] for r in dates if r[0]])
    base = tables.read("base")
    counts = base.groupBy("source", "cust_id").agg(F.count("*").alias("n"))
    source, customer, _ = counts.orderBy(F.desc("n"), "source", "cust_id").first()
    found = base.filter((F.col("source") == source) & (F.col("cust_id") == customer))
    return found.drop("event_date")


@query
def append_snapshots(spark, sf_dir):
    """The monitoring table after checks at two moments."""
    s, tables = stored(spark, sf_dir), fx.build_tables(spark, sf_dir)
    for now in (s.now - timedelta(days=1), s.now):
        monitoring.append_snapshot(tables, s.files, now)
    return tables.read("monitoring")


@query
def alert_after_snapshots(spark, sf_dir):
    """What is answered before any check, and by a check after an earlier one."""
    s, tables = stored(spark, sf_dir), fx.build_tables(spark, sf_dir)
    before = health.latest_alert(tables.read("monitoring")).withColumn("asked", F.lit("before"))
    monitoring.append_snapshot(tables, s.files, s.now - timedelta(days=1))
    after = monitoring.append_snapshot(tables, s.files, s.now).withColumn("asked", F.lit("after"))
    return before.unionByName(after)


@query
def added_column(spark, sf_dir):
    """Ledger rows from before and after a column was added."""
    s, tables = stored(spark, sf_dir), fx.build_tables(spark, sf_dir)
    tables.add_column("ledger", StructField("reviewed_by", StringType()))
    pending = lg.not_in_ledger(s.files, s.ledger)
    rows = lg.failure_rows(pending, RuntimeError("late"), v.instant(SECOND_RUN), None)
    tables.append("ledger", rows.withColumn("reviewed_by", F.lit("night shift")), "second")
    return tables.read("ledger").select("gcs_uri", "status", "reviewed_by")


@query
def refused_nulls(spark, sf_dir):
    """A write in which some required values are NULL fails as a whole and leaves the table as
    it was."""
    s, tables = stored(spark, sf_dir), fx.build_tables(spark, sf_dir)
    some = F.when(F.col("status") == "SUCCESS", F.col("originating_filename"))
    with contextlib.suppress(Exception):
        tables.append("ledger", s.ledger.withColumn("originating_filename", some), "nulls")
    return tables.read("ledger").drop("processing_duration_seconds")


@query
def millis_to_instants(spark, sf_dir):
    """Event times that went through milliseconds."""
    events = fx.events(spark, sf_dir)
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select("event_id", v.from_millis(millis).alias("event_time"))


# -- reports --------------------------------------------------------------------------


@query
def r01_pipeline_status(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.pipeline_status(s.ledger, s.now)


@query
def r02_pending_count(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.pending_count(s.files, s.ledger)


@query
def r03_recent_files(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.recent_files(s.ledger, s.now)


@query
def r03_last_loads(spark, sf_dir):
    return health.last_loads(stored(spark, sf_dir).ledger)


@query
def r04_files_with_errors(spark, sf_dir):
    return health.files_with_errors(stored(spark, sf_dir).ledger)


def _a_partial_file(s: Stored) -> str:
    partial = s.ledger.filter("status = 'PARTIAL'")
    return partial.agg(F.max("gcs_uri")).first()[0]


@query
def r05_row_reconciliation(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.row_reconciliation(s.ledger, s.base, s.archive, _a_partial_file(s))


@query
def r06_null_check(spark, sf_dir):
    s = stored(spark, sf_dir)
    return quality.null_check(s.loaded_last_day(), s.now)


@query
def r07_cast_failures(spark, sf_dir):
    s = stored(spark, sf_dir)
    return quality.cast_failures(s.loaded_last_day(), s.now)


@query
def r08_duplicate_files(spark, sf_dir):
    return quality.duplicate_files(stored(spark, sf_dir).ledger)


@query
def r09_duplicate_rows(spark, sf_dir):
    s = stored(spark, sf_dir)
    return quality.duplicate_rows(s.loaded_last_day(), s.now)


@query
def r10_daily_volume(spark, sf_dir):
    return volume.daily_volume(stored(spark, sf_dir).ledger)


@query
def r11_hourly_distribution(spark, sf_dir):
    s = stored(spark, sf_dir)
    return volume.hourly_distribution(s.ledger, s.now)


@query
def r12_source_volume(spark, sf_dir):
    s = stored(spark, sf_dir)
    return volume.source_volume(s.base, s.now)


@query
def r13_user_mix(spark, sf_dir):
    s = stored(spark, sf_dir)
    return business.user_mix(s.base, s.now)


@query
def r14_action_mix(spark, sf_dir):
    s = stored(spark, sf_dir)
    return business.action_mix(s.base, s.now)


@query
def r15_latest_events(spark, sf_dir):
    return business.latest_events(stored(spark, sf_dir).warehouse.read_newest("base", 20))


@query
def r16_archive_completeness(spark, sf_dir):
    s = stored(spark, sf_dir)
    return quality.archive_completeness(s.base, s.archive)


@query
def r17_archive_validity(spark, sf_dir):
    return quality.archive_validity(stored(spark, sf_dir).warehouse.read_newest("archive", 10))


@query
def r18_heartbeat(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.heartbeat(s.files, s.ledger, s.now)


@query
def r19_processing_latency(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.processing_latency(s.files, s.ledger, s.now)


@query
def r20_error_rate(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.error_rate(s.ledger, s.now)


@query
def r21_volume_anomaly(spark, sf_dir):
    s = stored(spark, sf_dir)
    return volume.volume_anomaly(s.ledger, s.now)


@query
def r21_volume_statistics(spark, sf_dir):
    s = stored(spark, sf_dir)
    rows = volume.volume_statistics(s.ledger, s.now)
    return rows.withColumn("stddev_rows", F.round("stddev_rows", 6))


@query
def r22_stale_files(spark, sf_dir):
    s = stored(spark, sf_dir)
    rows = backlog.stale_files(s.files, s.ledger, s.now)
    return rows.withColumn("sample_stale_files", F.array_join("sample_stale_files", ","))


@query
def storage_growth(spark, sf_dir):
    """Sizes and times of change differ from run to run: whether they are there."""
    rows = volume.storage_growth(stored(spark, sf_dir).warehouse)
    return rows.select(
        "table_name",
        "row_count",
        (F.col("size_gb") >= 0).alias("has_size"),
        F.col("last_modified").isNotNull().alias("has_files"),
    )


@query
def r24_dashboard(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.dashboard(s.files, s.ledger, s.now)


@query
def r25_monitoring_snapshot(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.monitoring_snapshot(s.files, s.ledger, s.now)


@query
def r26_latest_alert(spark, sf_dir):
    """Snapshots of two moments; the newer one answers."""
    s = stored(spark, sf_dir)
    earlier = health.monitoring_snapshot(s.files, s.ledger, s.now - timedelta(days=1))
    newer = health.monitoring_snapshot(s.files, s.ledger, s.now)
    return health.latest_alert(earlier.unionByName(newer))


@query
def r27_metric_table(spark, sf_dir):
    s = stored(spark, sf_dir)
    return health.metric_table(s.ledger, s.base, s.archive)


@query
def r28_file_visibility(spark, sf_dir):
    rows = quality.file_visibility(whole_landing(spark, sf_dir).lines(spark))
    return rows.withColumn("gcs_uri", fx.public_uri())


@query
def r29_unfinished_files(spark, sf_dir):
    return reprocessing.unfinished_files(stored(spark, sf_dir).ledger)


@query
def r30_file_state(spark, sf_dir):
    s = stored(spark, sf_dir)
    return reprocessing.file_state(s.ledger, _a_partial_file(s))


@query
def r30_files_in_range(spark, sf_dir):
    s = stored(spark, sf_dir)
    start = s.now.replace(hour=0, minute=0, second=0) - timedelta(days=3)
    return reprocessing.files_in_range(s.ledger, start, start + timedelta(days=2))


@query
def r31_reload_preview(spark, sf_dir):
    return reprocessing.reload_preview(stored(spark, sf_dir).ledger)


@query
def r32_duplicate_ledger(spark, sf_dir):
    rows = reprocessing.duplicate_ledger_entries(stored(spark, sf_dir).ledger)
    texts = F.transform("processing_times", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
    return rows.withColumn("processing_times", F.array_join(texts, ","))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)
