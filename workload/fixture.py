"""Log files, tables and a ledger made from the ``events`` table, so that they grow with it.

Event ``s`` fills slot ``s``; 50 slots make a file. Some slots hold something else than the
line of their event: a damaged line, blanks, or a copy of an earlier line. One SQL text
serves Spark and DuckDB; the few functions that differ are placeholders.
"""

from __future__ import annotations

from datetime import datetime
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.operators import ledger as lg
from logledger.operators.dedup import stored
from logledger.operators.lines import archive_lines, parse_lines
from logledger.session import configure
from logledger.sources.files import shared_folder
from logledger.sources.warehouse import Warehouse

FULL_SPLIT = 128 * 1024**2
ROOT = "mem://bucket/logs/"

FILES = """
SELECT file_no, concat('$root', 'gate-', CAST(file_no % 4 + 1 AS $string), '-', $stamp,
    '0000-', CAST(file_no AS $string), '.json') AS gcs_uri,
  date_trunc('second', ts) AS file_ts
FROM (SELECT $file_no AS file_no, min(ts) AS ts FROM $events GROUP BY 1)
"""

LINES = """
WITH slots AS (
  SELECT event_id AS slot, $file_no AS file_no, ts, user_id, event_type, value
  FROM $events
), filled AS (
  SELECT *, CASE
      WHEN file_no % 33 = 20 THEN 'blank'
      WHEN file_no % 33 = 10 THEN 'text'
      WHEN file_no % 3 <> 1 THEN 'own'
      WHEN slot % 50 = 7 THEN 'cut'
      WHEN slot % 97 = 3 THEN 'text'
      WHEN slot % 101 = 5 THEN 'blank'
      WHEN slot % 89 = 11 THEN 'previous'
      WHEN slot % 83 = 17 THEN 'earlier'
      ELSE 'own' END AS kind,
    CASE WHEN user_id % 10 < 3 THEN concat('partner-', CAST(user_id AS $string))
      ELSE CAST(user_id AS $string) END AS user_name,
    CASE WHEN user_id % 10 < 4 THEN '0' ELSE CAST(user_id AS $string) END AS cust_id,
    CASE WHEN user_id % 10 < 3 THEN concat('"partner-', CAST(user_id AS $string), '"')
      ELSE 'null' END AS partner,
    CASE WHEN slot % 61 = 2 THEN $day WHEN slot % 67 = 1 THEN $seconds
      ELSE concat($millis, 'Z') END AS event_dt,
    CASE WHEN slot % 71 = 3 THEN '"n/a"' WHEN slot % 73 = 4 THEN '3.7'
      ELSE CAST(CAST(round(value * 100) AS BIGINT) AS $string) END AS byte_count
  FROM slots
), written AS (
  SELECT slot, file_no, kind, concat(
    '{"UserName":"', user_name, '","CustId":', cust_id, ',"PartnerName":', partner,
    ',"EventDt":"', event_dt, '","Action":"', event_type,
    '","Filename":"/f/', CAST(slot % 50 AS $string), '","SessionId":"s-', CAST(slot AS $string),
    '","IpAddress":"10.0.', CAST(user_id % 7 AS $string), '.', CAST(user_id % 11 AS $string),
    '","Source":"gate-', CAST(file_no % 4 + 1 AS $string), '","Bytes":', byte_count,
    ',"StatusCode":226,"ServerResponse":"ok","RawData":"', event_type, ' Bytes CustId"',
    ',"HashCode":', CAST(slot * 7919 - 40000000 AS $string), '}') AS own_line
  FROM filled
), placed AS (
  SELECT slot, file_no, CASE kind WHEN 'own' THEN own_line
    WHEN 'cut' THEN CASE slot % 3 WHEN 0 THEN '{"a":1}] rest' WHEN 1 THEN '{"a":1}],[{"b":'
      ELSE '{"UserName":"u' END
    WHEN 'text' THEN CASE slot % 2 WHEN 0 THEN '1],[2' ELSE 'no record here' END
    ELSE '   ' END AS data
  FROM written WHERE kind NOT IN ('previous', 'earlier')
  UNION ALL
  SELECT c.slot, c.file_no, o.own_line AS data
  FROM written c JOIN written o
    ON o.slot = CASE c.kind WHEN 'previous' THEN c.slot - 1 ELSE c.slot - 100 END
  WHERE c.kind IN ('previous', 'earlier')
)
SELECT p.file_no, p.slot, f.file_ts, f.gcs_uri, p.data
FROM placed p JOIN ($files) f ON p.file_no = f.file_no
"""

SPARK = {
    "events": "workload_events",
    "file_no": "event_id DIV 50",
    "string": "STRING",
    "millis": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")",
    "seconds": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "day": "date_format(ts, 'yyyy-MM-dd')",
    "stamp": "date_format(ts, 'yyyyMMdd-HHmmss')",
    "root": ROOT,
}
DUCKDB = {
    "events": "events",
    "file_no": "event_id // 50",
    "string": "VARCHAR",
    "millis": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')",
    "seconds": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    "day": "strftime(ts, '%Y-%m-%d')",
    "stamp": "strftime(ts, '%Y%m%d-%H%M%S')",
    "root": ROOT,
}


def files_sql(dialect: dict[str, str]) -> str:
    return Template(FILES).substitute(dialect)


def lines_sql(dialect: dict[str, str]) -> str:
    return Template(LINES).substitute(dialect, files=files_sql(dialect))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    # A small table is one file with one row group, which one task reads: spread it over the
    # cores. A table of at least one full split per core is left as it is.
    cores = spark.sparkContext.defaultParallelism
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return rows.repartition(cores) if size < cores * FULL_SPLIT else rows


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_no, slot, file_ts, gcs_uri, data) of every line of every file."""
    events(spark, sf_dir).createOrReplaceTempView("workload_events")
    lines = spark.sql(lines_sql(SPARK))
    # A generator keeps filters on the line from repeating the making of the line below it:
    # to the queries it shall be like a scanned column.
    lines = lines.withColumn("data", F.explode(F.array("data")))
    return lines.withColumn("file_ts", F.col("file_ts").cast("timestamp"))


_LINES: dict[tuple[str, str], DataFrame] = {}


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_lines`` from disk, made once per Spark application and data directory: making them
    shuffles every line twice."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LINES:
        _LINES[key] = stored(raw_lines(spark, sf_dir), shared_folder(spark, "lines"))
    return _LINES[key]


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_no, file_ts, gcs_uri) of every file."""
    events(spark, sf_dir).createOrReplaceTempView("workload_events")
    files = spark.sql(files_sql(SPARK))
    return files.withColumn("file_ts", F.col("file_ts").cast("timestamp"))


def now_of(spark: SparkSession, sf_dir: str) -> datetime:
    """The moment all reports refer to: the second of the last event."""
    last = F.date_trunc("second", F.max("ts")).cast("timestamp_ntz")
    return events(spark, sf_dir).agg(last).first()[0]


def is_processed() -> F.Column:
    """Four of five files are in the ledger; the others are pending."""
    return F.col("file_no") % 5 != 0


def processed_at() -> F.Column:
    return F.col("file_ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("file_no") * 7 % 25).cast("int")
    )


def _stamped(lines: DataFrame) -> DataFrame:
    return lines.filter(is_processed()).withColumn("run_ts", processed_at())


def build_tables(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Base, archive and ledger as if every processed file had had a run of its own; files
    with ``file_no % 20 = 1`` have a second, later ledger row."""
    lines = _stamped(stored_lines(spark, sf_dir))
    run_ts = F.col("run_ts")
    warehouse = Warehouse(spark, shared_folder(spark, "workload")).create()
    archive = warehouse.stage("archive", archive_lines(lines, run_ts), "first")
    base = warehouse.stage("base", parse_lines(lines, run_ts), "first")
    files = _stamped(raw_files(spark, sf_dir))
    expected = lg.rows_per_file(warehouse.read_folders("archive", archive.added), "rows_expected")
    loaded = lg.rows_per_file(warehouse.read_folders("base", base.added), "rows_loaded")
    rows = lg.ledger_rows(files, expected, loaded, run_ts)
    again = files.filter(F.col("file_no") % 20 == 1).withColumn(
        "run_ts", run_ts + F.expr("INTERVAL 3 HOURS")
    )
    rows = rows.unionByName(lg.ledger_rows(again, expected, loaded, run_ts))
    ledger = warehouse.stage("ledger", rows, "first")
    warehouse.commit(archive, base, ledger)
    return warehouse


def write_files(lines: DataFrame, folder: str, part: F.Column | None = None) -> int:
    """Writes the lines as files named like their uri, below ``folder``/logs, or below
    ``folder``/``part``/logs. Each task writes the files whose lines it holds, one after the
    other; a file has at most 50 lines."""

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(uri)
        made = set()

        def put(place, name, data):
            home = "/".join(p for p in (path, place, "logs") if p)
            if home not in made:
                system.create_dir(home, recursive=True)
                made.add(home)
            with system.open_output_stream(f"{home}/{name}") as out:
                out.write(("\n".join(data) + "\n").encode())

        file, data, count = None, [], 0
        for batch in batches:
            for place, name, line in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if file != (place, name):
                    if file:
                        put(*file, data)
                    file, data, count = (place, name), [], count + 1
                data.append(line)
        if file:
            put(*file, data)
        yield pa.RecordBatch.from_pydict({"files": pa.array([count], pa.int64())})

    uri = folder if "://" in folder else f"file://{folder}"
    rows = lines.select((F.lit("") if part is None else part).alias("part"), "gcs_uri", "slot", "data")
    rows = rows.repartition("gcs_uri").sortWithinPartitions("gcs_uri", "slot")
    named = rows.select("part", F.substring_index("gcs_uri", "/", -1).alias("name"), "data")
    return named.mapInArrow(write, "files bigint").agg(F.sum("files")).first()[0]


def public_uri(column: str = "gcs_uri") -> F.Column:
    """The uri without the folder the files were written to."""
    return F.regexp_replace(column, "^.*/logs/", ROOT)


def portable(rows: DataFrame) -> DataFrame:
    """Types every engine hands out alike: instants as UTC wall-clock times, dates as text."""
    types = {"timestamp": "timestamp_ntz", "date": "string"}
    return rows.select(*[F.col(n).cast(types.get(t, t)).alias(n) for n, t in rows.dtypes])
