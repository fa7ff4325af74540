"""The same results in DuckDB SQL, for comparison. Written on their own from the meaning of
each query; they share nothing with the library but the text that makes the log lines."""

from __future__ import annotations

from workload.fixture import DUCKDB, lines_sql


def _field(key: str) -> str:
    return f"json_extract_string(doc, '$.{key}')"


def _integer(key: str) -> str:
    text = _field(key)
    return f"CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+') THEN CAST({text} AS BIGINT) END"


def _time(text: str, zone: str = "Z?") -> str:
    shape = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?" + zone
    plain = f"replace(replace({text}, 'T', ' '), 'Z', '')"
    return f"CASE WHEN regexp_full_match({text}, '{shape}') THEN CAST({plain} AS TIMESTAMP) END"


PROCESSED_AT = "file_ts + to_minutes(CAST(file_no * 7 % 25 AS BIGINT))"
LOAD_ID = r"regexp_extract(gcs_uri, '/([^/]+)\.json$', 1)"
NOT_BLANK = r"NOT regexp_full_match(data, '\s*')"
FILE_TIME = r"strptime(regexp_extract(gcs_uri, '-(\d{8}-\d{6})', 1), '%Y%m%d-%H%M%S')"
FINGERPRINT = "sha256(concat_ws('|', %s))" % ", ".join(
    f"coalesce({_field(k)}, '')" for k in ("EventDt", "Source", "Filename", "Bytes", "UserName")
)

BASE_COLUMNS = """load_time_dt, source_file_dt, originating_filename, gcs_uri, action, bytes,
 cust_id, event_dt, filename, hash_code, hash_fingerprint, ip_address, partner_name, session_id,
 source, user_name, server_response, raw_data"""


def _rows(docs: str, event_dt: str) -> str:
    return f"""SELECT file_no, slot, file_ts, run_ts AS load_time_dt,
   coalesce({event_dt}, run_ts) AS source_file_dt, {LOAD_ID} AS originating_filename, gcs_uri,
   {_field('Action')} AS action, {_integer('Bytes')} AS bytes, {_integer('CustId')} AS cust_id,
   {event_dt} AS event_dt, {_field('Filename')} AS filename, {_integer('HashCode')} AS hash_code,
   {FINGERPRINT} AS hash_fingerprint, {_field('IpAddress')} AS ip_address,
   {_field('PartnerName')} AS partner_name, {_field('SessionId')} AS session_id,
   {_field('Source')} AS source, {_field('UserName')} AS user_name,
   {_field('ServerResponse')} AS server_response, {_field('RawData')} AS raw_data, data
 FROM {docs}"""


LEDGER_COLUMNS = """gcs_uri, originating_filename, processed_timestamp, rows_loaded, rows_expected,
 parse_errors, status, error_message"""


def _ledger(counts: str) -> str:
    """Ledger rows from (gcs_uri, done_at, want, have)."""
    return f"""SELECT gcs_uri, {LOAD_ID} AS originating_filename, done_at AS processed_timestamp,
   have AS rows_loaded, want AS rows_expected,
   CASE WHEN want > have THEN want - have ELSE 0 END AS parse_errors,
   CASE WHEN least(want, have) = 0 THEN 'FAILED' WHEN have < want THEN 'PARTIAL'
     ELSE 'SUCCESS' END AS status,
   CASE WHEN want = 0 THEN 'No non-empty rows found in file'
     WHEN have = 0 THEN 'No rows loaded from file'
     WHEN have < want THEN format('Parsed {{}} of {{}} rows', have, want) END AS error_message
 FROM ({counts})"""


CTES = {
    "lines": lines_sql(DUCKDB),
    "marked": f"SELECT *, {PROCESSED_AT} AS run_ts, file_no % 5 <> 0 AS done FROM lines",
    "docs": """SELECT *, CASE WHEN json_valid(data) THEN
      CASE WHEN json_type(data) = 'OBJECT' THEN data END END AS doc FROM marked""",
    "good": "SELECT * FROM docs WHERE doc IS NOT NULL",
    "rows": _rows("good", _time(_field("EventDt"))),
    "files": """SELECT file_no, file_ts, run_ts, done, gcs_uri, count(*) AS line_count FROM marked
      GROUP BY ALL""",
    "want": f"SELECT gcs_uri, count(*) FILTER ({NOT_BLANK}) AS want FROM lines GROUP BY gcs_uri",
    "have": "SELECT gcs_uri, count(*) AS have FROM rows GROUP BY gcs_uri",
    "counts": """SELECT f.*, w.want, coalesce(h.have, 0) AS have
      FROM files f JOIN want w USING (gcs_uri) LEFT JOIN have h USING (gcs_uri)""",
    "base": "SELECT * FROM rows WHERE file_no % 5 <> 0",
    "archive": f"""SELECT data AS raw_json, run_ts AS archived_timestamp, run_ts AS process_dt,
      {LOAD_ID} AS originating_filename, gcs_uri FROM marked WHERE done AND {NOT_BLANK}""",
    "runs": """SELECT gcs_uri, run_ts AS done_at, want, have FROM counts WHERE done UNION ALL
      SELECT gcs_uri, run_ts + INTERVAL 3 HOURS, want, have FROM counts
      WHERE done AND file_no % 20 = 1""",
    "ledger": _ledger("SELECT * FROM runs"),
    "clock": "SELECT date_trunc('second', max(ts)) AS now FROM events",
    "waiting": f"SELECT gcs_uri, {FILE_TIME} AS file_time FROM files WHERE NOT done",
    # Rows of pending files that history does not hold.
    "fresh": """SELECT * FROM rows r WHERE file_no % 5 = 0 AND hash_fingerprint NOT IN
      (SELECT hash_fingerprint FROM base)""",
    # Two runs: processed files first, then the pending ones without what is already there.
    "two_loads": """SELECT gcs_uri, done,
        CASE WHEN done THEN TIMESTAMP '2024-03-01 12:00:00' ELSE TIMESTAMP '2024-03-02 12:00:00'
        END AS done_at, want, CASE WHEN done THEN have ELSE coalesce(n, 0) END AS have
      FROM counts LEFT JOIN (SELECT gcs_uri, count(*) AS n FROM fresh GROUP BY 1) USING (gcs_uri)""",
    "two_runs": _ledger("SELECT * FROM two_loads"),
    "one_run": _ledger("SELECT *, TIMESTAMP '2024-03-01 12:00:00' AS done_at FROM counts"),
    "day": """SELECT * FROM ledger, clock
      WHERE processed_timestamp >= now - INTERVAL 24 HOURS""",
    "base_day": "SELECT b.* FROM base b, clock WHERE load_time_dt >= now - INTERVAL 24 HOURS",
    "base_week": "SELECT b.* FROM base b, clock WHERE event_dt >= now - INTERVAL 7 DAYS",
}


def _sql(body: str, **extra: str) -> str:
    parts = [f"{name} AS ({text})" for name, text in (CTES | extra).items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _minutes(start: str, end: str) -> str:
    return f"date_sub('minute', {start}, {end})"


def _files_after(forgotten: str) -> dict[str, str]:
    """One run over all files; those meeting the condition are loaded again and compared with
    the rows of the others."""
    return {
        "again": f"SELECT gcs_uri FROM one_run WHERE {forgotten}",
        "kept": "SELECT * FROM rows WHERE gcs_uri NOT IN (SELECT gcs_uri FROM again)",
        "reloaded": """SELECT gcs_uri, count(*) AS n FROM rows
          WHERE gcs_uri IN (SELECT gcs_uri FROM again)
            AND hash_fingerprint NOT IN (SELECT hash_fingerprint FROM kept) GROUP BY 1""",
        "outcome": _ledger(
            """SELECT gcs_uri, want,
              CASE WHEN a.gcs_uri IS NULL THEN TIMESTAMP '2024-03-01 12:00:00'
                ELSE TIMESTAMP '2024-03-02 12:00:00' END AS done_at,
              CASE WHEN a.gcs_uri IS NULL THEN have ELSE coalesce(n, 0) END AS have
            FROM counts LEFT JOIN again a USING (gcs_uri) LEFT JOIN reloaded USING (gcs_uri)"""
        ),
    }


# The archive is never emptied: a file loaded again is there twice.
STATE = """SELECT gcs_uri, rows_expected * CASE WHEN a.gcs_uri IS NULL THEN 1 ELSE 2 END
    AS archive_rows, rows_loaded AS base_rows, processed_timestamp, rows_loaded, status
  FROM outcome LEFT JOIN again a USING (gcs_uri) WHERE rows_expected > 0"""

STATUS_COUNTS = """count(*) FILTER (status = 'SUCCESS') AS successful,
  count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'PARTIAL') AS partial"""

REQUIRED = (
    "UserName CustId EventDt Action Filename SessionId IpAddress Source Bytes StatusCode".split()
)
ISO = r"\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d{3})?Z?)?"
VERDICT = f"""SELECT gcs_uri, slot, data, CASE
    WHEN doc IS NULL THEN 'json'
    WHEN NOT list_has_all(json_keys(doc), {REQUIRED!r}) THEN 'missing'
    WHEN {_integer('CustId')} IS NULL OR {_integer('Bytes')} IS NULL
      OR {_integer('StatusCode')} IS NULL THEN 'int_cast'
    WHEN NOT regexp_full_match({_field('EventDt')}, '{ISO}') THEN 'ts' END AS error,
    {_integer('CustId')} AS cust_id, {_field('EventDt')} AS event_dt,
    {_field('Filename')} AS filename
  FROM docs WHERE {NOT_BLANK}"""

SNAPSHOT_PARTS = {
    "snap": """SELECT now,
      (SELECT count(*) FROM ledger WHERE processed_timestamp >= now - INTERVAL 1 HOUR) AS done_1h,
      (SELECT count(*) FROM waiting) AS pending,
      (SELECT round(100.0 * count(*) FILTER (status <> 'SUCCESS') / nullif(count(*), 0), 2)
       FROM ledger WHERE processed_timestamp >= now - INTERVAL 24 HOURS) AS error_pct,
      (SELECT max(date_sub('minute', file_time, now)) FROM waiting) AS oldest,
      (SELECT count(*) FROM waiting WHERE date_sub('minute', file_time, now) > 30) AS stale
    FROM clock""",
    "snapshot": """SELECT now AS check_time, done_1h AS files_processed_last_hour,
      pending AS files_pending, error_pct AS error_rate_pct, oldest AS max_latency_minutes,
      stale AS stale_file_count,
      CASE WHEN (done_1h = 0 AND pending > 0) OR coalesce(error_pct, 0) > 5
        OR coalesce(oldest, 0) > 15 OR stale > 0 THEN 'ALERT' ELSE 'OK' END AS status,
      concat('processed_last_hour=', done_1h, ', pending=', pending, ', error_rate_pct=',
        regexp_replace(CAST(coalesce(error_pct, 0) AS VARCHAR), '\\.0$', ''),
        ', max_latency_min=', coalesce(oldest, 0), ', stale_files=', stale) AS details
    FROM snap""",
}


# The same at two moments: the counts are joined to each of them.
TWO_SNAPSHOTS = {
    "moments": "SELECT now FROM clock UNION ALL SELECT now - INTERVAL 1 DAY FROM clock",
    "snap": """SELECT now, hour AS done_1h, (SELECT count(*) FROM waiting) AS pending,
      round(100.0 * bad / nullif(day, 0), 2) AS error_pct, oldest, stale
    FROM (SELECT c.now, count(l.gcs_uri) FILTER (l.processed_timestamp >= c.now - INTERVAL 1 HOUR)
          AS hour, count(l.gcs_uri) AS day, count(*) FILTER (l.status <> 'SUCCESS') AS bad
        FROM moments c LEFT JOIN ledger l ON l.processed_timestamp >= c.now - INTERVAL 24 HOURS
        GROUP BY c.now)
      JOIN (SELECT now, max(age) AS oldest, count(*) FILTER (age > 30) AS stale
        FROM (SELECT now, date_sub('minute', file_time, now) AS age FROM moments, waiting)
        GROUP BY now) USING (now)""",
    "snapshot": SNAPSHOT_PARTS["snapshot"],
}


def all_sql() -> dict[str, str]:
    lenient = """SELECT *, CASE WHEN doc IS NULL THEN '{}' ELSE doc END AS readable FROM docs
      WHERE regexp_matches(data, '^\\s*\\{')"""
    q = {
        "parse_lines": _sql(f"SELECT {BASE_COLUMNS} FROM rows"),
        "parse_lines_lenient": _sql(
            f"SELECT {BASE_COLUMNS} FROM all_rows",
            opened=lenient,
            readable_docs="SELECT * REPLACE (readable AS doc) FROM opened",
            all_rows=_rows("readable_docs", _time(_field("EventDt"), zone="")),
        ),
        "archive_lines": _sql(
            f"""SELECT data AS raw_json, run_ts AS archived_timestamp, run_ts AS process_dt,
              {LOAD_ID} AS originating_filename, gcs_uri FROM marked WHERE {NOT_BLANK}"""
        ),
        "archive_reextract": _sql(
            f"""SELECT {LOAD_ID} AS originating_filename, data AS raw_json,
              {_field('EventDt')} AS event_dt_text, {_field('StatusCode')} AS status_text,
              {_integer('Bytes')} AS bytes_int FROM good WHERE done"""
        ),
        "row_hash64": _sql(
            """SELECT gcs_uri, slot, CAST(CASE WHEN u >= 9223372036854775808
                THEN u - 18446744073709551616 ELSE u END AS BIGINT) AS row_hash
              FROM (SELECT gcs_uri, slot,
                CAST(CAST('0x' || substr(sha256(data), 1, 16) AS UBIGINT) AS HUGEINT) AS u
                FROM lines)"""
        ),
        "file_stats": _sql(
            f"SELECT gcs_uri, {LOAD_ID} AS originating_filename, want AS rows_expected FROM want"
        ),
        "ledger_rows": _sql(
            f"SELECT {LEDGER_COLUMNS}, 0.0::DOUBLE AS processing_duration_seconds FROM l",
            l=_ledger("SELECT *, run_ts AS done_at FROM counts"),
        ),
        "ledger_rows_uncounted": _sql(
            f"""SELECT gcs_uri, {LOAD_ID} AS originating_filename, run_ts AS processed_timestamp,
              count(data) FILTER (regexp_matches(data, '^\\s*\\{{')) AS rows_loaded,
              NULL::BIGINT AS rows_expected, NULL::BIGINT AS parse_errors, 'SUCCESS' AS status,
              NULL::VARCHAR AS error_message, NULL::DOUBLE AS processing_duration_seconds
            FROM marked GROUP BY gcs_uri, run_ts"""
        ),
        "ledger_merge": _sql(
            f"SELECT {LEDGER_COLUMNS}, 0.0::DOUBLE AS processing_duration_seconds FROM l",
            l=_ledger(
                "SELECT gcs_uri, run_ts AS done_at, want, 0::BIGINT AS have FROM counts WHERE NOT done"
            ),
        ),
        "ledger_latest": _sql(
            f"""SELECT {LEDGER_COLUMNS} FROM ledger l WHERE NOT EXISTS (SELECT 1 FROM ledger n
              WHERE n.gcs_uri = l.gcs_uri AND n.processed_timestamp > l.processed_timestamp)"""
        ),
        "pending_files": _sql(
            f"""SELECT gcs_uri, {LOAD_ID} AS originating_filename,
              file_time AS estimated_file_time FROM waiting"""
        ),
        "new_files": _sql(
            f"""SELECT gcs_uri, {LOAD_ID} AS originating_filename,
              CAST(sum(strlen(data) + 1) AS BIGINT) AS length
            FROM marked WHERE NOT done GROUP BY gcs_uri"""
        ),
        "scan_lines": _sql("SELECT gcs_uri, data FROM lines"),
        "dedup_history": _sql(f"SELECT {BASE_COLUMNS} FROM fresh"),
        "dedup_within_batch": _sql(
            f"""SELECT {BASE_COLUMNS} FROM base QUALIFY row_number() OVER (
              PARTITION BY hash_fingerprint ORDER BY gcs_uri, load_time_dt) = 1"""
        ),
        "dedup_base": _sql(
            f"""SELECT {BASE_COLUMNS} FROM base QUALIFY row_number() OVER (
              PARTITION BY gcs_uri, hash_code ORDER BY load_time_dt) = 1"""
        ),
        "ingest_batch_ledger": _sql(f"SELECT {LEDGER_COLUMNS} FROM two_runs"),
        "ingest_batch_base": _sql(
            f"SELECT {BASE_COLUMNS} FROM loaded",
            stamped="""SELECT * REPLACE (CASE WHEN done THEN TIMESTAMP '2024-03-01 12:00:00'
              ELSE TIMESTAMP '2024-03-02 12:00:00' END AS run_ts) FROM good""",
            all_rows=_rows("stamped", _time(_field("EventDt"))),
            loaded="""SELECT * FROM all_rows WHERE file_no % 5 <> 0 OR hash_fingerprint NOT IN
              (SELECT hash_fingerprint FROM base)""",
        ),
        "ingest_archive": _sql(
            f"""SELECT data AS raw_json, done_at AS archived_timestamp, done_at AS process_dt,
              {LOAD_ID} AS originating_filename, gcs_uri
            FROM lines JOIN two_loads USING (gcs_uri) WHERE {NOT_BLANK}"""
        ),
        "run_summary": _sql(
            """SELECT 'ETL Complete' AS status, TIMESTAMP '2024-03-02 12:00:00' AS completed_at,
              count(*) AS files_processed, CAST(sum(have) AS BIGINT) AS rows_loaded_last_hour,
              CAST(sum(parsed - have) AS BIGINT) AS rows_already_loaded
            FROM (SELECT t.have, c.have AS parsed FROM two_loads t JOIN counts c USING (gcs_uri)
              WHERE NOT t.done)"""
        ),
        "reprocess_failed": _sql(
            STATE, **_files_after("status IN ('FAILED', 'PARTIAL')")
        ),
        "reprocess_file": _sql(
            STATE,
            **_files_after(
                "gcs_uri = (SELECT min(gcs_uri) FROM one_run WHERE status = 'PARTIAL')"
            ),
        ),
        "reprocess_range": _sql(
            """SELECT gcs_uri, want AS archive_rows, CASE WHEN done THEN have ELSE 0 END
                AS base_rows, CASE WHEN done THEN processed_timestamp END AS processed_timestamp,
              CASE WHEN done THEN rows_loaded END AS rows_loaded,
              CASE WHEN done THEN status END AS status
            FROM counts JOIN two_runs USING (gcs_uri) WHERE want > 0"""
        ),
        "full_reload": _sql(
            # Two archived copies of every line: the archive is never emptied.
            """SELECT gcs_uri, 2 * want AS archive_rows, have AS base_rows,
              TIMESTAMP '2024-03-03 12:00:00' AS processed_timestamp, have AS rows_loaded, status
            FROM counts JOIN one_run USING (gcs_uri) WHERE want > 0"""
        ),
        "deduplicate_base": _sql(
            """SELECT gcs_uri, count(DISTINCT hash_code) AS base_rows FROM rows
              GROUP BY gcs_uri"""
        ),
        "conformance": _sql(
            """SELECT f.gcs_uri, count(v.slot) AS lines,
              count(v.slot) FILTER (v.error IS NULL) AS ok, count(v.error) AS errors
            FROM files f LEFT JOIN verdict v USING (gcs_uri) GROUP BY f.gcs_uri""",
            verdict=VERDICT,
        ),
        "conformance_examples": _sql(
            """SELECT gcs_uri, line, error, CASE WHEN error IS NULL THEN cust_id END AS cust_id,
              CASE WHEN error IS NULL THEN event_dt END AS event_dt,
              CASE WHEN error IS NULL THEN filename END AS filename
            FROM verdict JOIN places USING (gcs_uri, slot)
            QUALIFY row_number() OVER (PARTITION BY gcs_uri ORDER BY line) <= 3""",
            verdict=VERDICT,
            places="""SELECT gcs_uri, slot,
              row_number() OVER (PARTITION BY gcs_uri ORDER BY slot) AS line FROM lines""",
        ),
        "conformance_report": _sql(
            """SELECT f.gcs_uri, count(v.slot) AS lines,
              count(v.slot) FILTER (v.error IS NULL) AS ok, count(v.error) AS errors,
              string_agg(concat(line, ' ', coalesce(error, concat_ws(' ', 'ok', cust_id, filename))),
                ';' ORDER BY line) FILTER (nth <= 3) AS first_lines
            FROM files f LEFT JOIN told v USING (gcs_uri) GROUP BY f.gcs_uri""",
            verdict=VERDICT,
            places="""SELECT gcs_uri, slot,
              row_number() OVER (PARTITION BY gcs_uri ORDER BY slot) AS line FROM lines""",
            told="""SELECT *, row_number() OVER (PARTITION BY gcs_uri ORDER BY line) AS nth
              FROM verdict JOIN places USING (gcs_uri, slot)""",
        ),
        "lookup_fingerprint": _sql(
            f"""SELECT {BASE_COLUMNS} FROM base
              WHERE hash_fingerprint = (SELECT max(hash_fingerprint) FROM base)"""
        ),
        "lookup_files": _sql(
            """SELECT gcs_uri, count(*) AS base_rows FROM base WHERE gcs_uri IN
              (SELECT DISTINCT gcs_uri FROM ledger WHERE status = 'PARTIAL' ORDER BY 1 LIMIT 3)
            GROUP BY gcs_uri"""
        ),
        "clustered_base": _sql(
            f"""SELECT {BASE_COLUMNS} FROM base JOIN
              (SELECT source, cust_id FROM base GROUP BY ALL
               ORDER BY count(*) DESC, source NULLS FIRST, cust_id NULLS FIRST LIMIT 1)
              USING (source, cust_id)"""
        ),
        "added_column": _sql(
            """SELECT gcs_uri, status, NULL::VARCHAR AS reviewed_by FROM ledger UNION ALL
            SELECT gcs_uri, 'FAILED', 'night shift' FROM waiting"""
        ),
        "refused_nulls": _sql(f"SELECT {LEDGER_COLUMNS} FROM ledger"),
        "millis_to_instants": "SELECT event_id, date_trunc('millisecond', ts) AS event_time FROM events",
        "append_snapshots": _sql("SELECT * FROM snapshot", **TWO_SNAPSHOTS),
        "alert_after_snapshots": _sql(
            """SELECT 'before' AS asked, 'NO_ROWS' AS status, NULL::VARCHAR AS details UNION ALL
            (SELECT 'after', status, details FROM snapshot ORDER BY check_time DESC LIMIT 1)""",
            **TWO_SNAPSHOTS,
        ),
        "storage_growth": _sql(
            """SELECT 'base' AS table_name, count(*) AS row_count, true AS has_size,
              true AS has_files FROM base
            UNION ALL SELECT 'archive', count(*), true, true FROM archive
            UNION ALL SELECT 'ledger', count(*), true, true FROM ledger
            UNION ALL SELECT 'monitoring', 0, true, false"""
        ),
        "ingest_late_events": _sql(
            """SELECT gcs_uri, CAST(CAST(event_dt AS DATE) AS VARCHAR) AS event_date, count(*) AS n
            FROM rows WHERE file_no % 5 = 0 OR hash_fingerprint NOT IN
              (SELECT hash_fingerprint FROM rows WHERE file_no % 5 = 0)
            GROUP BY ALL"""
        ),
        "r01_pipeline_status": _sql(
            f"""SELECT 'Pipeline Status - Last 24 Hours' AS report, count(*) AS total_files,
              {STATUS_COUNTS}, CAST(sum(rows_loaded) AS BIGINT) AS total_rows_loaded,
              CAST(sum(parse_errors) AS BIGINT) AS total_parse_errors,
              avg(rows_loaded) AS avg_rows_per_file FROM day"""
        ),
        "r02_pending_count": _sql(
            "SELECT 'Unprocessed Files' AS report, count(*) AS pending_files FROM waiting"
        ),
        "r03_recent_files": _sql(
            f"""SELECT originating_filename, processed_timestamp, rows_loaded, rows_expected,
              parse_errors, status, {_minutes('processed_timestamp', 'now')} AS minutes_ago
            FROM ledger, clock ORDER BY processed_timestamp DESC, gcs_uri LIMIT 10"""
        ),
        "r03_last_loads": _sql(
            """SELECT gcs_uri, rows_loaded, status, processed_timestamp FROM ledger
            ORDER BY processed_timestamp DESC, gcs_uri LIMIT 5"""
        ),
        "r04_files_with_errors": _sql(
            f"""SELECT 'Files With Parse Errors' AS report, {LEDGER_COLUMNS} FROM ledger
            WHERE NOT (status = 'SUCCESS' AND parse_errors = 0)
            ORDER BY processed_timestamp DESC, gcs_uri LIMIT 50"""
        ),
        "r05_row_reconciliation": _sql(
            """SELECT 'Row Count Validation' AS check_name, max(l.rows_expected) AS expected_rows,
              max(l.rows_loaded) AS tracked_rows, max(l.parse_errors) AS parse_errors,
              (SELECT count(*) FROM base JOIN one USING (gcs_uri)) AS base_table_rows,
              (SELECT count(*) FROM archive JOIN one USING (gcs_uri)) AS archive_rows
            FROM ledger l JOIN one USING (gcs_uri)""",
            one="SELECT max(gcs_uri) AS gcs_uri FROM ledger WHERE status = 'PARTIAL'",
        ),
        "r06_null_check": _sql(
            """SELECT 'Null Value Check' AS check_name, count(*) AS total_rows,
              count(*) - count(load_time_dt) AS null_load_time,
              count(*) - count(originating_filename) AS null_filename,
              count(*) - count(event_dt) AS null_event_dt,
              count(*) - count(source) AS null_source, count(*) - count(action) AS null_action
            FROM base_day"""
        ),
        "r07_cast_failures": _sql(
            """SELECT 'Parse Error Check' AS check_name, count(*) AS total_rows,
              count(*) FILTER (bytes IS NULL AND contains(raw_data, 'Bytes'))
                AS possible_bytes_parse_errors,
              count(*) FILTER (cust_id IS NULL AND contains(raw_data, 'CustId'))
                AS possible_custid_parse_errors,
              count(*) FILTER (hash_code IS NULL AND contains(raw_data, 'HashCode'))
                AS possible_hash_parse_errors FROM base_day"""
        ),
        "r08_duplicate_files": _sql(
            """SELECT 'Duplicate File Check' AS check_name, gcs_uri, count(*) AS times_processed
            FROM ledger GROUP BY ALL HAVING times_processed > 1
            ORDER BY times_processed DESC, gcs_uri LIMIT 10"""
        ),
        "r09_duplicate_rows": _sql(
            """SELECT 'Duplicate Row Check (by hash)' AS check_name,
              hash_fingerprint AS dedupe_key, count(*) AS occurrences FROM base_day
            GROUP BY ALL HAVING occurrences > 1 ORDER BY occurrences DESC, dedupe_key LIMIT 20"""
        ),
        "r10_daily_volume": _sql(
            """SELECT CAST(CAST(processed_timestamp AS DATE) AS VARCHAR) AS processing_date,
              count(*) AS files_processed, CAST(sum(rows_loaded) AS BIGINT) AS total_rows,
              avg(rows_loaded) AS avg_rows_per_file, min(rows_loaded) AS min_rows,
              max(rows_loaded) AS max_rows
            FROM ledger GROUP BY 1 ORDER BY 1 DESC LIMIT 30"""
        ),
        "r11_hourly_distribution": _sql(
            """SELECT CAST(hour(processed_timestamp) AS INTEGER) AS hour_of_day,
              count(*) AS files_processed, CAST(sum(rows_loaded) AS BIGINT) AS total_rows
            FROM ledger, clock WHERE processed_timestamp >= now - INTERVAL 7 DAYS
            GROUP BY 1 ORDER BY 1"""
        ),
        "r12_source_volume": _sql(
            """SELECT source, count(*) AS event_count,
              count(DISTINCT CAST(event_dt AS DATE)) AS active_days,
              min(event_dt) AS first_event, max(event_dt) AS last_event
            FROM base_week GROUP BY source ORDER BY event_count DESC, source"""
        ),
        "r13_user_mix": _sql(
            """SELECT 'User Type Distribution' AS check_name,
              count(*) FILTER (cust_id > 0) AS customer_events,
              count(partner_name) FILTER (cust_id = 0) AS partner_events,
              count(*) FILTER (cust_id = 0 AND partner_name IS NULL) AS unknown_events,
              count(DISTINCT cust_id) FILTER (cust_id > 0) AS unique_customers,
              count(DISTINCT partner_name) AS unique_partners FROM base_week"""
        ),
        "r14_action_mix": _sql(
            """SELECT action, event_count, round(event_count * 100.0::DOUBLE
                / (SELECT count(*) FROM base_week), 2) AS percentage
            FROM (SELECT action, count(*) AS event_count FROM base_week GROUP BY action)"""
        ),
        "r15_latest_events": _sql(
            """SELECT event_dt, source, user_name, cust_id, partner_name, action, filename, bytes,
              server_response FROM base
            ORDER BY event_dt DESC NULLS LAST, hash_fingerprint, gcs_uri, action, session_id
            LIMIT 20"""
        ),
        "r16_archive_completeness": _sql(
            """SELECT 'Archive vs Base Comparison' AS check_name,
              (SELECT count(DISTINCT gcs_uri) FROM base) AS base_files,
              (SELECT count(DISTINCT gcs_uri) FROM archive) AS archive_files,
              (SELECT count(*) FROM base) AS base_rows,
              (SELECT count(*) FROM archive) AS archive_rows"""
        ),
        "r17_archive_validity": _sql(
            """SELECT originating_filename, json_valid(raw_json) AS is_valid_json,
              left(raw_json, 100) AS json_preview FROM archive
            ORDER BY archived_timestamp DESC, gcs_uri, raw_json LIMIT 10"""
        ),
        "r18_heartbeat": _sql(
            """SELECT (SELECT now FROM clock) AS check_time, done AS files_processed_last_hour,
              pending AS files_pending,
              CASE WHEN done = 0 AND pending > 0 THEN 'ALERT: Pipeline may be stuck!'
                ELSE 'OK' END AS status
            FROM (SELECT count(*) FILTER (processed_timestamp >= now - INTERVAL 1 HOUR) AS done,
                (SELECT count(*) FROM waiting) AS pending FROM ledger, clock)"""
        ),
        "r19_processing_latency": _sql(
            """SELECT (SELECT now FROM clock) AS check_time, avg(d) AS avg_latency_minutes, max(d) AS max_latency_minutes,
              count(*) FILTER (d > 15) AS files_over_15min,
              CASE WHEN max(d) > 15 THEN 'WARNING: High latency detected' ELSE 'OK' END AS status
            FROM delays""",
            delays=f"""SELECT {_minutes(FILE_TIME, 'processed_timestamp')} AS d FROM day""",
        ),
        "r20_error_rate": _sql(
            f"""SELECT (SELECT now FROM clock) AS check_time, count(*) AS total_processed_24h, {STATUS_COUNTS},
              round(100.0 * count(*) FILTER (status <> 'SUCCESS') / nullif(count(*), 0), 2)
                AS error_rate_pct,
              CASE WHEN avg(CASE WHEN status = 'SUCCESS' THEN 0 ELSE 1 END) > 0.05
                THEN 'ALERT: Error rate exceeds 5%!' ELSE 'OK' END AS status
            FROM day"""
        ),
        "r21_volume_anomaly": _sql(
            """SELECT now AS check_time, CAST(d.day AS VARCHAR) AS processing_date, d.n AS today_rows,
              mean AS avg_daily_rows, round(abs(d.n - mean) / mean * 100, 2) AS pct_deviation,
              CASE WHEN abs(d.n - mean) > 0.5 * mean THEN 'WARNING: Unusual volume'
                ELSE 'OK' END AS status
            FROM days d, (SELECT avg(n) AS mean FROM days, clock WHERE day < CAST(now AS DATE)),
              clock
            WHERE d.day = CAST(now AS DATE)""",
            days="""SELECT CAST(processed_timestamp AS DATE) AS day,
                CAST(sum(rows_loaded) AS BIGINT) AS n
              FROM ledger, clock WHERE processed_timestamp >= now - INTERVAL 8 DAYS GROUP BY 1""",
        ),
        "r21_volume_statistics": _sql(
            """SELECT avg(n) AS avg_daily_rows, round(stddev_samp(n), 6) AS stddev_rows
            FROM days, clock WHERE day < CAST(now AS DATE)""",
            days="""SELECT CAST(processed_timestamp AS DATE) AS day,
                CAST(sum(rows_loaded) AS BIGINT) AS n
              FROM ledger, clock WHERE processed_timestamp >= now - INTERVAL 8 DAYS GROUP BY 1""",
        ),
        "r22_stale_files": _sql(
            """SELECT (SELECT now FROM clock) AS check_time, count(*) FILTER (age > 30) AS stale_file_count,
              count(*) AS pending_count, max(age) AS oldest_pending_minutes,
              (SELECT string_agg(gcs_uri, ',' ORDER BY file_time, gcs_uri) FROM
                (SELECT * FROM waiting ORDER BY file_time, gcs_uri LIMIT 5)) AS sample_stale_files,
              CASE WHEN max(age) > 30 THEN 'ALERT: Stale files detected!' ELSE 'OK' END AS status
            FROM (SELECT date_sub('minute', file_time, now) AS age FROM waiting, clock)"""
        ),
        "r24_dashboard": _sql(
            """SELECT 'Pipeline Health Dashboard' AS report, now AS generated_at,
              files AS files_24h, loaded AS rows_24h, pending AS pending_files, bad AS errors_24h,
              newest AS last_processed,
              CASE WHEN hour_files = 0 AND pending > 0 THEN '🔴 CRITICAL: Pipeline appears stuck'
                WHEN bad > files * 0.05 THEN '🟡 WARNING: High error rate'
                ELSE '🟢 HEALTHY' END AS overall_status
            FROM (SELECT now,
              (SELECT count(*) FROM ledger WHERE processed_timestamp >= now - INTERVAL 1 HOUR)
                AS hour_files,
              (SELECT count(*) FROM day) AS files,
              (SELECT CAST(sum(rows_loaded) AS BIGINT) FROM day) AS loaded,
              (SELECT count(*) FROM day WHERE status <> 'SUCCESS') AS bad,
              (SELECT count(*) FROM waiting) AS pending,
              (SELECT max(processed_timestamp) FROM ledger) AS newest FROM clock)"""
        ),
        "r25_monitoring_snapshot": _sql("SELECT * FROM snapshot", **SNAPSHOT_PARTS),
        "r26_latest_alert": _sql("SELECT status, details FROM snapshot", **SNAPSHOT_PARTS),
        "r27_metric_table": _sql(
            """SELECT 'Files Processed' AS metric, count(*) AS value FROM ledger UNION ALL
            SELECT 'Rows in Base Table', count(*) FROM base UNION ALL
            SELECT 'Rows in Archive', count(*) FROM archive"""
        ),
        "r28_file_visibility": _sql("SELECT gcs_uri, line_count AS row_count FROM files"),
        "r29_unfinished_files": _sql(
            """SELECT gcs_uri, processed_timestamp, status, error_message FROM ledger
            WHERE status <> 'SUCCESS'"""
        ),
        "r30_file_state": _sql(
            """SELECT gcs_uri, processed_timestamp, rows_loaded, status FROM ledger
            WHERE gcs_uri = (SELECT max(gcs_uri) FROM ledger WHERE status = 'PARTIAL')"""
        ),
        "r30_files_in_range": _sql(
            """SELECT gcs_uri, processed_timestamp, rows_loaded, status FROM ledger, clock
            WHERE processed_timestamp >= date_trunc('day', now) - INTERVAL 3 DAYS
              AND processed_timestamp <= date_trunc('day', now) - INTERVAL 1 DAY"""
        ),
        "r31_reload_preview": _sql(
            """SELECT 'FULL RELOAD WARNING' AS warning, count(*) AS files_to_reprocess,
              CAST(sum(rows_loaded) AS BIGINT) AS rows_to_delete FROM ledger"""
        ),
        "r32_duplicate_ledger": _sql(
            """SELECT gcs_uri, count(*) AS times_processed,
              string_agg(strftime(processed_timestamp, '%Y-%m-%d %H:%M:%S'), ','
                ORDER BY processed_timestamp) AS processing_times
            FROM ledger GROUP BY gcs_uri HAVING count(*) > 1"""
        ),
    }
    q["dedup_history_any_date"] = q["dedup_history"]
    q["ingest_batch_waves"] = q["ingest_batch_ledger"]
    for name in ("ingest_stream_ledger", "ingest_stream_small_triggers", "ingest_again", "ingest_stream_trigger"):
        q[name] = q["ingest_batch_ledger"]
    columns = LEDGER_COLUMNS.replace("processed_timestamp, ", "")
    q["ingest_after_failure"] = _sql(f"SELECT {columns} FROM two_runs")
    q["ingest_stream_base"] = q["ingest_batch_base"]
    q["ingest_stream_archive"] = q["ingest_archive"]
    q["ingest_batch_waves_within_batch"] = _sql(
        f"SELECT {LEDGER_COLUMNS} FROM ({_ledger('SELECT * FROM once_loads')})",
        once="""SELECT *, hash_fingerprint IS NULL OR row_number() OVER (
          PARTITION BY file_no % 5 = 0, hash_fingerprint ORDER BY gcs_uri) = 1 AS first FROM rows""",
        once_kept="""SELECT * FROM once WHERE first AND (file_no % 5 <> 0 OR hash_fingerprint IS NULL
          OR hash_fingerprint NOT IN (SELECT hash_fingerprint FROM base))""",
        once_loads="""SELECT gcs_uri, CASE WHEN done THEN TIMESTAMP '2024-03-01 12:00:00'
            ELSE TIMESTAMP '2024-03-02 12:00:00' END AS done_at, want, coalesce(n, 0) AS have
          FROM counts LEFT JOIN (SELECT gcs_uri, count(*) AS n FROM once_kept GROUP BY 1)
          USING (gcs_uri)""",
    )
    q["new_file_count"] = _sql(
        """SELECT count(*) AS new_files_to_process, TIMESTAMP '2024-03-02 12:00:00' AS run_timestamp
        FROM waiting"""
    )
    q["failure_ledger_rows"] = _sql(
        f"""SELECT gcs_uri, {LOAD_ID} AS originating_filename,
          TIMESTAMP '2024-03-02 12:00:00' AS processed_timestamp, 0 AS rows_loaded,
          want AS rows_expected, want AS parse_errors, 'FAILED' AS status,
          'disk full' AS error_message
        FROM counts WHERE NOT done"""
    )
    q["stored_tables"] = _sql(
        """SELECT table_name, 'BASE TABLE' AS table_type, row_count, true AS has_size FROM (
          SELECT 'base' AS table_name, count(*) AS row_count FROM base
          UNION ALL SELECT 'archive', count(*) FROM archive
          UNION ALL SELECT 'ledger', count(*) FROM ledger UNION ALL SELECT 'monitoring', 0)"""
    )
    q["drop_superseded_ledger"] = q["ledger_latest"]
    return q
