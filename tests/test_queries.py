"""Every query that only reads, against its SQL on the smallest tables; and its plan. The
queries that load files into tables of their own are covered by the ingestion tests and by
``check.py``, which compares all."""

import io
from contextlib import redirect_stdout
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import _rows
from workload.oracle import all_sql
from workload.queries import all_queries

SMALL = "/root/testdata/sf0.001"
LOADING = {
    "ingest_batch_base",
    "ingest_batch_waves",
    "ingest_batch_waves_within_batch",
    "ingest_again",
    "ingest_archive",
    "run_summary",
    "ingest_stream_ledger",
    "ingest_stream_small_triggers",
    "ingest_stream_base",
    "ingest_stream_archive",
    "reprocess_failed",
    "reprocess_range",
    "reprocess_file",
    "full_reload",
    "deduplicate_base",
    "drop_superseded_ledger",
    "ingest_stream_trigger",
    "ingest_late_events",
    "clustered_base",
}
READING = [q for q in all_queries() if q not in LOADING]

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_all_queries_have_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_sql()) <= set(all_queries()) <= set(entry_module.queries())
    assert set(all_sql()) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["action", "event_count", "percentage"] and frame.count() > 0


@pytest.mark.parametrize("name", READING)
def test_query(spark, db, name):
    frame = all_queries()[name](spark, SMALL)
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain()
    assert "CartesianProduct" not in text.getvalue()
    assert "BroadcastNestedLoopJoin" not in text.getvalue()
    assert "BatchEvalPython" not in text.getvalue() and "ArrowEvalPython" not in text.getvalue()
    mine = frame.toPandas()
    if name in all_sql():
        theirs = db.sql(all_sql()[name]).df()
        assert sorted(mine.columns) == sorted(theirs.columns)
        assert _rows(mine) == _rows(theirs)


def test_lines_are_made_once_for_tables_and_reports(spark, monkeypatch, tmp_path):
    """Tables, their files and what is pending come from one making of the lines."""
    from workload import fixture
    from workload.queries import stored

    made, make = [], fixture.raw_lines
    monkeypatch.setattr(fixture, "raw_lines", lambda *a: made.append(1) or make(*a))
    (tmp_path / "events.parquet").write_bytes(Path(f"{SMALL}/events.parquet").read_bytes())
    tables = stored(spark, str(tmp_path))
    assert tables.lines.filter("file_no % 5 = 0").count() > 0
    fixture.build_tables(spark, str(tmp_path))
    assert len(made) == 1


def test_files_are_written_whole_into_their_parts(spark, tmp_path):
    from workload import fixture

    rows = [(i // 3, i, f"mem://b/logs/f-{i // 3}.json", f"line {i}") for i in range(30)]
    lines = spark.createDataFrame(rows[::-1], "file_no bigint, slot bigint, gcs_uri string, data string")
    part = fixture.F.when(fixture.is_processed(), "history").otherwise("pending")
    assert fixture.write_files(lines.repartition(4), str(tmp_path), part) == 10
    found = {p.relative_to(tmp_path): p.read_text() for p in tmp_path.rglob("*.json")}
    expected = {
        Path("history" if f % 5 else "pending", "logs", f"f-{f}.json"):
            "".join(f"line {i}\n" for i in range(3 * f, 3 * f + 3)) for f in range(10)
    }
    assert found == expected
