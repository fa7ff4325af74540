from datetime import timedelta

import pytest
from conftest import NOW, name, record, rows

from logledger.options import VARIANTS
from logledger.plans import ingest
from logledger.plans.ingest import ingest_batch
from logledger.sources.landing import Landing
from logledger.sources.warehouse import Warehouse
from logledger.streaming import ingest_stream
from logledger.streaming.ingest_stream import load_micro_batch, run_scheduled, start_stream

COLUMNS = ["gcs_uri", "rows_expected", "rows_loaded", "status", "error_message"]


def clock():
    return NOW


def test_a_stream_loads_what_a_batch_loads(spark, folder, tmp_path):
    streamed = Warehouse(spark, f"file:{tmp_path}/streamed").create()
    batched = Warehouse(spark, f"file:{tmp_path}/batched").create()
    check = f"file:{tmp_path}/check"
    for step, files in enumerate(([("a", [record(1), "x"]), ("b", ["  "])], [("c", [record(1), record(2)])])):
        for key, lines in files:
            folder.put(name(key), lines)
        now = NOW + timedelta(hours=step)
        run_scheduled(streamed, folder.landing, check, clock=lambda now=now: now)
        ingest_batch(batched, folder.landing, now)
        for table, columns in (("ledger", COLUMNS), ("base", []), ("archive", [])):
            assert rows(streamed.read(table), *columns) == rows(batched.read(table), *columns)
    assert streamed.read("ledger").count() == 3


def test_files_arrive_in_several_triggers(spark, warehouse, folder, tmp_path):
    for i in range(5):
        folder.put(name(i), [record(i), record(i + 100)])
    found = run_scheduled(
        warehouse, folder.landing, f"file:{tmp_path}/check", clock=clock, files_per_trigger=2
    )
    assert found.count() == 5 and warehouse.read("base").count() == 10
    assert len(warehouse.folders("ledger")) == 3


def test_a_stream_and_batches_share_the_ledger(spark, warehouse, folder, tmp_path):
    folder.put(name("a"), [record(1)])
    ingest_batch(warehouse, folder.landing, NOW)
    folder.put(name("b"), [record(2)])
    run_scheduled(warehouse, folder.landing, f"file:{tmp_path}/check", clock=clock)
    ingest_batch(warehouse, folder.landing, NOW)
    assert warehouse.read("ledger").count() == 2 and warehouse.read("archive").count() == 2


def test_a_repeated_micro_batch_adds_nothing(spark, warehouse, folder):
    folder.put(name("a"), [record(1)])
    load = load_micro_batch(warehouse, VARIANTS["default"], clock)
    for _ in range(2):
        load(folder.landing.lines(spark), 0)
    assert [warehouse.read(t).count() for t in ("base", "archive", "ledger")] == [1, 1, 1]


def test_a_running_stream_picks_up_new_files(spark, warehouse, folder, tmp_path):
    query = start_stream(
        warehouse, folder.landing, f"file:{tmp_path}/check", clock=clock, every="1 second"
    )
    try:
        folder.put(name("a"), [record(1)])
        query.processAllAvailable()
        folder.put(name("b"), [record(2)])
        query.processAllAvailable()
        assert warehouse.read("ledger").count() == 2
    finally:
        query.stop()


def test_a_failed_micro_batch_is_recorded_and_not_retried(
    spark, warehouse, folder, tmp_path, monkeypatch
):
    folder.put(name("a"), [record(1)])

    def fail(*args, **more):
        raise RuntimeError("broken")

    monkeypatch.setattr(ingest, "parse_lines", fail)
    check, options = f"file:{tmp_path}/check", VARIANTS["per_file"]
    with pytest.raises(Exception, match="broken"):
        run_scheduled(warehouse, folder.landing, check, options, clock)
    monkeypatch.undo()
    found = run_scheduled(warehouse, folder.landing, check, options, clock).collect()
    assert [(r.status, r.error_message) for r in found] == [("FAILED", "broken")]


def test_copies_that_come_after_a_broken_scheduled_run_are_history(
    spark, warehouse, folder, tmp_path, monkeypatch
):
    folder.put(name("a"), [record(1), record(2)])
    folder.put(name("b"), [record(3), record(4)])
    load, calls, check = ingest.load_files, [], f"file:{tmp_path}/check"

    def failing(*args, **more):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return load(*args, **more)

    monkeypatch.setattr(ingest_stream, "load_files", failing)
    with pytest.raises(Exception, match="lost"):
        run_scheduled(warehouse, folder.landing, check, clock=clock, files_per_trigger=1)
    assert warehouse.read("base").count() == 2
    folder.put(name("c"), [record(1), record(2), record(3), record(4)])
    later = NOW + timedelta(days=1)
    found = run_scheduled(warehouse, folder.landing, check, clock=lambda: later, files_per_trigger=1)
    assert sorted(r.rows_loaded for r in found.collect()) == [0, 2, 2]
    assert warehouse.read("base").count() == 4
    assert not warehouse.files.children(f"{warehouse.root}/_runs")


def test_late_events_land_in_their_own_date(spark, warehouse, folder, tmp_path):
    folder.put(name("a"), [record(1, EventDt="2019-05-05T00:00:00Z"), record(2)])
    run_scheduled(warehouse, folder.landing, f"file:{tmp_path}/check", clock=clock)
    assert sorted(f.split("event_date=")[1] for f in warehouse.folders("base")) == [
        "2019-05-05",
        "2026-01-28",
    ]


def test_a_stream_reads_one_path(spark):
    with pytest.raises(ValueError):
        Landing(("a", "b")).stream(spark)


def test_many_triggers_of_a_scheduled_run_take_few_loads(
    spark, warehouse, folder, tmp_path, monkeypatch
):
    for i in range(16):
        folder.put(name(f"{i:02}"), [record(i), record(i + 100)])
    folder.put(name("blank"), [" "])
    load, calls, check = ingest.load_files, [], f"file:{tmp_path}/check"

    def failing(*args, **more):
        calls.append(args[1].count())
        if len(calls) == 3:
            raise RuntimeError("lost")
        return load(*args, **more)

    monkeypatch.setattr(ingest_stream, "load_files", failing)
    with pytest.raises(Exception, match="lost"):
        run_scheduled(warehouse, folder.landing, check, clock=clock, files_per_trigger=1)
    assert calls == [2, 2, 2] and warehouse.read("ledger").count() == 4
    # Noted by a trigger that is done, but neither listed when the run began nor loaded.
    run = warehouse.files.children(f"{warehouse.root}/_runs")[0]
    folder.put(name("late"), [record(500)])
    listed = folder.landing.files(spark).filter("gcs_uri LIKE '%late%'")
    ingest.dedup.stored(listed, f"{warehouse.root}/_runs/{run}/{ingest.ARRIVED}/99")
    found = run_scheduled(warehouse, folder.landing, check, clock=clock, files_per_trigger=1)
    assert sorted(r.rows_loaded for r in found.collect()) == [0, 1] + [2] * 16
    assert [warehouse.read(t).count() for t in ("base", "archive")] == [33, 33]
    assert len(warehouse.folders("ledger")) == 3
    assert not warehouse.files.children(f"{warehouse.root}/_runs")
