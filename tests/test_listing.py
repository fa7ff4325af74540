"""Landings of many files: what passes through the driver."""

from datetime import timedelta

import pytest
from conftest import NOW, name, record, rows

from logledger.plans.ingest import ingest_batch
from logledger.sources import landing as landing_module
from logledger.sources.files import FileSystem
from logledger.sources.landing import Landing
from logledger.streaming.ingest_stream import run_scheduled, start_stream

ODD = ["a b", "c%20d", "e#f", "g?h", "i+j", "k&l=m,n;@q$r!s'(t)*u~v", "w[1]", "x{y}", "z\\w", "é日本", " n"]
ODD += ["tab\tx", 'q"uote', "<lt>", "^|`", "emoji😀", "\u0085c", "=_x"]


def test_workers_list_what_spark_lists(spark, folder, monkeypatch):
    deep = folder.path / "deep er" / "_no"
    deep.mkdir(parents=True)
    (folder.path / "deep er" / "_k=1").mkdir()
    for odd in ODD:
        folder.put(f"{odd}.json", [record(1)])
        folder.put(f"deep er/_k=1/{odd}.json", [record(1), odd])
    for other in ("_hidden.json", ".hidden.json", "x.txt", "x.json._COPYING_", "deep er/_no/a.json"):
        folder.put(other, ["x"])
    (folder.path / "empty.json").touch()
    (folder.path / "link.json").symlink_to(folder.path / "a b.json")
    listed = folder.landing.files(spark)
    assert "binaryFile" not in listed._jdf.queryExecution().toString()
    found = rows(listed)
    monkeypatch.setattr(FileSystem, "mounted", lambda *_: None)
    assert found == rows(folder.landing.files(spark)) and len(found) == 2 * len(ODD) + 1


@pytest.mark.parametrize("form", ["%s", "file:%s", "file://%s", "%s/", "file://%s/logs/.."])
def test_a_file_has_one_name(spark, warehouse, folder, monkeypatch, form):
    """However the landing is named, its files are called in the ledger what lines call them."""
    folder.put("a b.json", [record(1), record(2)])
    landing = Landing((form % folder.path.parent,))
    ingest_batch(warehouse, landing, NOW)
    assert rows(warehouse.read("ledger"), "status", "rows_loaded") == [("SUCCESS", 2)]
    found = rows(landing.files(spark))
    monkeypatch.setattr(FileSystem, "mounted", lambda *_: None)
    assert found == rows(landing.files(spark))
    assert rows(warehouse.read("ledger"), "gcs_uri") == rows(warehouse.read("base"), "gcs_uri")[:1]


def test_a_load_reads_some_files_at_a_time(spark, warehouse, folder, monkeypatch):
    """One load, whatever the number of files; of its files no more than PART are in a plan."""
    monkeypatch.setattr(landing_module, "PART", 4)
    monkeypatch.setattr(landing_module, "NAMED", 3)
    for i in range(12):
        folder.put(name(f"{i:02}"), [record(i), record(i + 1)])
    read, lines_of = [], Landing._lines_of
    monkeypatch.setattr(
        Landing, "_lines_of", lambda self, names, paths, size: read.append(len(paths)) or lines_of(self, names, paths, size)
    )
    assert ingest_batch(warehouse, folder.landing, NOW).first().files_processed == 12
    assert sum(read) == 12 and max(read) < 12 and len(read) == 3
    assert [warehouse.read(t).count() for t in ("ledger", "base", "archive")] == [12, 24, 24]
    assert [len(warehouse.folders(t)) for t in ("ledger", "archive")] == [1, 1]


def test_files_that_went_meanwhile_have_no_lines(spark, folder):
    for i in range(3):
        folder.put(name(i), [record(i)])
    pending = folder.landing.files(spark).localCheckpoint()
    (folder.path / name(1)).unlink()
    (wave,) = folder.landing.waves(pending)
    assert wave.count == 3 and wave.lines.count() == 2


def test_a_stream_remembers_lists_of_files(spark, warehouse, folder, tmp_path):
    """Spark's file source kept each file; now it keeps a list for each trigger."""
    for i in range(10):
        folder.put(name(i), [record(i)])
    check = f"file:{tmp_path}/check"
    run_scheduled(warehouse, folder.landing, check, clock=lambda: NOW, files_per_trigger=5)
    log = tmp_path / "check" / "sources" / "0"
    seen = "".join(f.read_text() for f in log.iterdir() if f.name[0].isdigit())
    assert seen.count('"path"') == 2 and "LOG-TEST" not in seen
    folder.put(name("late"), [record(50)])
    later = NOW + timedelta(hours=1)
    found = run_scheduled(warehouse, folder.landing, check, clock=lambda: later, files_per_trigger=5)
    assert found.count() == 11 and warehouse.read("base").count() == 11


def test_a_stream_that_stops_lists_first(spark, warehouse, folder, tmp_path):
    for i in range(3):
        folder.put(name(i), [record(i), record(i + 10)])
    query = start_stream(warehouse, folder.landing, f"file:{tmp_path}/check", clock=lambda: NOW, every=None)
    query.awaitTermination()
    assert [warehouse.read(t).count() for t in ("ledger", "base")] == [3, 6]
