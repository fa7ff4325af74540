"""Writers that meet: what one commits while another works."""

from datetime import timedelta

import pytest
from conftest import NOW, name, record

from logledger.operators import ledger as lg
from logledger.options import VARIANTS
from logledger.plans import monitoring, reprocess
from logledger.plans.ingest import ingest_batch
from logledger.sources.files import shared_folder
from logledger.sources.warehouse import VersionConflict, Warehouse
from logledger.streaming.ingest_stream import load_micro_batch


def during_load(monkeypatch, action):
    """Runs the action in the middle of each load."""
    real = lg.ledger_rows

    def hooked(*args, **kwargs):
        action()
        return real(*args, **kwargs)

    monkeypatch.setattr(lg, "ledger_rows", hooked)


def test_a_health_check_does_not_disturb_a_load(spark, warehouse, folder, monkeypatch):
    folder.put(name("a"), [record(1)])
    during_load(
        monkeypatch, lambda: monitoring.record_snapshot(warehouse, folder.landing, NOW)
    )
    ingest_batch(warehouse, folder.landing, NOW, attempts=1)
    assert warehouse.read("base").count() == 1
    assert warehouse.read("monitoring").count() == 1


def test_a_load_of_other_files_and_dates_is_no_conflict(spark, warehouse, folder, tmp_path, monkeypatch):
    folder.put(name("a"), [record(1)])
    other = type(folder)(tmp_path / "other")
    other.put(name("b"), [record(2, EventDt="2026-01-20T10:00:00.000Z")])
    second = Warehouse(spark, warehouse.root)
    done = []

    def load_other():
        if not done:
            done.append(1)
            ingest_batch(second, other.landing, NOW, attempts=1)

    during_load(monkeypatch, load_other)
    ingest_batch(warehouse, folder.landing, NOW, attempts=1)
    assert warehouse.read("base").count() == 2 and warehouse.read("ledger").count() == 2


def test_a_ledger_row_added_during_a_clean_up_stays(spark, warehouse, folder, monkeypatch):
    folder.put(name("a"), [record(1)])
    ingest_batch(warehouse, folder.landing, NOW)
    row = warehouse.read("ledger")
    real = lg.latest_rows

    def hooked(ledger):
        warehouse.append("ledger", row, "meanwhile")
        return real(ledger)

    monkeypatch.setattr(lg, "latest_rows", hooked)
    with pytest.raises(VersionConflict):
        reprocess.drop_superseded_ledger_rows(warehouse)
    assert warehouse.read("ledger").count() == 2


def test_two_merges_at_once_double_nothing(spark, warehouse, folder, monkeypatch):
    for hour in range(3):
        monitoring.record_snapshot(warehouse, folder.landing, NOW + timedelta(hours=hour))
    based_on = warehouse.version()
    mine = warehouse.compact("monitoring", "m1", 0)
    theirs = warehouse.compact("monitoring", "m2", 0)
    warehouse.commit(theirs, based_on=based_on)
    with pytest.raises(VersionConflict):
        warehouse.commit(mine, based_on=based_on)
    with pytest.raises(VersionConflict):
        warehouse.commit(mine)
    assert warehouse.read("monitoring").count() == 3


def test_streams_of_equal_epochs_share_nothing(spark, warehouse, folder, tmp_path, monkeypatch):
    folder.put(name("a"), [record(1)])
    other = type(folder)(tmp_path / "other")
    other.put(name("b"), [record(2)])
    loads = [load_micro_batch(warehouse, VARIANTS["default"], lambda: NOW) for _ in range(2)]
    done = []

    def interleave():
        if not done:
            done.append(1)
            loads[1](other.landing.lines(spark), 0)

    during_load(monkeypatch, interleave)
    loads[0](folder.landing.lines(spark), 0)
    found = {r.status for r in warehouse.read("ledger").collect()}
    assert found == {"SUCCESS"} and warehouse.read("base").count() == 2
    assert not warehouse.files.children(f"{warehouse.root}/_runs")


def test_an_empty_newest_version_file_counts_for_nothing(spark, warehouse, folder):
    folder.put(name("a"), [record(1)])
    ingest_batch(warehouse, folder.landing, NOW)
    newest = warehouse.version()
    path = warehouse.root.removeprefix("file:") + f"/_versions/{newest + 1:012d}"
    open(path, "w").close()
    again = Warehouse(spark, warehouse.root)
    assert again.version() == newest and again.read("base").count() == 1
    again.truncation("ledger")
    assert again.commit(again.truncation("ledger")) == newest + 1


def test_a_version_file_is_never_overwritten(warehouse):
    path = f"{warehouse.root}/_versions/{warehouse.version():012d}"
    before = warehouse.files.read(path)
    assert not warehouse.files.create(path, "{}")
    assert warehouse.files.read(path) == before


def test_clean_removes_what_no_version_lists(spark, warehouse, folder):
    folder.put(name("a"), [record(1)])
    ingest_batch(warehouse, folder.landing, NOW)
    warehouse.stage("ledger", warehouse.read("ledger"), "orphan")
    assert warehouse.clean(min_age_hours=1) == 0
    assert warehouse.clean(keep_versions=1, min_age_hours=-1) == 1
    assert warehouse.read("base").count() == 1 and warehouse.read("ledger").count() == 1


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        shared_folder(Session(), "x")


@pytest.mark.parametrize("per_wave", [1, 2, 100])
def test_one_copy_per_run_however_the_backlog_is_cut(spark, warehouse, folder, per_wave):
    from dataclasses import replace

    from logledger.options import IngestOptions

    for i in range(4):
        folder.put(name(i), [record(k) for k in range(3)])
    landing = replace(folder.landing, files_per_wave=per_wave)
    ingest_batch(warehouse, landing, NOW, IngestOptions(within_batch=True))
    loaded = [r.rows_loaded for r in warehouse.read("ledger").orderBy("gcs_uri").collect()]
    assert loaded == [3, 0, 0, 0]
