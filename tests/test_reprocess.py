from datetime import timedelta

import pytest
from conftest import NOW, name, record, rows
from pyspark.sql import functions as F

from logledger.plans import reprocess as rp
from logledger.plans.ingest import ingest_batch
from logledger.sources.warehouse import Warehouse

CUT = '{"UserName":"cut off'
LATER = NOW + timedelta(hours=5)


@pytest.fixture
def loaded(warehouse, folder):
    folder.put(name("good"), [record(1), record(2)])
    folder.put(name("part"), [record(3), CUT])
    ingest_batch(warehouse, folder.landing, NOW)
    folder.put(name("none"), [CUT])
    folder.put(name("late"), [record(4)])
    ingest_batch(warehouse, folder.landing, NOW + timedelta(hours=1))
    return warehouse


def files(frame):
    return sorted({r.gcs_uri.rsplit("-", 1)[-1].split(".")[0] for r in frame.collect()})


def sizes(warehouse):
    return tuple(warehouse.read(t).count() for t in ("base", "archive", "ledger"))


def test_one_file(loaded, folder):
    uri = loaded.read("ledger").filter("gcs_uri like '%good%'").first().gcs_uri
    rp.reprocess_file(loaded, uri)
    assert sizes(loaded) == (2, 6, 3)
    ingest_batch(loaded, folder.landing, LATER)
    assert sizes(loaded) == (4, 8, 4)


def test_unfinished_files(loaded, folder):
    rp.reprocess_unfinished(loaded)
    assert files(loaded.read("ledger")) == ["good", "late"]
    assert files(loaded.read("base")) == ["good", "late"]
    folder.put(name("part"), [record(3), record(5)])
    ingest_batch(loaded, folder.landing, LATER)
    found = loaded.read("ledger").filter("gcs_uri like '%part%'").first()
    assert (found.status, found.rows_loaded, found.processed_timestamp) == ("SUCCESS", 2, LATER)


def test_a_time_range_includes_both_ends(loaded):
    rp.reprocess_range(loaded, NOW, NOW)
    assert files(loaded.read("ledger")) == ["late", "none"]
    assert files(loaded.read("base")) == ["late"]
    assert sizes(loaded)[1] == 6


def test_full_reload(loaded, folder):
    before = rows(loaded.read("base").drop("load_time_dt"))
    rp.full_reload(loaded)
    assert sizes(loaded) == (0, 6, 0)
    ingest_batch(loaded, folder.landing, LATER)
    assert rows(loaded.read("base").drop("load_time_dt")) == before and sizes(loaded)[2] == 4


def test_a_file_with_several_ledger_rows_is_forgotten_as_a_whole(loaded, folder):
    again = loaded.read("ledger").filter("gcs_uri like '%part%'").withColumn("status", F.lit("SUCCESS"))
    loaded.append("ledger", again.withColumn("processed_timestamp", F.lit(LATER)), "again")
    rp.reprocess_range(loaded, LATER, LATER)
    ingest_batch(loaded, folder.landing, LATER)
    assert sizes(loaded)[0] == 4 and sizes(loaded)[2] == 4


def test_superseded_ledger_rows(loaded):
    newer = loaded.read("ledger").filter("gcs_uri like '%good%'")
    loaded.append("ledger", newer.withColumn("processed_timestamp", F.lit(LATER)), "again")
    rp.drop_superseded_ledger_rows(loaded)
    found = loaded.read("ledger").filter("gcs_uri like '%good%'").collect()
    assert [r.processed_timestamp for r in found] == [LATER] and sizes(loaded)[2] == 4


def test_deduplicate_base_writes_only_dates_with_copies(warehouse, folder):
    folder.put(name("a"), [record(1), record(1), record(2, EventDt="2026-01-01T00:00:00Z")])
    ingest_batch(warehouse, folder.landing, NOW)
    clean = [f for f in warehouse.folders("base") if "2026-01-01" in f]
    rp.deduplicate_base(warehouse)
    assert sizes(warehouse)[0] == 2
    assert set(clean) <= set(warehouse.folders("base"))
    version = warehouse.version()
    assert rp.deduplicate_base(warehouse) == version


def test_deduplicate_base_across_batches(spark, folder, tmp_path):
    w = Warehouse(spark, f"file:{tmp_path}/w").create()
    folder.put(name("a"), [record(1), record(2)])
    ingest_batch(w, folder.landing, NOW)
    later = w.read("base").withColumn("load_time_dt", F.lit(LATER))
    w.append("base", later, "copy")
    rp.deduplicate_base(w)
    assert rows(w.read("base"), "user_name", "load_time_dt") == [("10001", NOW), ("10002", NOW)]
