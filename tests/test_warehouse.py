from datetime import date, datetime

import pytest
from conftest import lines_frame, record, rows
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from logledger.operators import lines as ln
from logledger.sources.warehouse import VersionConflict, Warehouse

RUN = datetime(2026, 1, 28, 12)


def parsed(spark, numbers, uri="x/a.json", **changes):
    texts = [record(n, **changes) for n in numbers]
    return ln.parse_lines(lines_frame(spark, texts, uri), RUN)


def users(frame):
    return sorted(int(r.user_name) - 10000 for r in frame.collect())


def test_create_twice_is_harmless(spark, warehouse):
    warehouse.append("base", parsed(spark, [1]), "b1")
    version = warehouse.version()
    again = Warehouse(spark, warehouse.root).create()
    assert again.version() == version and users(again.read("base")) == [1]


def test_empty_tables_have_their_columns(warehouse):
    assert warehouse.read("base").count() == 0
    assert warehouse.read("base").columns[-1] == "event_date"
    assert warehouse.read("ledger").columns[0] == "gcs_uri"


def test_rows_lie_below_their_date_and_null_dates_are_kept(spark, warehouse):
    rows_ = parsed(spark, [1]).union(parsed(spark, [2], EventDt="2025-12-31T23:59:59Z"))
    warehouse.append("base", rows_.union(parsed(spark, [3], EventDt="bad")), "b1")
    assert rows(warehouse.read("base"), "user_name", "event_date") == [
        ("10001", date(2026, 1, 28)),
        ("10002", date(2025, 12, 31)),
        ("10003", None),
    ]
    assert users(warehouse.read("base", ["2025-12-31"])) == [2]


def test_files_are_sorted_by_source_and_customer(spark, warehouse):
    texts = [record(i, Source=f"S{i % 3}", CustId=50 - i) for i in range(50)]
    warehouse.append("base", ln.parse_lines(lines_frame(spark, texts), RUN), "b1")
    found = warehouse.read("base").withColumn("id", F.monotonically_increasing_id())
    found = [(r.source, r.cust_id) for r in found.orderBy("id").collect()]
    assert found == sorted(found)


def test_staged_rows_are_invisible_and_a_retry_leaves_one_copy(spark, warehouse):
    warehouse.stage("base", parsed(spark, [1, 2]), "b1")
    assert warehouse.read("base").count() == 0
    warehouse.commit(warehouse.stage("base", parsed(spark, [1, 2]), "b1"))
    assert users(warehouse.read("base")) == [1, 2]


def test_not_null_is_enforced(spark, warehouse):
    bad = parsed(spark, [1]).withColumn("originating_filename", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="base.originating_filename must not be NULL"):
        warehouse.append("base", bad, "b1")
    assert warehouse.read("base").count() == 0


def test_delete_by_condition_rewrites_only_touched_folders(spark, warehouse):
    for n, day in ((1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-02")):
        warehouse.append("base", parsed(spark, [n], f"x/{n}.json", EventDt=f"{day}T00:00:00Z"), f"b{n}")
    before = warehouse.folders("base")
    change = warehouse.deletion("base", "d1", where=F.col("gcs_uri") == "x/2.json")
    assert change.removed == ["base/batch=b2/event_date=2026-01-02"] and change.added == []
    assert users(warehouse.read("base")) == [1, 2, 3]
    warehouse.commit(change)
    assert users(warehouse.read("base")) == [1, 3]
    assert set(warehouse.folders("base")) == set(before) - set(change.removed)


def test_delete_by_keys_keeps_the_rest_of_a_folder(spark, warehouse):
    both = parsed(spark, [1], "x/1.json").union(parsed(spark, [2, 3], "x/2.json", EventDt="bad"))
    warehouse.append("base", both.union(parsed(spark, [4], "x/4.json", EventDt="bad")), "b1")
    keys = spark.createDataFrame([("x/2.json",), ("x/2.json",)], "gcs_uri string")
    warehouse.commit(warehouse.deletion("base", "d1", keys=keys))
    assert users(warehouse.read("base")) == [1, 4]


def test_delete_keeps_rows_whose_condition_is_null(spark, warehouse):
    warehouse.append("base", parsed(spark, [1]).union(parsed(spark, [2], CustId="none")), "b1")
    warehouse.commit(warehouse.deletion("base", "d1", where=F.col("cust_id") > 0))
    assert users(warehouse.read("base")) == [2]


def test_replace_and_truncate(spark, warehouse):
    warehouse.append("base", parsed(spark, [1, 2]), "b1")
    rows = warehouse.read("base").filter("user_name = '10002'")
    warehouse.replace("base", rows, "r1", warehouse.version())
    assert users(warehouse.read("base")) == [2]
    warehouse.commit(warehouse.truncation("base"))
    assert warehouse.read("base").count() == 0


def test_the_slower_writer_fails_and_changes_nothing(spark, warehouse):
    based_on = warehouse.version()
    slow = warehouse.stage("base", parsed(spark, [1]), "slow")
    warehouse.append("base", parsed(spark, [2]), "fast")
    with pytest.raises(VersionConflict):
        warehouse.commit(slow, based_on=based_on)
    assert users(warehouse.read("base")) == [2]


def test_add_column_is_additive(spark, warehouse):
    warehouse.append("base", parsed(spark, [1]), "b1")
    warehouse.add_column("base", StructField("region", StringType()))
    warehouse.add_column("base", StructField("region", StringType()))
    warehouse.append("base", parsed(spark, [2]).withColumn("region", F.lit("eu")), "b2")
    assert rows(warehouse.read("base"), "user_name", "region") == [("10001", None), ("10002", "eu")]
    with pytest.raises(ValueError):
        warehouse.add_column("base", StructField("must", LongType(), False))


def test_compaction_merges_crowded_dates(spark, warehouse):
    for n in range(4):
        warehouse.append("base", parsed(spark, [n]), f"b{n}")
    warehouse.append("base", parsed(spark, [9], EventDt="2026-02-01T00:00:00Z"), "b9")
    warehouse.commit_if_any(warehouse.compact("base", "c1", max_folders=3))
    assert users(warehouse.read("base")) == [0, 1, 2, 3, 9]
    assert sorted(warehouse.folders("base")) == [
        "base/batch=b9/event_date=2026-02-01",
        "base/batch=c1-merged/event_date=2026-01-28",
    ]
    assert warehouse.compact("base", "c2", max_folders=1).added == []


def test_the_newest_folders_suffice_for_the_latest_rows(spark, warehouse):
    for n, day in ((1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-03"), (4, "bad")):
        time = day if day == "bad" else f"{day}T00:00:00Z"
        warehouse.append("base", parsed(spark, [n], EventDt=time), f"b{n}")
    assert users(warehouse.read_newest("base", 1)) == [3]
    assert users(warehouse.read_newest("base", 2)) == [2, 3]
    assert users(warehouse.read_newest("base", 9)) == [1, 2, 3, 4]
    assert warehouse.read_newest("archive", 5).count() == 0


def test_listing_and_storage(spark, warehouse):
    warehouse.append("base", parsed(spark, range(50)), "b1")
    assert {r.table_name for r in warehouse.tables().collect()} == {
        "base",
        "archive",
        "ledger",
        "monitoring",
    }
    sizes = {r.table_name: r for r in warehouse.storage().collect()}
    assert sizes["base"].row_count == 50 and sizes["ledger"].row_count == 0
    assert sizes["base"].size_gb == 0.0 and sizes["base"].last_modified > datetime(2024, 1, 1)
    assert next(iter(sizes)) == "base" and sizes["ledger"].last_modified is None


def test_an_old_version_can_still_be_read(spark, warehouse):
    warehouse.append("base", parsed(spark, [1]), "b1")
    old = warehouse.folders("base")
    warehouse.commit(warehouse.truncation("base"))
    assert users(warehouse.read_folders("base", old)) == [1]
