from datetime import datetime, timedelta

import pytest
from conftest import NOW, lines_frame, record, rows
from pyspark.sql import functions as F

from logledger.operators import dedup
from logledger.operators import ledger as lg
from logledger.operators import lines as ln
from logledger.schemas import LEDGER

RUN = datetime(2026, 1, 28, 12)


def base_rows(spark, lines, uri="x/a.json"):
    return dedup.with_event_date(ln.parse_lines(lines_frame(spark, lines, uri), RUN))


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("by_date", [True, False])
def test_rows_in_history_are_dropped_copies_in_the_batch_stay(spark, by_date, small):
    history = base_rows(spark, [record(1), record(1), record(2, EventDt="bad")])
    batch = base_rows(
        spark, [record(1), record(3), record(3), record(2, EventDt="bad"), record(4, EventDt=None)], "x/b.json"
    )
    kept = dedup.drop_seen(batch, dedup.seen_keys(batch, history, by_date, small), by_date)
    assert sorted(r.user_name for r in kept.collect()) == ["10003", "10003", "10004"]


def test_a_hot_key_in_batch_and_history(spark, tmp_path):
    """A third of all rows share one fingerprint, on both sides."""
    hot = [record(0)] * 300
    history = base_rows(spark, hot + [record(i) for i in range(1, 300)])
    batch = base_rows(spark, hot + [record(i) for i in range(200, 800)], "x/b.json")
    kept = dedup.drop_history(batch, history, f"file:{tmp_path}/seen")
    assert sorted(int(r.user_name) for r in kept.collect()) == list(range(10300, 10800))


def test_rows_without_fingerprint_are_never_duplicates(spark, tmp_path):
    empty = F.lit(None).cast("string")
    none = base_rows(spark, [record(1)]).withColumn("hash_fingerprint", empty)
    assert dedup.drop_history(none, none, f"file:{tmp_path}/seen").count() == 1
    assert dedup.first_in_batch(none.union(none)).count() == 2


def test_first_in_batch(spark):
    a = base_rows(spark, [record(1), record(1), record(2)], "x/a.json")
    b = base_rows(spark, [record(1)], "x/b.json")
    assert rows(dedup.first_in_batch(a.union(b)), "gcs_uri", "user_name") == [
        ("x/a.json", "10001"),
        ("x/a.json", "10002"),
    ]


def test_dedup_base_keeps_the_earliest_per_file_and_hash(spark):
    def load(minute, lines, uri="x/a.json"):
        run = datetime(2026, 1, 28, 12, minute)
        return ln.parse_lines(lines_frame(spark, lines, uri), run)

    base = (
        load(5, [record(1), record(2), record(3, HashCode=None), record(4, HashCode=None)])
        .union(load(1, [record(1, Action="First")]))
        .union(load(1, [record(1)], "x/b.json"))
        .union(load(9, [record(3, HashCode=None)]))
    )
    kept = dedup.dedup_base(base)
    assert rows(kept, "gcs_uri", "user_name", "action", "load_time_dt") == [
        ("x/a.json", "10001", "First", datetime(2026, 1, 28, 12, 1)),
        ("x/a.json", "10002", "Store", datetime(2026, 1, 28, 12, 5)),
        ("x/a.json", "10003", "Store", datetime(2026, 1, 28, 12, 5)),
        ("x/a.json", "10004", "Store", datetime(2026, 1, 28, 12, 5)),
        ("x/b.json", "10001", "Store", datetime(2026, 1, 28, 12, 1)),
    ]


def counts(spark, name, **values):
    return spark.createDataFrame(list(values.items()), f"gcs_uri string, {name} long")


def test_ledger_status_rules(spark):
    files = spark.createDataFrame([(u,) for u in ("all", "some", "none", "blank")], "gcs_uri string")
    expected = counts(spark, "rows_expected", all=5, some=5, none=5)
    loaded = counts(spark, "rows_loaded", all=5, some=3)
    found = lg.ledger_rows(files, expected, loaded, RUN)
    assert found.schema.names == LEDGER.names
    assert rows(found, "gcs_uri", "rows_expected", "rows_loaded", "parse_errors", "status", "error_message") == [
        ("all", 5, 5, 0, "SUCCESS", None),
        ("blank", 0, 0, 0, "FAILED", "No non-empty rows found in file"),
        ("none", 5, 0, 5, "FAILED", "No rows loaded from file"),
        ("some", 5, 3, 2, "PARTIAL", "Parsed 3 of 5 rows"),
    ]


def test_more_loaded_than_expected_is_no_negative_error(spark):
    files = spark.createDataFrame([("f",)], "gcs_uri string")
    row = lg.ledger_rows(files, counts(spark, "rows_expected", f=2), counts(spark, "rows_loaded", f=3), RUN).first()
    assert (row.parse_errors, row.status) == (0, "SUCCESS")


def test_failure_rows_cut_the_message(spark):
    files = spark.createDataFrame([("x/f.json",)], "gcs_uri string")
    row = lg.failure_rows(files, RuntimeError("e" * 2000), RUN).first()
    assert (row.status, len(row.error_message), row.rows_loaded, row.rows_expected) == ("FAILED", 1000, 0, None)


def ledger(spark, *entries):
    data = [(u, u, NOW + timedelta(minutes=m), n, n, 0, "SUCCESS", None, 0.0) for u, m, n in entries]
    return spark.createDataFrame(data, LEDGER)


def test_merge_inserts_only(spark):
    old, new = ledger(spark, ("a", 0, 1)), ledger(spark, ("a", 5, 9), ("b", 5, 9))
    assert rows(lg.merge_new(old, new), "gcs_uri") == [("b",)]


def test_superseded_rows_go_ties_stay(spark):
    found = lg.latest_rows(ledger(spark, ("a", 0, 1), ("a", 5, 2), ("b", 3, 1), ("b", 3, 2), ("c", 1, 1)))
    assert rows(found, "gcs_uri", "rows_loaded") == [("a", 2), ("b", 1), ("b", 2), ("c", 1)]


def test_repeated_files_list_their_times_in_order(spark):
    found = lg.repeated_files(ledger(spark, ("a", 5, 1), ("a", 0, 1), ("b", 1, 1)))
    assert rows(found) == [("a", 2, [NOW, NOW + timedelta(minutes=5)])]


def test_first_addresses_keep_what_the_window_keeps(spark):
    """Ties in load time go by address; NULL file names are equal to each other; rows with
    neither hash nor fingerprint stay."""
    later = NOW + timedelta(hours=1)
    data = [
        ("a", 1, "m", NOW, "f", 2),
        ("a", 1, "n", later, "f", 0),
        ("a", 1, "o", NOW, "e", 9),
        ("b", 1, "m", NOW, "f", 3),
        (None, 1, "m", later, "f", 4),
        (None, 1, "m", NOW, "f", 5),
        ("a", None, "m", NOW, "f", 6),
        ("a", None, "m", NOW, "f", 7),
        ("a", None, None, NOW, "f", 8),
        ("a", None, None, NOW, "f", 9),
    ]
    base = spark.createDataFrame(
        data,
        "gcs_uri string, hash_code bigint, hash_fingerprint string, load_time_dt timestamp,"
        " _file string, _row bigint",
    )
    for some in (base, base.limit(0)):
        first = dedup.first_addresses(some, ("_file", "_row"))
        for broadcast in (True, False):
            marked = some.withColumn("n", F.concat("_file", F.col("_row").cast("string")))
            kept = dedup.keep_addressed(marked, first, ("_file", "_row"), broadcast)
            assert kept.columns == [*base.columns[:4], "n"]
            found = sorted(r.n for r in kept.collect())
            assert found == (["e9", "f3", "f5", "f6", "f8", "f9"] if some is base else [])
            plain = dedup.dedup_base(some.drop("_file", "_row"))
            assert plain.count() == len(found)
