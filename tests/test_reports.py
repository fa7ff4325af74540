from datetime import date, datetime, timedelta

import pytest
from conftest import NOW, lines_frame, record, rows
from pyspark.sql import functions as F

from logledger.operators.dedup import with_event_date
from logledger.operators.lines import archive_lines, parse_lines
from logledger.plans.reports import backlog, business, health, quality, reprocessing, volume
from logledger.schemas import LEDGER, MONITORING


def ago(**time):
    return NOW - timedelta(**time)


def uri(number, created=None):
    stamp = f"-{created:%Y%m%d-%H%M%S}0000" if created else ""
    return f"gs://bucket/logs/SRV{stamp}-{number}.json"


def ledger(spark, *entries):
    """Entries: (uri, processed, expected, loaded, status)."""
    data = [
        (u, u, at, loaded, expected, max(expected - loaded, 0), status, None, 0.0)
        for u, at, expected, loaded, status in entries
    ]
    return spark.createDataFrame(data, LEDGER)


@pytest.fixture
def some(spark):
    return ledger(
        spark,
        (uri(1, ago(minutes=50)), ago(minutes=30), 10, 10, "SUCCESS"),
        (uri(2, ago(hours=3)), ago(hours=2), 10, 6, "PARTIAL"),
        (uri(3), ago(hours=20), 5, 0, "FAILED"),
        (uri(4, ago(days=2)), ago(days=2), 100, 100, "SUCCESS"),
        (uri(4, ago(days=2)), ago(days=9), 100, 100, "SUCCESS"),
    )


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], LEDGER)


def files(spark, *uris):
    return spark.createDataFrame([(u,) for u in uris], "gcs_uri string")


def base(spark, *lines, run=NOW):
    return with_event_date(parse_lines(lines_frame(spark, list(lines)), run))


def test_pipeline_status(some, none):
    label = "Pipeline Status - Last 24 Hours"
    found = tuple(health.pipeline_status(some, NOW).first())
    assert found == (label, 3, 1, 1, 1, 16, 9, pytest.approx(16 / 3))
    assert tuple(health.pipeline_status(none, NOW).first()) == (label, 0, 0, 0, 0, None, None, None)


def test_pending_and_heartbeat(spark, some, none):
    raw = files(spark, uri(1, ago(minutes=50)), uri(8), uri(8), uri(9))
    assert tuple(health.pending_count(raw, some).first()) == ("Unprocessed Files", 2)
    assert tuple(health.heartbeat(raw, some, NOW).first()) == (NOW, 1, 2, "OK")
    stuck = (NOW, 0, 3, "ALERT: Pipeline may be stuck!")
    assert tuple(health.heartbeat(raw, none, NOW).first()) == stuck
    assert tuple(health.heartbeat(files(spark), none, NOW).first()) == (NOW, 0, 0, "OK")


def test_recent_files_and_errors(some):
    found = health.recent_files(some, NOW, limit=2).collect()
    assert [(r.status, r.minutes_ago) for r in found] == [("SUCCESS", 30), ("PARTIAL", 120)]
    assert [r.status for r in health.files_with_errors(some).collect()] == ["PARTIAL", "FAILED"]
    assert [r.rows_loaded for r in health.last_loads(some, 3).collect()] == [10, 6, 0]


def test_latency(spark, some, none):
    raw = files(spark, *[r.gcs_uri for r in some.collect()])
    found = tuple(health.processing_latency(raw, some, NOW).first())
    assert found == (NOW, 40.0, 60, 2, "WARNING: High latency detected")
    assert tuple(health.processing_latency(raw, none, NOW).first()) == (NOW, None, None, 0, "OK")


def test_error_rate(some, none):
    found = tuple(health.error_rate(some, NOW).first())
    assert found == (NOW, 3, 1, 1, 1, 66.67, "ALERT: Error rate exceeds 5%!")
    assert tuple(health.error_rate(none, NOW).first()) == (NOW, 0, 0, 0, 0, None, "OK")


def test_dashboard(spark, some, none):
    raw = files(spark, uri(8))
    found = health.dashboard(raw, some, NOW).first()
    assert tuple(found)[2:7] == (3, 16, 1, 2, ago(minutes=30))
    assert found.overall_status == "🟡 WARNING: High error rate"
    assert "CRITICAL" in health.dashboard(raw, none, NOW).first().overall_status
    assert "HEALTHY" in health.dashboard(files(spark), none, NOW).first().overall_status


def test_monitoring_snapshot(spark, some, none):
    raw = files(spark, uri(8, ago(minutes=31)), uri(9, ago(minutes=30)), uri(7))
    found = health.monitoring_snapshot(raw, some, NOW)
    assert found.columns == MONITORING.names
    assert tuple(found.first())[1:7] == (1, 3, 66.67, 31, 1, "ALERT")
    assert found.first().details == (
        "processed_last_hour=1, pending=3, error_rate_pct=66.67, max_latency_min=31, stale_files=1"
    )
    calm = health.monitoring_snapshot(files(spark), none, NOW).first()
    assert tuple(calm)[1:7] == (0, 0, None, None, 0, "OK")


@pytest.mark.parametrize(
    "age, processed, status", [(15, 1, "OK"), (16, 1, "ALERT"), (0, 0, "ALERT"), (None, 1, "OK")]
)
def test_snapshot_thresholds(spark, age, processed, status):
    done = ledger(spark, *[(uri(1), ago(minutes=5), 1, 1, "SUCCESS")] * processed)
    raw = files(spark, uri(2, None if age is None else ago(minutes=age)))
    assert health.monitoring_snapshot(raw, done, NOW).first().status == status


def test_latest_alert_takes_the_newest(spark):
    data = [(ago(minutes=m), 0, 0, 0.0, 0, 0, s, s.lower()) for m, s in ((5, "OK"), (9, "ALERT"))]
    found = health.latest_alert(spark.createDataFrame(data, MONITORING)).first()
    assert tuple(found) == ("OK", "ok")


def test_quality(spark):
    rows_ = base(
        spark,
        record(1),
        record(1),
        record(2, EventDt="bad", Action=None),
        record(3, Bytes="x", RawData="Bytes=x"),
        record(4, Bytes="x", RawData="nothing"),
    )
    assert tuple(quality.null_check(rows_, NOW).first()) == ("Null Value Check", 5, 0, 0, 1, 0, 1)
    assert tuple(quality.cast_failures(rows_, NOW).first())[1:] == (5, 1, 0, 0)
    found = quality.duplicate_rows(rows_, NOW).collect()
    assert [r.occurrences for r in found] == [2]
    assert quality.duplicate_rows(rows_, NOW + timedelta(days=2)).count() == 0


def test_duplicate_rows_fall_back_to_the_row_hash(spark):
    rows_ = base(spark, record(1), record(1)).withColumn(
        "hash_fingerprint", F.lit(None).cast("string")
    )
    assert [r.dedupe_key for r in quality.duplicate_rows(rows_, NOW).collect()] == ["-1"]


def test_duplicate_files(some):
    assert rows(quality.duplicate_files(some), "times_processed") == [(2,)]
    found = reprocessing.duplicate_ledger_entries(some).first()
    assert found.processing_times == [ago(days=9), ago(days=2)]


def test_archive_reports(spark):
    lines = lines_frame(spark, [record(1), "x" * 200, "[1]", record(1) + " junk", " "])
    archive = archive_lines(lines, NOW)
    found = quality.archive_completeness(parse_lines(lines, NOW), archive).first()
    assert tuple(found) == ("Archive vs Base Comparison", 1, 1, 1, 4)
    valid = {r.json_preview[:3]: r.is_valid_json for r in quality.archive_validity(archive, 10).collect()}
    assert valid["xxx"] is False and valid["[1]"] is True
    assert max(len(r.json_preview) for r in quality.archive_validity(archive).collect()) == 100


def test_volume(spark, some):
    found = volume.daily_volume(some).collect()
    assert [(r.processing_date, r.files_processed, r.total_rows) for r in found] == [
        (date(2026, 1, 28), 2, 16),
        (date(2026, 1, 27), 1, 0),
        (date(2026, 1, 26), 1, 100),
        (date(2026, 1, 19), 1, 100),
    ]
    hours = volume.hourly_distribution(some, NOW).collect()
    assert [(r.hour_of_day, r.files_processed) for r in hours] == [(10, 1), (11, 1), (12, 1), (16, 1)]


def test_volume_anomaly(some, none):
    found = volume.volume_anomaly(some, NOW).first()
    assert tuple(found) == (NOW, date(2026, 1, 28), 16, 50.0, 68.0, "WARNING: Unusual volume")
    assert volume.volume_anomaly(none, NOW).count() == 0
    stats = volume.volume_statistics(some, NOW).first()
    assert stats.stddev_rows == pytest.approx(70.7106781)


def test_volume_on_the_first_day(spark):
    only = ledger(spark, (uri(1), ago(minutes=5), 1, 1, "SUCCESS"))
    found = volume.volume_anomaly(only, NOW).first()
    assert (found.avg_daily_rows, found.pct_deviation, found.status) == (None, None, "OK")


def test_sources_and_users(spark):
    rows_ = base(
        spark,
        record(1, Source="A"),
        record(2, Source="A", EventDt="2026-01-27T00:00:00Z"),
        record(3, Source="A", CustId=0, PartnerName="p"),
        record(4, Source="B", CustId=0),
        record(5, Source="B", CustId=0, PartnerName="p"),
        record(1, Source="C", EventDt="2026-01-20T00:00:00Z"),
    )
    found = volume.source_volume(rows_, NOW).collect()
    assert [(r.source, r.event_count, r.active_days) for r in found] == [("A", 3, 2), ("B", 2, 1)]
    assert found[0].first_event == datetime(2026, 1, 27)
    assert tuple(business.user_mix(rows_, NOW).first())[1:] == (2, 2, 1, 2, 1)
    empty = business.user_mix(rows_.limit(0), NOW).first()
    assert tuple(empty)[1:] == (0, 0, 0, 0, 0)


def test_actions_and_latest_events(spark):
    rows_ = base(spark, record(1), record(2), record(3, Action="Login"), record(4, EventDt="bad"))
    found = business.action_mix(rows_, NOW).collect()
    assert [tuple(r) for r in found] == [("Store", 2, 66.67), ("Login", 1, 33.33)]
    latest = business.latest_events(rows_, 2).collect()
    assert [r.user_name for r in latest] == ["10003", "10002"]


def test_stale_files(spark, none):
    raw = files(spark, *[uri(i, ago(minutes=27 + i)) for i in range(8)], uri(99))
    found = backlog.stale_files(raw, none, NOW).first()
    assert (found.stale_file_count, found.pending_count, found.oldest_pending_minutes) == (4, 8, 34)
    assert found.sample_stale_files == [uri(i, ago(minutes=27 + i)) for i in (7, 6, 5, 4, 3)]
    assert found.status == "ALERT: Stale files detected!"
    calm = backlog.stale_files(files(spark), none, NOW).first()
    assert (calm.stale_file_count, calm.sample_stale_files, calm.status) == (0, None, "OK")


def test_reprocessing_reports(some):
    found = reprocessing.unfinished_files(some).collect()
    assert [r.status for r in found] == ["PARTIAL", "FAILED"]
    assert reprocessing.file_state(some, uri(3)).first().rows_loaded == 0
    both = reprocessing.files_in_range(some, ago(hours=20), ago(hours=2)).collect()
    assert [r.status for r in both] == ["FAILED", "PARTIAL"]
    assert tuple(reprocessing.reload_preview(some).first()) == ("FULL RELOAD WARNING", 5, 216)


def test_metric_table_and_visibility(spark, some, none):
    found = rows(health.metric_table(some, none, none))
    assert found == [("Files Processed", 5), ("Rows in Archive", 0), ("Rows in Base Table", 0)]
    lines = lines_frame(spark, ["a", "", "b"])
    assert [r.row_count for r in quality.file_visibility(lines).collect()] == [3]
