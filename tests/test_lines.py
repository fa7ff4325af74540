import hashlib
import json
from datetime import datetime

import pytest
from conftest import NOW, lines_frame, record, rows

from logledger.operators import lines as ln
from logledger.options import VARIANTS, IngestOptions
from logledger.schemas import ARCHIVE, BASE

RUN = datetime(2026, 1, 28, 12)
CUT, TEXT, LIST = '{"UserName":"cut off', "no record here", "[1,2]"


@pytest.mark.parametrize(
    "line, strict, lenient",
    [
        (record(), 1, 1),
        ("  " + record() + " ", 1, 1),
        ("{}", 1, 1),
        (CUT, 0, 1),
        (record() + " junk", 0, 1),
        (record() + "]", 0, 1),
        (record() + "]}", 0, 1),
        (record() + "," + record(), 0, 1),
        (record() + record(), 0, 1),
        (record() + "," + record() + "]", 0, 1),
        ("{'Action':'x'}", 0, 1),
        ('{"Action":"x",}', 0, 1),
        (TEXT, 0, 0),
        (LIST, 0, 0),
        ("[" + record() + "]", 0, 0),
        ("null", 0, 0),
        ("5", 0, 0),
        ('"text"', 0, 0),
        ("", 0, 0),
        ("\t\t", 0, 0),
    ],
)
def test_which_lines_become_rows(spark, line, strict, lenient):
    frame = lines_frame(spark, [line])
    assert ln.parse_lines(frame, RUN).count() == strict
    assert ln.parse_lines(frame, RUN, IngestOptions(lenient=True)).count() == lenient


def test_values_of_a_row(spark):
    sent = record(7, PartnerName="acme", CustId=0, HashCode=-2452304374272821912)
    row = ln.parse_lines(lines_frame(spark, [sent]), RUN).first()
    assert row.asDict() == {
        "load_time_dt": NOW,
        "source_file_dt": datetime(2026, 1, 28, 10, 7),
        "originating_filename": "LOG-TEST-20260128-1030000001-a",
        "gcs_uri": "gs://bucket/logs/LOG-TEST-20260128-1030000001-a.json",
        "action": "Store",
        "bytes": 7168,
        "cust_id": 0,
        "event_dt": datetime(2026, 1, 28, 10, 7),
        "filename": "/uploads/7.txt",
        "hash_code": -2452304374272821912,
        "hash_fingerprint": hashlib.sha256(
            b"2026-01-28T10:07:00.000Z|LOG-TEST|/uploads/7.txt|7168|10007"
        ).hexdigest(),
        "ip_address": "10.0.0.1",
        "partner_name": "acme",
        "session_id": "s-7",
        "source": "LOG-TEST",
        "user_name": "10007",
        "server_response": "done",
        "raw_data": "STOR /uploads/7.txt",
    }
    assert ln.parse_lines(lines_frame(spark, [sent]), RUN).columns == BASE.names


@pytest.mark.parametrize(
    "sent, loaded",
    [("12", 12), (12, 12), ("abc", None), (3.7, None), (99999999999999999999, None), (..., None)],
)
def test_numbers(spark, sent, loaded):
    row = ln.parse_lines(lines_frame(spark, [record(1, Bytes=sent)]), RUN).first()
    assert row.bytes == loaded


@pytest.mark.parametrize("time", ["2026-01-28", "bad", None, ...])
def test_without_event_time_the_run_time_stands_in(spark, time):
    row = ln.parse_lines(lines_frame(spark, [record(1, EventDt=time)]), RUN).first()
    assert row.event_dt is None and row.source_file_dt == NOW


def test_nested_values_are_null_but_their_look_alikes_are_not(spark):
    nested = record(1, Action={"a": 1}, Filename=[1], Source='{"a": 1}', UserName="[x", Extra={"b": 2})
    row = ln.parse_lines(lines_frame(spark, [nested]), RUN).first()
    assert (row.action, row.filename, row.source, row.user_name) == (None, None, '{"a": 1}', "[x")


def test_last_of_equal_keys_wins(spark):
    row = ln.parse_lines(lines_frame(spark, ['{"Action":"a","Action":"b"}']), RUN).first()
    assert row.action == "b"


def test_variants(spark):
    frame = lines_frame(spark, [record(1), CUT])
    z = {n: ln.parse_lines(frame, RUN, o) for n, o in VARIANTS.items()}
    assert {n: f.count() for n, f in z.items()} == {
        "default": 1,
        "procedure": 2,
        "script": 2,
        "triggered_script": 2,
        "per_file": 1,
    }
    assert z["per_file"].filter("event_dt is not null").count() == 1
    assert z["procedure"].filter("event_dt is not null").count() == 0
    assert z["triggered_script"].filter("hash_fingerprint is not null").count() == 0


def test_fingerprint_keys_are_a_choice(spark):
    frame = lines_frame(spark, [record(1), record(1, Action="Login", SessionId="s-2")])
    default = ln.parse_lines(frame, RUN).select("hash_fingerprint").distinct().count()
    wider = IngestOptions(fingerprint_keys=("EventDt", "Action", "SessionId"))
    assert (default, ln.parse_lines(frame, RUN, wider).select("hash_fingerprint").distinct().count()) == (1, 2)


def test_archive_keeps_every_line_that_is_not_blank(spark):
    kept = [record(), CUT, TEXT, LIST, " x "]
    frame = ln.archive_lines(lines_frame(spark, [*kept, "", "   ", "\t"]), RUN)
    assert frame.columns == ARCHIVE.names
    assert sorted(r.raw_json for r in frame.collect()) == sorted(kept)
    assert rows(frame.select("archived_timestamp", "process_dt").distinct()) == [(NOW, NOW)]


def test_archive_rebuilds_the_base_rows(spark):
    frame = lines_frame(spark, [record(i) for i in range(5)] + [CUT, "  "])
    archive = ln.archive_lines(frame, RUN)
    assert rows(ln.parse_lines(ln.archived_as_lines(archive), RUN)) == rows(
        ln.parse_lines(frame, RUN)
    )


def test_reextract_reads_the_status_code(spark):
    archive = ln.archive_lines(lines_frame(spark, [record(1), TEXT]), RUN)
    assert rows(ln.reextract(archive), "EventDt", "StatusCode") == [
        ("2026-01-28T10:01:00.000Z", "226")
    ]


def test_file_stats_count_lines_that_are_not_blank(spark):
    a = lines_frame(spark, [record(), CUT, "", "  "], "x/a.json")
    b = lines_frame(spark, ["  ", "\t"], "x/b.txt")
    assert rows(ln.file_stats(a.union(b))) == [("x/a.json", "a", 2), ("x/b.txt", "unknown", 0)]
    assert rows(ln.visible_files(a.union(b))) == [("x/a.json", 4), ("x/b.txt", 2)]


def test_line_reader_agrees_with_a_plain_json_reader(spark):
    """Brute force over all pairs of line pieces."""
    pieces = ['{"Action":"a"}', "{", "}", "[", "]", ",", '"', "x", "{}", " ", "null", '{"Action":1}']
    lines = [a + b + c for a in pieces for b in pieces for c in pieces]

    def good(line):
        try:
            return isinstance(json.loads(line), dict)
        except ValueError:
            return False

    found = ln.read_records(lines_frame(spark, lines)).select("data").collect()
    assert sorted(r.data for r in found) == sorted(x for x in lines if good(x))
