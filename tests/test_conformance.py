import json

import pytest
from conftest import lines_frame, name, record, rows

from logledger.operators import conformance as cf
from logledger.schemas import REQUIRED_KEYS


@pytest.mark.parametrize(
    "line, error",
    [
        (record(), None),
        ("not json", "json"),
        ('{"UserName":"cut off', "json"),
        (record(Bytes=..., Source=...), "missing:Source,Bytes"),
        (record(PartnerName=..., RawData=...), None),
        (record(UserName=None), None),
        (record(CustId=None), "int_cast"),
        (record(Bytes="abc"), "int_cast"),
        (record(StatusCode="226"), None),
        (record(EventDt="2026-01-28"), None),
        (record(EventDt="2026-01-28 10:30:00"), None),
        (record(EventDt="2026-01-28T10:30:00+02:00"), None),
        (record(EventDt="2026-01-28T10:30:00.123Z"), None),
        (record(EventDt="2026-13-28T10:30:00"), "ts"),
        (record(EventDt="yesterday"), "ts"),
        (record(EventDt=None), "ts"),
    ],
)
def test_the_first_broken_rule(spark, line, error):
    found = cf.judge_lines(lines_frame(spark, [line])).first()
    assert (found.is_line, found.error) == (True, error)


def test_required_keys():
    assert len(REQUIRED_KEYS) == 10 and "PartnerName" not in REQUIRED_KEYS


def test_counts_and_examples(spark, folder):
    a = folder.put(name("a"), ["", record(1), "x", "  ", record(2, Bytes=...), record(3)])
    b = folder.put(name("b"), [" ", ""])
    found = {r.gcs_uri: r for r in cf.conformance(folder.landing.numbered_lines(spark)).collect()}
    assert (found[a].lines, found[a].ok, found[a].errors) == (4, 2, 2)
    assert [tuple(e) for e in found[a].examples] == [
        (2, None, 10001, "2026-01-28T10:01:00.000Z", "/uploads/1.txt"),
        (3, "json", None, None, None),
        (5, "missing:Bytes", None, None, None),
    ]
    assert (found[b].lines, found[b].examples) == (0, None)


def test_line_numbers_of_a_file_read_in_many_splits(spark, folder):
    """The first lines of a file lie splits away from its start if blank lines come first."""
    blank = 4000
    texts = [" " * 40] * blank + ["x", record(1), "  ", "y"] + [record(i) for i in range(2000)]
    uri = folder.put(name("big"), texts)
    folder.put(name("small"), [record(1)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = folder.landing.numbered_lines(spark)
        assert numbered.select("split_start").distinct().count() > 10
        found = cf.conformance_examples(numbered).filter(f"gcs_uri = '{uri}'")
        assert rows(found, "line", "error") == [
            (blank + 1, "json"),
            (blank + 2, None),
            (blank + 4, "json"),
        ]
        counts = cf.conformance_counts(numbered).filter(f"gcs_uri = '{uri}'").first()
        assert (counts.lines, counts.ok, counts.errors) == (2003, 2001, 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_against_a_plain_reader(spark):
    """Brute force over records with every required key left out in turn."""
    lines = [record(i) for i in range(5)] + [record(**{k: ...}) for k in REQUIRED_KEYS] + ["{", "{}"]

    def plain(line):
        try:
            found = json.loads(line)
        except ValueError:
            return "json"
        missing = [k for k in REQUIRED_KEYS if k not in found]
        return "missing:" + ",".join(missing) if missing else None

    judged = cf.judge_lines(lines_frame(spark, lines))
    assert {r.data: r.error for r in judged.collect()} == {x: plain(x) for x in lines}
