import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logledger.functions import values as v


def one(spark, column, **values):
    cells = [F.lit(x).alias(n) for n, x in values.items()]
    return spark.range(1).select(*cells).select(column).first()[0]


@pytest.mark.parametrize(
    "uri, expected",
    [
        ("gs://bucket/logs/foo.json", "foo"),
        ("gs://bucket/logs/deep/a.b.json", "a.b"),
        ("foo.json", "unknown"),
        ("gs://bucket/logs/foo.txt", "unknown"),
    ],
)
def test_load_id(spark, uri, expected):
    assert one(spark, v.load_id(F.col("u")), u=uri) == expected


@pytest.mark.parametrize(
    "uri, expected",
    [
        ("x/SRV-01-20260128-103000001-a.json", datetime(2026, 1, 28, 10, 30)),
        ("x/plain.json", None),
        ("x/SRV-20261328-103000-a.json", None),
    ],
)
def test_file_time(spark, uri, expected):
    assert one(spark, v.file_time(F.col("u")), u=uri) == expected


HALF_PAST = datetime(2026, 1, 28, 10, 30)
MILLIS = HALF_PAST.replace(microsecond=123000)
MICROS = HALF_PAST.replace(microsecond=123456)


@pytest.mark.parametrize(
    "text, four, sql",
    [
        ("2026-01-28T10:30:00", HALF_PAST, HALF_PAST),
        ("2026-01-28T10:30:00.123", MILLIS, MILLIS),
        ("2026-01-28T10:30:00.123456", MICROS, MICROS),
        ("2026-01-28T10:30:00Z", HALF_PAST, None),
        ("2026-01-28T10:30:00.123Z", MILLIS, None),
        ("2026-01-28", None, None),
        ("2026-01-28 10:30:00", None, None),
        ("2026-01-28T10:30:00+02:00", None, None),
        ("bad", None, None),
        (None, None, None),
    ],
)
def test_event_time(spark, text, four, sql):
    column = F.col("t").cast("string")
    assert one(spark, v.event_time(column), t=text) == four
    assert one(spark, v.event_time(column, "sql"), t=text) == sql


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), ("-5", -5), ("abc", None), ("3.7", None), ("99999999999999999999", None)],
)
def test_safe_long(spark, text, expected):
    assert one(spark, v.safe_long(F.col("t")), t=text) == expected


def test_fingerprint_takes_null_for_empty_and_zero_for_zero(spark):
    record = F.struct(
        F.lit("e").alias("EventDt"),
        F.lit(None).cast("string").alias("Source"),
        F.lit("f").alias("Filename"),
        F.lit("0").alias("Bytes"),
        F.lit("u").alias("UserName"),
    )
    expected = hashlib.sha256(b"e||f|0|u").hexdigest()
    assert one(spark, v.fingerprint(record), x=1) == expected


@pytest.mark.parametrize("text", ["", "abc", "ä€", "x" * 1000, "negative?", "1", "2", "3"])
def test_hash64(spark, text):
    digest = hashlib.sha256(text.encode()).digest()[:8]
    assert one(spark, v.hash64(F.col("t")), t=text) == int.from_bytes(digest, "big", signed=True)


def test_minutes_are_whole(spark):
    start, end = v.instant("2026-01-28 10:00:59"), v.instant("2026-01-28 10:02:58")
    assert one(spark, v.minutes_between(start, end), x=1) == 1


def test_percent_guards_zero(spark):
    assert one(spark, v.percent(F.lit(1), F.lit(3)), x=1) == 33.33
    assert one(spark, v.percent(F.lit(1), F.lit(0)), x=1) is None


@pytest.mark.parametrize("number, text", [(0.0, "0"), (33.33, "33.33"), (100.0, "100"), (None, "0")])
def test_number_text(spark, number, text):
    assert one(spark, v.number_text(F.lit(number).cast("double")), x=1) == text


def test_blank_counts_every_white_space(spark):
    for text, blank in [("", True), ("  ", True), ("\t\t", True), (" x", False)]:
        assert one(spark, v.is_blank(F.col("t")), t=text) is blank


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"a":1}', True), ("[1,2]", True), ("1", True), ('"x"', True), ("null", True), ('{"a":[{"b":"]"}]}', True),
        ('{"a":1}] rest', False), ('{"a":1}],[{"b":', False), ("1],[2", False), ("1,2", False), ("", False),
        ('{"a":1', False), ("{'a':1}", False), ("NaN", False), ('1,"end:x"]', False), ("x", False),
    ],
)
def test_json_validity(spark, text, valid):
    from logledger.functions.json_lines import is_json

    assert spark.createDataFrame([(text,)], "t string").select(is_json(F.col("t"))).first()[0] is valid


def test_a_nested_value_under_a_repeated_key_is_null(spark):
    from logledger.functions.json_lines import record_or_null

    lines = ['{"Bytes":{"x":1},"Bytes":{"y":1}}', '{"Bytes":"{}","Bytes":"{x}"}', '{"Bytes":[1],"Action":"[a"}']
    frame = spark.createDataFrame([(x,) for x in lines], "data string")
    got = [r[0] for r in frame.select(record_or_null()).collect()]
    assert [r.Bytes for r in got] == [None, "{x}", None] and got[2].Action == "[a"


@pytest.mark.parametrize(
    "line, fields",
    [
        ('{"Bytes":{"a":{"c":1,"c":2}},"Action":"x"}', {"Bytes": None, "Action": "x"}),
        ('{"Bytes":[{"a":1,"a":2}],"Action":"{}"}', {"Bytes": None, "Action": "{}"}),
        ('{"Bytes":1.0,"CustId":-0.0,"HashCode":1.50}', {"Bytes": "1.0", "CustId": "0.0", "HashCode": "1.5"}),
        ('{"Bytes":1e3,"CustId":true,"HashCode":99999999999999999999}',
         {"Bytes": "1000.0", "CustId": "true", "HashCode": "99999999999999999999"}),
        ('{"Bytes":null,"CustId":"1.0","HashCode":-9223372036854775808}',
         {"Bytes": None, "CustId": "1.0", "HashCode": "-9223372036854775808"}),
    ],
)
def test_fields_keep_their_json_type(spark, line, fields):
    from logledger.functions.json_lines import record_or_null

    found = spark.createDataFrame([(line,)], "data string").select(record_or_null()).first()[0]
    assert {k: found[k] for k in fields} == fields


@pytest.mark.parametrize(
    "line",
    [
        '{"Bytes":%s}',
        '{"Bytes" :\t%s , "CustId":2}',
        '{"Bytes":3,"Bytes":%s}',
        '{"Bytes":%s,"x":"a \\":1.5 b"}',
        '{"x":%s,"Bytes":"[3.50"}',
        '{"Bytes":%s}]',
        '{"Bytes":%s',
    ],
)
def test_plain_lines_read_as_texts_give_what_variants_give(spark, line):
    from logledger.functions import json_lines as jl

    values = ["0", "-0", "7", "-12", "007", "1.50", "1e3", "9" * 17, "9" * 18, "9" * 30, "true", "null", "tru"]
    values += ["NaN", "-Infinity", '""', '"1.50"', '"\\u00e9"', '"x" 1', '{"a":1}', "[1]", "1 2", "/**/1", ""]
    frame = spark.createDataFrame([(line % v,) for v in values], "data string")
    fields = "transform(array(%s), r -> struct(r.Bytes, r.CustId))[0]"
    both = frame.selectExpr(
        fields % f"({jl._RECORD})[0]", fields % f"({jl._VARIANTS})[0]", jl._NOT_PLAIN
    )
    found = [tuple(r) for r in both.collect()]
    assert [r[0] for r in found] == [r[1] for r in found]
    # Lines that are read as texts: without them this would compare variants with themselves.
    plain = sum(not r[2] for r in found)
    assert plain >= 5 or "[" in line or "]" in line or "1.5" in line or line.endswith("%s")
