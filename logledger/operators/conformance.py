"""Does a raw file keep to the record format: counts and first examples per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logledger.functions import json_lines as jl
from logledger.functions import values as v
from logledger.operators.dedup import stored
from logledger.schemas import REQUIRED_KEYS
from logledger.sources.files import shared_folder

# Names of the rules, integer keys, number of examples, ISO time shape.
RULES = ("json", "missing", "int_cast", "ts")
INTEGER_KEYS = ("CustId", "Bytes", "StatusCode")
EXAMPLES = 3
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)


def is_iso_time(text: Column) -> Column:
    """ISO date or date and time; offsets, a blank instead of T and a bare date are fine."""
    parsed = F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp")
    return F.coalesce(text.rlike(ISO_TIME) & parsed.isNotNull(), F.lit(False))


def _missing_keys(record: Column, data: Column) -> Column:
    """Required keys that are not there; a key with a null value is. Only lines with a null
    among the required fields are looked at twice."""
    wanted = F.array(*[F.lit(k) for k in REQUIRED_KEYS])
    nulls = [record[k].isNull() for k in REQUIRED_KEYS]
    any_null = nulls[0]
    for n in nulls[1:]:
        any_null = any_null | n
    none = F.array().cast("array<string>")
    return F.when(any_null, F.array_except(wanted, F.json_object_keys(data))).otherwise(none)


def judge_lines(lines: DataFrame) -> DataFrame:
    """Adds to each non-empty line: ``error``, the first rule it breaks or NULL, and some
    fields. Other columns of the lines are kept."""
    data = F.col("data")
    rows = lines.withColumn("is_line", ~v.is_blank(data)).withColumn(
        "r", F.when(F.col("is_line"), jl.record_or_null())
    )
    record = F.col("r")
    rows = rows.withColumn("missing", _missing_keys(record, data))
    bad_int = F.lit(False)
    for key in INTEGER_KEYS:
        bad_int = bad_int | v.safe_long(record[key]).isNull()
    error = (
        F.when(record.isNull(), RULES[0])
        .when(
            F.size("missing") > 0,
            F.concat(F.lit(RULES[1] + ":"), F.concat_ws(",", "missing")),
        )
        .when(bad_int, RULES[2])
        .when(~is_iso_time(record["EventDt"]), RULES[3])
    )
    return rows.select(
        *lines.columns,
        "is_line",
        F.when(F.col("is_line"), error).alias("error"),
        v.safe_long(record["CustId"]).alias("cust_id"),
        record["EventDt"].alias("event_dt"),
        record["Filename"].alias("filename"),
    )


def conformance_counts(lines: DataFrame) -> DataFrame:
    """Lines, good lines and errors of each file."""
    return _counts(judge_lines(lines))


def _counts(judged: DataFrame) -> DataFrame:
    is_line, error = F.col("is_line"), F.col("error")
    return judged.groupBy("gcs_uri").agg(
        F.count_if(is_line).alias("lines"),
        F.count_if(is_line & error.isNull()).alias("ok"),
        F.count_if(error.isNotNull()).alias("errors"),
    )


def _split_offsets(numbered: DataFrame) -> DataFrame:
    """What to add to a line's ``read_id`` to get its number in the file, per split."""
    splits = numbered.groupBy("gcs_uri", "split_start").agg(
        F.count("*").alias("n"), F.min("read_id").alias("first_id")
    )
    earlier = (
        Window.partitionBy("gcs_uri")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_id") + 1
    return splits.select("gcs_uri", "split_start", offset.alias("to_line"))


def _first_lines(lines: DataFrame, limit: int) -> DataFrame:
    in_file = Window.partitionBy("gcs_uri").orderBy("split_start", "read_id")
    placed = lines.withColumn("place", F.row_number().over(in_file))
    return placed.filter(F.col("place") <= limit).drop("place")


def _examples(judged: DataFrame, splits: DataFrame) -> DataFrame:
    ok = F.col("error").isNull()
    return judged.join(splits, ["gcs_uri", "split_start"]).select(
        "gcs_uri",
        (F.col("read_id") + F.col("to_line")).alias("line"),
        "error",
        *[F.when(ok, F.col(c)).alias(c) for c in ("cust_id", "event_dt", "filename")],
    )


def conformance_examples(numbered: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """The first non-empty lines of each file with their line numbers and verdicts.

    ``numbered`` comes from ``Landing.numbered_lines``. Text carries no line numbers, and a
    file read in several splits has no single reader that could count. So lines are counted
    per split, the counts before a split are added up per file, and a line's number is that
    sum plus its place in the split. No file has to fit in one task: the window over lines
    keeps at most ``limit`` rows per file in every task before it shuffles, and the sums run
    over one row per split.
    """
    first = _first_lines(numbered.filter(~v.is_blank(F.col("data"))), limit)
    return _examples(judge_lines(first), _split_offsets(numbered))


def conformance(numbered: DataFrame, scratch: str | None = None) -> DataFrame:
    """Per file: lines, ok, errors, and an array with the first three lines' verdicts; NULL for
    a file of blank lines only. The text is read and judged once, into a table of verdicts
    without the text in the folder ``scratch`` (unless given, a new shared one); counts, line
    numbers and examples come from it.
    (Lines of one split keep the ids they were read with, so numbers do not depend on how the
    verdicts are read again.)"""
    scratch = scratch or shared_folder(numbered.sparkSession, "verdicts")
    judged = stored(judge_lines(numbered).drop("data"), scratch)
    first = _first_lines(judged.filter("is_line"), EXAMPLES)
    example = F.struct("line", "error", "cust_id", "event_dt", "filename")
    # At most three rows per file are collected.
    examples = _examples(first, _split_offsets(judged)).groupBy("gcs_uri").agg(
        F.array_sort(F.collect_list(example)).alias("examples")
    )
    return _counts(judged).join(examples, "gcs_uri", "left")
