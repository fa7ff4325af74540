"""The plans the engine counts on at scale."""

import io
from contextlib import redirect_stdout
from datetime import timedelta

import pytest
from conftest import NOW, lines_frame, name, record
from pyspark.sql import functions as F

from logledger.operators import conformance as cf
from logledger.operators import dedup
from logledger.operators.ledger import latest_rows
from logledger.operators.lines import parse_lines
from logledger.plans.ingest import ingest_batch
from logledger.plans.reports import business, health, volume
from logledger.plans.reprocess import cluster_base
from logledger.sources.warehouse import ADDRESS


@pytest.fixture(autouse=True)
def with_code_generation(spark):
    names = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "true")
    spark.conf.set(names[1], "FALLBACK")
    yield
    for n, o in zip(names, old, strict=True):
        spark.conf.set(n, o)


def plan(frame, mode="formatted"):
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


@pytest.fixture
def loaded(warehouse, folder):
    days = range(1, 29)
    folder.put(name("a"), [record(d, EventDt=f"2026-01-{d:02d}T00:00:00Z") for d in days])
    ingest_batch(warehouse, folder.landing, NOW)
    return warehouse


def test_a_line_is_parsed_once_and_rows_are_not_shuffled(spark):
    text = plan(parse_lines(lines_frame(spark, [record()]), NOW))
    assert text.count("from_json(") == 1 and "Exchange" not in text


def test_judging_lines_parses_once(spark):
    text = plan(cf.conformance_counts(lines_frame(spark, [record()])))
    assert text.count("from_json(") == 1


def test_keep_one_windows_reduce_before_the_shuffle(loaded):
    base = loaded.read("base")
    for frame in (dedup.dedup_base(base), dedup.first_in_batch(base), latest_rows(loaded.read("ledger"))):
        before, _, after = plan(frame, "simple").partition("Exchange")
        assert "WindowGroupLimit" in after


def test_examples_reduce_before_the_shuffle(spark, folder):
    folder.put(name("a"), [record()])
    text = plan(cf.conformance_examples(folder.landing.numbered_lines(spark)), "simple")
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text


def test_a_week_reads_a_week_of_folders(loaded):
    for frame in (
        business.action_mix(loaded.read("base"), NOW),
        business.user_mix(loaded.read("base"), NOW),
        volume.source_volume(loaded.read("base"), NOW),
    ):
        text = plan(frame)
        assert "PartitionFilters: [isnotnull(event_date" in text
        assert ">= 2026-01-21)" in text


def test_filters_and_columns_reach_the_scan(loaded):
    text = plan(
        health.row_reconciliation(
            loaded.read("ledger"), loaded.read("base"), loaded.read("archive"), "x"
        )
    )
    assert text.count("PushedFilters: [IsNotNull(gcs_uri), EqualTo(gcs_uri,x)]") == 3
    assert "ReadSchema: struct<gcs_uri:string>" in text and "raw_data" not in text


@pytest.mark.parametrize("small", [True, False])
def test_history_is_compared_on_two_columns(loaded, small):
    spark = loaded.spark
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(dedup.seen_keys(loaded.read("base"), loaded.read("base"), small_batch=small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("ReadSchema: struct<hash_fingerprint:string>") == 2
    assert ("BroadcastHashJoin LeftSemi" if small else "SortMergeJoin LeftSemi") in text


def test_rows_without_key_are_ruled_out_by_statistics(loaded):
    text = plan(dedup.dedup_base(loaded.read("base")))
    assert "PushedFilters: [IsNull(hash_code), IsNull(hash_fingerprint)]" in text


def test_only_pending_files_are_read(spark, folder):
    for i in range(6):
        folder.put(name(i), [record(i)])
    pending = folder.landing.files(spark).filter(F.col("gcs_uri").contains("-3.json"))
    (wave,) = folder.landing.waves(pending)
    wave.lines.collect()
    scan = wave.lines._jdf.queryExecution().executedPlan().collectLeaves().head()
    wave.lines._jdf.queryExecution().executedPlan().execute().count()
    assert wave.count == 1
    assert scan.metrics().apply("numFiles").value() == 1


def test_writes_split_a_hot_date(spark, warehouse):
    """One date holds all rows: the rebalanced write still uses several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        lines = spark.range(0, 40000, 1, 8).select(
            F.lit("x/a.json").alias("gcs_uri"),
            F.format_string(
                '{"EventDt":"2026-01-28T00:00:00Z","CustId":%d,"RawData":"%s"}',
                F.col("id"),
                F.sha2(F.col("id").cast("string"), 512),
            ).alias("data"),
        )
        change = warehouse.stage("base", parse_lines(lines, NOW), "hot")
        (only,) = change.added
        written = [n for n in warehouse.files.children(f"{warehouse.root}/{only}") if n.endswith("parquet")]
        assert len(written) > 3
        assert warehouse.read_folders("base", change.added).count() == 40000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")


def test_only_folders_of_recent_runs_are_opened(spark, warehouse, folder):
    for day in range(3):
        folder.put(name(day), [record(day)])
        ingest_batch(warehouse, folder.landing, NOW + timedelta(days=day))
    recent = warehouse.read("base", since=NOW + timedelta(days=1, hours=23))
    assert recent.count() == 1 and len(recent.inputFiles()) == 1
    assert warehouse.read("base").count() == 3


def rows_scanned(frame):
    """Rows that the scan of a frame with one scan handed on: those of row groups it read."""
    executed = frame._jdf.queryExecution().executedPlan()
    executed.execute().count()
    return executed.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("column", ["hash_fingerprint", "gcs_uri"])
def test_a_lookup_skips_row_groups(spark, warehouse, column):
    """Twenty loads of one date: ranges of names and fingerprints overlap, so minima and maxima
    rule nothing out."""
    for load in range(20):
        lines = spark.range(load, 4000, 20, 1).select(
            F.format_string("x/%d.json", F.col("id") * 7919 % 4000).alias("gcs_uri"),
            F.format_string(
                '{"EventDt":"2026-01-28T00:00:00Z","UserName":"%d"}', F.col("id")
            ).alias("data"),
        )
        warehouse.append("base", parse_lines(lines, NOW), f"b{load}")
    assert len(warehouse.read("base").inputFiles()) == 20
    value = warehouse.read("base").filter("user_name = '1234'").first()[column]
    for found in (
        warehouse.find("base", column, [value]),
        warehouse.find("base", column, [value, "absent"]),
        warehouse.read("base").filter(F.col(column) == value),
    ):
        assert [r.user_name for r in found.collect()] == ["1234"]
        # One in twenty row groups holds it; a filter errs once in a hundred times.
        assert rows_scanned(found) <= 600
    absent = warehouse.find("base", column, ["absent"])
    assert absent.count() == 0 and rows_scanned(absent) <= 400


@pytest.mark.parametrize("small", [True, False])
def test_kept_rows_are_found_without_sorting_texts(loaded, tmp_path, small):
    spark = loaded.spark
    rows = loaded.read_folders("base", loaded.folders("base"), with_address=True)
    first = dedup.first_addresses(rows, ADDRESS)
    text = plan(first)
    assert "raw_data" not in text and "Window" not in text
    stored = dedup.stored(first, f"file:{tmp_path}/first")
    text = plan(dedup.keep_addressed(rows, stored, ADDRESS, broadcast=small))
    assert "Window" not in text
    if small:
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_conformance_reads_the_text_once(spark, folder, monkeypatch):
    folder.put(name("a"), [record(1), "", "broken", record(2)])
    plans = []

    def stored(rows, where):
        plans.append(plan(rows))
        return dedup.stored(rows, where)

    monkeypatch.setattr(cf, "stored", stored)
    report = cf.conformance(folder.landing.numbered_lines(spark))
    (first,) = plans
    assert first.count("Scan text") == 2  # once in the tree, once in the details
    assert "Scan text" not in plan(report)
    (row,) = report.collect()
    assert (row.lines, row.ok, row.errors) == (3, 2, 1)
    assert [e.line for e in row.examples] == [1, 3, 4]


def test_a_clustered_date_skips_row_groups_by_either_column(spark, warehouse):
    """One hot date of 40,000 rows, a third of them of one customer; some without a customer."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        number = F.col("id") * 7919 % 40000
        customer = F.when(number % 3 == 0, F.lit("77")).when(number % 50 == 1, F.lit("null"))
        lines = spark.range(0, 40000, 1, 8).select(
            F.lit("x/a.json").alias("gcs_uri"),
            F.format_string(
                '{"EventDt":"2026-01-28T00:00:00Z","CustId":%s,"Source":"S%d","RawData":"%s"}',
                customer.otherwise((number % 997).cast("string")),
                F.floor(number / 5000),
                F.sha2(F.col("id").cast("string"), 512),
            ).alias("data"),
        )
        warehouse.append("base", parse_lines(lines, NOW), "hot")
        before = warehouse.read("base")
        digest = before.agg(F.count("*"), F.sum(F.xxhash64(*before.columns).cast("decimal(38,0)"))).first()
        version = warehouse.version()
        assert cluster_base(warehouse, ["2020-01-01"]) == version
        cluster_base(warehouse, ["2026-01-28"])
        after = warehouse.read("base")
        assert len(after.inputFiles()) >= 16
        sizes = after.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
        assert sizes < 6000  # no file holds the hot customer alone
        assert after.agg(F.count("*"), F.sum(F.xxhash64(*before.columns).cast("decimal(38,0)"))).first() == digest
        share = {
            "source": rows_scanned(after.filter("source = 'S3'")),
            "customer": rows_scanned(after.filter("cust_id = 500")),
            "both": rows_scanned(after.filter("source = 'S3' AND cust_id = 500")),
        }
        assert share["source"] < 20000 and share["customer"] < 20000 and share["both"] < 8000, share
    finally:
        for k, value in old.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
