"""The four tables as Parquet folders below one root.

A write goes to a folder of its own, ``<root>/<table>/batch=<name>/<date>=.../``, and becomes
visible only when a version file ``<root>/_versions/<n>`` lists it. That one file covers all
tables, so an ingestion run (base, archive, ledger) or a deletion (base, ledger) takes effect
as a whole or not at all, and a lost executor or driver leaves nothing half done. Plain
Parquet has no DELETE or MERGE: deletions write the affected date folders anew and swap them
in. A lakehouse format can replace this class behind the same methods.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from logledger.operators.clustering import in_curve_order
from logledger.schemas import TABLES, Table
from logledger.sources.files import FileSystem

_NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_BATCH = "batch"
_MERGED = "-merged"
_STAMP = re.compile(r"/batch=(\d{8}T\d{6})-")
# Values a condition may list: each is tested against the Bloom filter of each row group.
FEW_KEYS = 100
# File and row number of a stored row; see ``read_folders``.
ADDRESS = ("_file", "_row")


class VersionConflict(RuntimeError):
    """Another writer committed first; nothing of this commit is visible."""


@dataclass
class Change:
    """Folders a commit takes out of a table and puts in."""

    table: str
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = FileSystem(spark, self.root)
        self._states: dict[int, str] = {}

    # -- versions ---------------------------------------------------------------------

    def _version_file(self, version: int) -> str:
        return f"{self.root}/_versions/{version:012d}"

    def version(self) -> int:
        """Newest version number, -1 before ``create``."""
        names = [n for n in self.files.children(f"{self.root}/_versions") if n.isdigit()]
        # An empty file is what a writer without atomic renaming may leave: it never counted.
        while names and not self.files.size(self._version_file(int(names[-1]))):
            self.files.delete(self._version_file(int(names.pop())))
        return int(names[-1]) if names else -1

    def state(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version < 0:
            raise RuntimeError(f"no tables at {self.root}: call create() first")
        if version not in self._states:
            # Version files never change; one is kept to spare reading it again.
            self._states = {version: self.files.read(self._version_file(version))}
        return json.loads(self._states[version])

    def _write_state(self, state: dict, version: int) -> int:
        if not self.files.create(self._version_file(version), json.dumps(state)):
            raise VersionConflict(f"version {version} exists already")
        return version

    def commit(
        self,
        *changes: Change,
        based_on: int | None = None,
        reads: Iterable[str] | None = None,
        clash: Callable[[str, list[str], list[str]], bool] | None = None,
    ) -> int:
        """Applies the changes as one new version, on top of whatever is newest by then.

        based_on  the version the caller read from; None if the changes depend on nothing
        reads     the tables they depend on (the changed ones, unless given): if one of them
                  differs from ``based_on``, another writer was faster. Commits to other
                  tables are no conflict.
        clash     called for a table that differs, with the folders added and removed since:
                  whether that matters to the changes
        """
        changes = tuple(c for c in changes if c.added or c.removed)
        reads = {c.table for c in changes} if reads is None else set(reads)
        while True:
            newest = self.version()
            state = self.state(newest)
            if based_on is not None and newest != based_on:
                before = self.state(based_on)
                for table in sorted(reads):
                    old = before["tables"][table]["folders"]
                    new = state["tables"][table]["folders"]
                    added = [f for f in new if f not in set(old)]
                    removed = [f for f in old if f not in set(new)]
                    if (added or removed) and (clash is None or clash(table, added, removed)):
                        raise VersionConflict(f"{table} changed since version {based_on}")
            for change in changes:
                entry = state["tables"][change.table]
                gone = set(change.removed)
                if not gone <= set(entry["folders"]):
                    raise VersionConflict(f"folders of {change.table} are gone")
                entry["folders"] = [f for f in entry["folders"] if f not in gone] + change.added
            try:
                return self._write_state(state, newest + 1)
            except VersionConflict:
                continue  # someone took this number: look at what is newest now

    def commit_if_any(self, *changes: Change, based_on: int | None = None) -> int:
        """Like commit, but leaves the version alone if nothing changes."""
        real = [c for c in changes if c.added or c.removed]
        return self.commit(*real, based_on=based_on) if real else self.version()

    # -- table definitions ------------------------------------------------------------

    def create(self) -> Warehouse:
        """Creates the tables that do not exist yet."""
        return self._again(self._create)

    def _again(self, change: Callable[[], object]) -> Warehouse:
        """Repeats a change of table definitions until no one else takes its number."""
        while True:
            try:
                change()
                return self
            except VersionConflict:
                continue

    def _create(self) -> None:
        newest = self.version()
        state = self.state(newest) if newest >= 0 else {"tables": {}}
        missing = [t for t in TABLES.values() if t.name not in state["tables"]]
        for table in missing:
            state["tables"][table.name] = {
                "schema": table.schema.jsonValue(),
                "created_at": self.spark.sql("SELECT string(now())").first()[0],
                "folders": [],
            }
        if missing:
            self._write_state(state, newest + 1)

    def schema(self, table: str) -> StructType:
        return StructType.fromJson(self.state()["tables"][table]["schema"])

    def add_column(self, table: str, column: StructField) -> None:
        """Adds a nullable column if it is missing; old rows read as NULL there."""
        self._again(lambda: self._add_column(table, column))

    def _add_column(self, table: str, column: StructField) -> None:
        newest = self.version()
        state = self.state(newest)
        entry = state["tables"][table]
        if column.name in StructType.fromJson(entry["schema"]).names:
            return
        if not column.nullable:
            raise ValueError(f"column {column.name} must be nullable")
        entry["schema"]["fields"].append(column.jsonValue())
        self._write_state(state, newest + 1)

    def tables(self) -> DataFrame:
        """Table listing: name, type, creation time, newest first."""
        rows = [(n, "BASE TABLE", e["created_at"]) for n, e in self.state()["tables"].items()]
        listing = self.spark.createDataFrame(
            rows, "table_name string, table_type string, created_at string"
        )
        return listing.withColumn("created_at", F.col("created_at").cast("timestamp")).orderBy(
            F.desc("created_at"), "table_name"
        )

    # -- reading ----------------------------------------------------------------------

    def folders(self, table: str, dates: Iterable[str] | None = None) -> list[str]:
        """Live folders, on request only those of some partition dates."""
        live = self.state()["tables"][table]["folders"]
        if dates is None:
            return live
        wanted = set(dates)
        return [f for f in live if partition_date(f) in wanted]

    def folders_since(self, table: str, since: datetime | None) -> list[str]:
        """Live folders that may hold rows loaded at ``since`` or later: batch names begin
        with the time of their run; what has no such name is always listed. (Merged folders
        have the time of the merging run, never an earlier one than their rows.)"""
        live = self.state()["tables"][table]["folders"]
        if since is None:
            return live
        bound = f"{since:%Y%m%dT%H%M%S}"
        return [f for f in live if not (m := _STAMP.search(f)) or m[1] >= bound]

    def read(
        self, table: str, dates: Iterable[str] | None = None, since: datetime | None = None
    ) -> DataFrame:
        """A table with its columns and, if it is partitioned, its partition date. ``dates``
        and ``since`` (rows loaded then or later) leave out folders before they are listed:
        reports with a window over event or load times are handed such a part of the table.
        Their own conditions on rows stay as they are."""
        folders = self.folders(table, dates)
        if since is not None:
            recent = set(self.folders_since(table, since))
            folders = [f for f in folders if f in recent]
        return self.read_folders(table, folders)

    def read_newest(self, table: str, rows: int) -> DataFrame:
        """The newest date folders, as many as it takes to hold ``rows`` rows: all a report
        on the latest rows has to read. Row counts come from Parquet footers."""
        chosen: list[str] = []
        live = self.folders(table)
        dates = {partition_date(f) for f in live}
        for date in sorted(dates - {_NO_DATE}, reverse=True) + sorted(dates & {_NO_DATE}):
            chosen += [f for f in live if partition_date(f) == date]
            if self.read_folders(table, chosen).count() >= rows:
                break
        return self.read_folders(table, chosen)

    def find(self, table: str, column: str, values: Iterable[str]) -> DataFrame:
        """Rows with one of a few values. Row groups whose dictionary or Bloom filter says that
        they hold none of them are not read (columns in ``Table.lookup``)."""
        return self.read(table).filter(F.col(column).isin(*values))

    def read_folders(
        self,
        table: str,
        folders: list[str],
        with_batch: bool = False,
        with_address: bool = False,
    ) -> DataFrame:
        """Rows of some folders. ``with_address`` adds ADDRESS, which tells equal rows apart:
        stored files never change, so it is the same on every reading."""
        spec, schema = TABLES[table], self.schema(table)
        layout = [StructField(_BATCH, StringType())]
        if spec.partition:
            layout.append(StructField(spec.partition, DateType()))
        full = StructType(schema.fields + layout)
        if folders:
            rows = (
                self.spark.read.schema(full)
                .option("basePath", f"{self.root}/{table}")
                .parquet(*[f"{self.root}/{f}" for f in folders])
            )
        else:
            rows = self.spark.createDataFrame([], full)
        columns = [F.col(c) for c in full.names if with_batch or c != _BATCH]
        if with_address and folders:
            address = ("_metadata.file_path", "_metadata.row_index")
            columns += [F.col(c).alias(a) for c, a in zip(address, ADDRESS, strict=True)]
        elif with_address:
            types = ("string", "bigint")
            columns += [F.lit(None).cast(t).alias(a) for t, a in zip(types, ADDRESS, strict=True)]
        return rows.select(*columns)

    # -- writing ----------------------------------------------------------------------

    def stage(
        self, table: str, rows: DataFrame, batch: str, ordered: bool = False, more: bool = False
    ) -> Change:
        """Writes rows to a new batch without making them visible. Repeating it with the
        same batch name overwrites, so a retry leaves one copy. ``ordered``: the rows come
        distributed and sorted, by partition date first, and stay as they are. ``more``: the rows
        join those that the batch has; the change is all of them."""
        spec = TABLES[table]
        schema = self.schema(table)
        out = rows.select(*[_not_null(f, table) for f in schema])
        if spec.partition:
            out = out.withColumn(spec.partition, spec.partition_value())
        if ordered:
            pass
        elif spec.partition and spec.sort:
            # REBALANCE: one shuffle by date. AQE splits a date that outgrows a task and
            # joins small ones, so neither a hot date nor many small files arise.
            out = out.hint("rebalance", F.col(spec.partition))
            out = out.sortWithinPartitions(spec.partition, *spec.sort)
        elif spec.sort:
            out = out.hint("rebalance").sortWithinPartitions(*spec.sort)
        folder = f"{table}/{_BATCH}={batch}"
        writer = out.write.mode("append" if more else "overwrite").options(**_bloom_filters(spec))
        if not spec.partition:
            writer.parquet(f"{self.root}/{folder}")
            return Change(table, [folder])
        writer.partitionBy(spec.partition).parquet(f"{self.root}/{folder}")
        names = self.files.children(f"{self.root}/{folder}")
        return Change(table, [f"{folder}/{n}" for n in names if n.startswith(spec.partition)])

    def append(self, table: str, rows: DataFrame, batch: str) -> int:
        return self.commit(self.stage(table, rows, batch))

    def replace_rows(
        self, table: str, folders: list[str], rows: DataFrame, batch: str
    ) -> Change:
        """Stages rows that take the place of some folders."""
        change = self.stage(table, rows, batch)
        change.removed = list(folders)
        return change

    def replace(self, table: str, rows: DataFrame, batch: str, based_on: int) -> int:
        """CREATE OR REPLACE TABLE AS: the rows become the whole table. ``based_on`` is the
        version from before the rows were read."""
        old = self.state(based_on)["tables"][table]["folders"]
        return self.commit(self.replace_rows(table, old, rows, batch), based_on=based_on)

    def truncation(self, table: str) -> Change:
        return Change(table, removed=self.folders(table))

    def deletion(
        self,
        table: str,
        batch: str,
        where: Column | None = None,
        keys: DataFrame | None = None,
        on: str = "gcs_uri",
    ) -> Change:
        """Stages a deletion by condition, or by key set (``keys`` has the column ``on``).
        Only folders holding such rows are rewritten; finding them reads only the columns
        of the condition. A row for which the condition is NULL stays. At most FEW_KEYS keys
        become a condition that the scan can use; more are joined."""
        if keys is not None:
            some = keys.select(on).filter(F.col(on).isNotNull()).distinct()
            few = [r[0] for r in some.limit(FEW_KEYS + 1).collect()]
            if not few:
                return Change(table)
            if len(few) <= FEW_KEYS:
                where, keys = F.col(on).isin(*few), None
        rows = self.read_folders(table, self.folders(table), with_batch=True)
        if keys is None:
            doomed = rows.filter(where)
        else:
            doomed = rows.join(keys.select(on), on, "left_semi")
        touched = self.folders_of(table, doomed)
        if not touched:
            return Change(table)
        rest = self.read_folders(table, touched)
        if keys is None:
            rest = rest.filter(~F.coalesce(where, F.lit(False)))
        else:
            rest = rest.join(keys.select(on), on, "left_anti")
        return self.replace_rows(table, touched, rest, batch)

    def folders_of(self, table: str, rows: DataFrame) -> list[str]:
        """Folders the rows lie in. The result is a list of folders, never of rows."""
        spec = TABLES[table]
        found = rows.select(*[c for c in (_BATCH, spec.partition) if c]).distinct().collect()
        names = set()
        for r in found:
            name = f"{table}/{_BATCH}={r[0]}"
            if spec.partition:
                name += f"/{spec.partition}={_NO_DATE if r[1] is None else r[1].isoformat()}"
            names.add(name)
        return [f for f in self.folders(table) if f in names]

    def compact(self, table: str, batch: str, max_folders: int = 64) -> Change:
        """Stages the merger of the folders of each date that has more than max_folders, so
        that many small runs do not leave many small files. What was merged before is left
        alone: each row is written again once."""
        groups: dict[str | None, list[str]] = {}
        for folder in self.folders(table):
            if _MERGED not in folder:
                groups.setdefault(partition_date(folder), []).append(folder)
        crowded = [f for g in groups.values() if len(g) > max_folders for f in g]
        if not crowded:
            return Change(table)
        rows = self.read_folders(table, crowded)
        return self.replace_rows(table, crowded, rows, batch + _MERGED)

    def cluster(self, table: str, dates: Iterable[str], batch: str) -> Change:
        """Stages the rows of some partition dates in an order that serves each of the table's
        sort columns (``operators.clustering``), for dates too large for one file: a load sorts
        within its tasks only. Such folders count as merged."""
        spec = TABLES[table]
        folders = self.folders(table, dates)
        if not folders:
            return Change(table)
        rows = self.read_folders(table, folders, with_address=True)
        rows = in_curve_order(rows, spec.sort, [spec.partition], ADDRESS)
        change = self.stage(table, rows, batch + _MERGED, ordered=True)
        change.removed = folders
        return change

    def clean(self, keep_versions: int = 1000, min_age_hours: float = 24) -> int:
        """Removes version files but the newest ``keep_versions``, and batch folders that no
        kept version lists and that are older than ``min_age_hours`` (younger ones may belong
        to a load that has not committed yet). Returns how many folders went."""
        names = [n for n in self.files.children(f"{self.root}/_versions") if n.isdigit()]
        for name in names[:-keep_versions]:
            self.files.delete(f"{self.root}/_versions/{name}")
        live: set[str] = set()
        for name in names[-keep_versions:]:
            for entry in json.loads(self.files.read(f"{self.root}/_versions/{name}"))["tables"].values():
                live.update("/".join(f.split("/")[:2]) for f in entry["folders"])
        gone = 0
        for table in TABLES:
            for name in self.files.children(f"{self.root}/{table}"):
                folder = f"{self.root}/{table}/{name}"
                if f"{table}/{name}" not in live and self.files.age_hours(folder) > min_age_hours:
                    self.files.delete(folder)
                    gone += 1
        return gone

    # -- size -------------------------------------------------------------------------

    def storage(self) -> DataFrame:
        """Per table: size in GB, rows, last change. Sizes come from a file listing, row
        counts from Parquet footers; no column is read."""
        parts = []
        for name in TABLES:
            folders = self.folders(name)
            rows = self.read(name).agg(F.count("*").alias("row_count"))
            if folders:
                listing = self.spark.read.format("binaryFile").option(
                    "pathGlobFilter", "*.parquet"
                ).load([f"{self.root}/{f}" for f in folders])
                sizes = listing.agg(
                    F.sum("length").alias("size_bytes"),
                    F.max("modificationTime").alias("last_modified"),
                )
            else:
                sizes = self.spark.range(1).select(
                    F.lit(0).cast("bigint").alias("size_bytes"),
                    F.lit(None).cast("timestamp").alias("last_modified"),
                )
            both = sizes.unionByName(rows, allowMissingColumns=True)
            parts.append(
                both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
                    "table_name", F.lit(name)
                )
            )
        size_gb = F.round(F.coalesce("size_bytes", F.lit(0)) / 1024 / 1024 / 1024, 2)
        return (
            reduce(DataFrame.unionByName, parts)
            .orderBy(F.desc("size_bytes"), "table_name")
            .select("table_name", size_gb.alias("size_gb"), "row_count", "last_modified")
        )


def _bloom_filters(spec: Table) -> dict[str, str]:
    """Writer options: a Bloom filter in each row group for each lookup column, of the size
    that its distinct values need (2 kB to 1 MB). Parquet leaves it out where a dictionary
    holds all values, which then serves the same purpose."""
    if not spec.lookup:
        return {}
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in spec.lookup}
    sized = {"adaptive.enabled": "true", "candidates.number": "10", "max.bytes": str(1024**2)}
    return options | {f"parquet.bloom.filter.{k}": v for k, v in sized.items()}


def partition_date(folder: str) -> str | None:
    """Partition date in a folder name; None for a table without partitions."""
    last = folder.rsplit("/", 1)[-1]
    key, _, value = last.partition("=")
    return None if key == _BATCH else value


def _not_null(column: StructField, table: str) -> Column:
    """Parquet does not enforce NOT NULL; a violation stops the write here."""
    value = F.col(column.name)
    if not column.nullable:
        text = F.lit(f"{table}.{column.name} must not be NULL")
        value = F.when(value.isNull(), F.raise_error(text)).otherwise(value)
    return value.cast(column.dataType).alias(column.name)
