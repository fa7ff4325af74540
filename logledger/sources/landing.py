"""Raw files: NDJSON logs below one or more paths of an object store or file system."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.operators.dedup import stored
from logledger.operators.ledger import not_in_ledger
from logledger.sources.files import FileSystem, shared_folder
from logledger.sources.listing import list_files

# Files of a load whose pending files are few or far between.
NAMED = 10_000
# Files that a range of names may hold for each one that is pending.
SPARSE = 4
# Files whose names the driver holds at a time. Spark keeps a kilobyte or two for each of them.
PART = 20_000
# Bytes of small files that one task reads. Spark's setting counts each file as half a megabyte or
# so, which spreads them over a hundred times as many tasks, and archive files, as they fill.
TASK_BYTES = 64 * 1024**2
# What Spark's reader would take for a pattern.
_MARKS = str.maketrans({c: "\\" + c for c in "\\*?[]{}"})


@dataclass(frozen=True)
class Wave:
    """One load: the number of files, the files (gcs_uri), and their lines, read PART files at a
    time (``parts``) or together."""

    count: int
    files: DataFrame
    parts: Callable[[], Iterator[DataFrame]]

    @cached_property
    def lines(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts())


@dataclass(frozen=True)
class Landing:
    """
    paths           directories or globs
    file_glob       names to take
    path_pattern    regular expression the whole file path must match, or None
    modified_after  list only files changed since then ("2024-01-31T00:00:00"), or None
    files_per_wave  files one load handles at most; a longer backlog is loaded in several
    bytes_per_wave  the same for bytes
    """

    paths: tuple[str, ...]
    file_glob: str = "*.json"
    path_pattern: str | None = None
    modified_after: str | None = None
    files_per_wave: int = 100_000
    bytes_per_wave: int = 20 * 1024**4

    def _reader(self, reader):
        reader = reader.option("pathGlobFilter", self.file_glob)
        return reader.option("recursiveFileLookup", "true")

    def files(self, spark: SparkSession) -> DataFrame:
        """Non-empty raw files: gcs_uri, length, modified. Only the listing is read. Folders of a
        file system that the workers mount are listed by them, and no file passes through the
        driver; other stores, and patterns, are listed by Spark, whose driver holds every file."""
        folders = FileSystem(spark, self.paths[0]).mounted(self.paths)
        if folders:
            found = list_files(spark, folders, self.file_glob).filter("length > 0")
            if self.modified_after:
                found = found.filter(F.col("modified") > F.lit(self.modified_after).cast("timestamp"))
            return self._matching(found)
        reader = self._reader(spark.read.format("binaryFile"))
        if self.modified_after:
            reader = reader.option("modifiedAfter", self.modified_after)
        found = reader.load(list(self.paths)).select(
            F.col("_metadata.file_path").alias("gcs_uri"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
        return self._matching(found)

    def lines(self, spark: SparkSession) -> DataFrame:
        """Every line of every raw file: gcs_uri, data."""
        rows = self._reader(spark.read.format("text")).load(list(self.paths))
        return self._matching(_with_uri(rows))

    def numbered_lines(self, spark: SparkSession) -> DataFrame:
        """Lines with what is needed to find their place in the file: ``split_start``, the
        offset of the split they were read from, and ``read_id``, which rises within it."""
        rows = self._reader(spark.read.format("text")).load(list(self.paths))
        placed = rows.select(
            F.col("_metadata.file_path").alias("gcs_uri"),
            F.col("value").alias("data"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("read_id"),
        )
        return self._matching(placed)

    def one_path(self) -> Landing:
        if len(self.paths) != 1:
            raise ValueError("a stream reads one path or glob")
        return self

    def stream(self, spark: SparkSession, files_per_trigger: int = 1000) -> DataFrame:
        """Lines of files as they arrive."""
        self.one_path()
        reader = self._reader(spark.readStream.format("text"))
        rows = reader.option("maxFilesPerTrigger", files_per_trigger).load(self.paths[0])
        return self._matching(_with_uri(rows))

    def stream_files(self, spark: SparkSession, files_per_trigger: int = 1000) -> DataFrame:
        """Files as they arrive, as ``files`` lists them. None is opened."""
        self.one_path()
        reader = self._reader(spark.readStream.format("binaryFile")).schema(
            "path string, modificationTime timestamp, length bigint, content binary"
        )
        rows = reader.option("maxFilesPerTrigger", files_per_trigger).load(self.paths[0])
        found = rows.select(
            F.col("_metadata.file_path").alias("gcs_uri"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
        return self._matching(found)

    def _matching(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("gcs_uri").rlike(self.path_pattern)) if self.path_pattern else rows

    def new_files(self, spark: SparkSession, ledger: DataFrame) -> DataFrame:
        """Raw files without a ledger row."""
        return not_in_ledger(self.files(spark), ledger)

    def waves(self, pending: DataFrame, found: DataFrame | None = None) -> Iterator[Wave]:
        """Splits pending files (a stored table) into loads of bounded size. Their files are read by
        name, PART names at a time, so that neither the driver nor a plan holds more of them, and a
        file is read once at most however many loads there are. Pending files that are few or far
        between by name are loaded NAMED at a time. ``found``: the stored list of all files, pending
        or not, by which that is told; it may be older than the files."""
        spark = pending.sparkSession
        files, size, low, high = pending.agg(
            F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.min("gcs_uri"), F.max("gcs_uri")
        ).first()
        if not files:
            return
        by_range = files > NAMED
        if by_range:
            near = self.files(spark) if found is None else found
            near = near.filter(F.col("gcs_uri").between(F.lit(low), F.lit(high)))
            by_range = SPARSE * files >= near.count()
        most = self.files_per_wave if by_range else min(self.files_per_wave, NAMED)
        count = max(math.ceil(files / most), math.ceil(size / self.bytes_per_wave))
        each = math.ceil(files / count / PART)
        # In the order of their names, so that the copy an option keeps is the same.
        pending = _cut(pending, count * each)
        for number in range(count):
            own = range(number * each, number * each + each)
            wave = pending.filter(F.col("part").between(own[0], own[-1]))
            names = wave.select("gcs_uri")
            if by_range:
                if held := wave.count():
                    yield Wave(held, names, lambda wave=wave, own=own: self._parts(wave, own))
            else:
                rows = wave.select("gcs_uri", "length").collect()
                listed = _one_of([r.gcs_uri for r in rows])
                if listed:
                    lines = self._lines_of(names, listed, sum(r.length for r in rows))
                    yield Wave(len(listed), names, lambda lines=lines: iter([lines]))

    def parts(self, pending: DataFrame) -> Iterator[DataFrame]:
        """The lines of pending files (a stored table), those of about PART files at a time."""
        count = math.ceil(pending.count() / PART)
        return self._parts(_cut(pending, count), range(count))

    def _parts(self, cut: DataFrame, numbers: range) -> Iterator[DataFrame]:
        for number in numbers:
            part = cut.filter(F.col("part") == number).select("gcs_uri", "length")
            rows = part.collect()
            size = sum(r.length for r in rows)
            yield self._lines_of(part.select("gcs_uri"), _one_of([r.gcs_uri for r in rows]), size)

    def _lines_of(self, names: DataFrame, paths: list[str], size: int) -> DataFrame:
        """Lines of the files of these names. Files that are gone by now have none."""
        spark = names.sparkSession
        tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
        while paths:
            # One text: passed path by path it takes a call to Spark each.
            array = spark._jvm.java.util.regex.Pattern.compile("\n").split("\n".join(paths))
            reader = self._reader(spark.read.format("text"))
            try:
                return _with_uri(reader._df(reader._jreader.load(array))).coalesce(tasks)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
            there = names.join(self.files(spark), "gcs_uri", "left_semi")
            paths = _one_of([r[0] for r in there.collect()])
        return spark.createDataFrame([], "gcs_uri string, data string")


def _cut(files: DataFrame, count: int) -> DataFrame:
    """Adds ``part``: files by ranges of their names, from 0 on."""
    if count <= 1:
        return files.withColumn("part", F.lit(0))
    cut = files.repartitionByRange(count, "gcs_uri").withColumn("part", F.spark_partition_id())
    return stored(cut, shared_folder(files.sparkSession, "waves"))


def _one_of(names: list[str]) -> list[str]:
    """Paths by which Spark reads the files of these names, each one once."""
    return [unquote(n).translate(_MARKS) for n in dict.fromkeys(names)]


def _with_uri(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("_metadata.file_path").alias("gcs_uri"), F.col("value").alias("data")
    )
