"""Tables between the passes of an operator, and names that clash with nothing."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.sources.files import FileSystem, shared_folder

#: Rows of text that go to Python at once: texts may be long.
TEXTS_PER_BATCH = 256


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written below the cluster's shared folder and read back: its lineage ends
    here, and a lost executor costs nothing that is already written."""
    folder = shared_folder(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(folder)
    held = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    held.staged_in = folder
    return held


def discard(*frames: DataFrame, shuffles: bool = True) -> None:
    """Removes stored tables that no later pass reads. Files of the shuffles that made them go
    too: Spark removes those when the driver has collected its garbage, so it is asked to."""
    spark = frames[0].sparkSession
    for frame in frames:
        FileSystem(spark, frame.staged_in).delete(frame.staged_in)
    if shuffles:
        gc.collect()
        spark._jvm.System.gc()


#: Rows up to which a table of keys of some 32 bytes is broadcast: 16 MB.
SMALL_KEYS = 500_000


def if_small(keys: DataFrame) -> DataFrame:
    """A stored table of short keys, marked for broadcasting if its rows are within the bound."""
    return F.broadcast(keys) if keys.count() <= SMALL_KEYS else keys


def free_name(frame: DataFrame, name: str) -> str:
    """A column name the frame does not have yet."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fixed(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once: it comes out of a generator, so that no filter on
    it is pushed below with the whole expression in it, to be computed again per element."""
    return frame.select("*", F.explode(F.array(value)).alias(name))


def text_batches(spark: SparkSession) -> None:
    """Bounds the memory of Python workers by small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))


def rows_at_once(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """For actions inside: so many rows go to Python at once, where a row holds a block of data."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def groups_at_once(spark: SparkSession, groups: int) -> AbstractContextManager[None]:
    """For actions inside: a task that gathers lists holds those of so many groups in memory, and
    sorts its rows by group if there are more. Spark holds 128, however long they are."""
    return _setting(spark, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", groups)


@contextmanager
def _setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_digest(text: str = "text") -> Column:
    """Names a text: 32 bytes, null for null."""
    return F.unhex(F.sha2(F.encode(F.col(text), "UTF-8"), 256))
