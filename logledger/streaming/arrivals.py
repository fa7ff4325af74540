"""Lists of the files that arrived: the source of a stream.

A list is a Parquet file of at most as many rows as a trigger takes, below ``arrivals`` in the
stream's checkpoint. Spark remembers the lists a stream has read; which files are in one is found
by a join. So the driver holds one name for each trigger there was, not one for each file.
"""

from __future__ import annotations

import math
import time
from itertools import accumulate
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.operators.dedup import stored
from logledger.operators.ledger import not_in_ledger
from logledger.plans.ingest import LISTED, LISTED_COLUMNS
from logledger.sources.files import FileSystem

_DRAFT = "_draft-"


def _home(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/arrivals"


def arrivals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Files as they are listed, one list at a time."""
    reader = spark.readStream.schema(LISTED).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", 1).parquet(_home(checkpoint))


def list_arrivals(
    spark: SparkSession, checkpoint: str, found: DataFrame, files_per_trigger: int
) -> int:
    """Lists those of the files found that are in no list yet, oldest first, and returns their
    number. The new lists appear together."""
    home = _home(checkpoint)
    files = FileSystem(spark, home)
    files.make_folder(home)
    for name in files.children(home):
        if name.startswith(_DRAFT):  # of a call that broke off
            files.delete(f"{home}/{name}")
    found = found.select(*LISTED_COLUMNS)
    if files.children(home):
        known = spark.read.schema(LISTED).option("recursiveFileLookup", "true").parquet(home)
        found = not_in_ledger(found, known)
    draft = f"{home}/{_DRAFT}{uuid4().hex}"
    # Sorted in ranges: a file's place is its place in its range, and how many come before that.
    placed = found.orderBy("modified", "gcs_uri").withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed, f"{draft}/placed")
    part = F.shiftright("at", 33)
    sizes = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))
    total = sum(n for _, n in sizes)
    if total:
        before = accumulate((n for _, n in sizes), initial=0)
        starts = [(p, b) for (p, _), b in zip(sizes, before, strict=False)]
        starts = spark.createDataFrame(starts, "part bigint, before bigint")
        placed = placed.withColumn("part", part).join(F.broadcast(starts), "part")
        number = F.expr(f"(before + (at & {(1 << 33) - 1})) DIV {files_per_trigger}")
        lists = math.ceil(total / files_per_trigger)
        placed = placed.select(*LISTED_COLUMNS, number.alias("list")).repartition(min(lists, 200), "list")
        placed.write.partitionBy("list").parquet(f"{draft}/lists")
        # Spark takes files by the time of their change.
        now = int(time.time() * 1000)
        for k in range(lists):
            folder = f"{draft}/lists/list={k}"
            for name in files.children(folder):
                files.set_time(f"{folder}/{name}", now - lists + k)
        files.rename(f"{draft}/lists", f"{home}/{uuid4().hex}")
    files.delete(draft)
    return total
