"""Files below mounted folders, listed by the workers.

Spark's own listing ends in its driver, which keeps some kilobytes for every file. Here a task lists
a folder and hands its files out as rows; the driver holds folders only. Names, hidden files and
links are treated as Spark's listing treats them.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Workers that do not have this package get the code with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROWS = 10_000
_FOLDERS = "path string, uri string"
_FILES = "gcs_uri string, name string, length bigint, modified timestamp"
# ASCII characters that a path keeps in a uri, beside letters and digits.
_KEPT = "_-!.~'()*,;:$&+=@"


def uri_name(name: str) -> str:
    """A file name as Spark writes it in a uri: characters beyond ASCII stay, but blanks and
    control characters do not."""
    if name.isascii():
        return quote(name, safe=_KEPT)
    kept = (c > "\x7f" and unicodedata.category(c) not in ("Cc", "Zs", "Zl", "Zp") for c in name)
    return "".join(c if k else quote(c, safe=_KEPT) for c, k in zip(name, kept, strict=True))


def _entries(path: str) -> Iterator[os.DirEntry]:
    """Entries that are not hidden; none if the folder is gone."""
    try:
        with os.scandir(path) as entries:
            for entry in entries:
                name = entry.name
                hidden = name.startswith("_") and "=" not in name
                if not (hidden or name.startswith(".") or name.endswith("._COPYING_")):
                    yield entry
    except FileNotFoundError:
        return


def _folders_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, uri in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            below = [e.name for e in _entries(path) if e.is_dir()]
            paths = [f"{path.rstrip('/')}/{n}" for n in below]
            yield pa.RecordBatch.from_pydict(
                {
                    "path": pa.array(paths, pa.string()),
                    "uri": pa.array([f"{uri}/{uri_name(n)}" for n in below], pa.string()),
                }
            )


def _files_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {
        "gcs_uri": pa.string(),
        "name": pa.string(),
        "length": pa.int64(),
        "modified": pa.timestamp("us", "UTC"),
    }

    def rows(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(kinds))

    held = []
    for batch in batches:
        for path, uri in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for entry in _entries(path):
                try:
                    if not entry.is_file():
                        continue
                    stat = entry.stat()
                except FileNotFoundError:
                    continue  # it went meanwhile
                changed = stat.st_mtime_ns // 1_000_000 * 1000
                held.append((f"{uri}/{uri_name(entry.name)}", entry.name, stat.st_size, changed))
                if len(held) >= _ROWS:
                    yield rows(held)
                    held = []
    if held:
        yield rows(held)


def _frame(spark: SparkSession, folders: list[tuple[str, str]]) -> DataFrame:
    """As few tasks as there are folders, some for each core at most."""
    tasks = min(len(folders), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame(spark.sparkContext.parallelize(folders, tasks), _FOLDERS)


def list_files(spark: SparkSession, roots: dict[str, str], file_glob: str) -> DataFrame:
    """(gcs_uri, length, modified) of the files below the folders (path -> uri) whose names match."""
    level, every = list(roots.items()), []
    while level:
        every += level
        level = [tuple(r) for r in _frame(spark, level).mapInArrow(_folders_task, _FOLDERS).collect()]
    found = _frame(spark, every).mapInArrow(_files_task, _FILES)
    glob = spark._jvm.org.apache.hadoop.fs.GlobPattern(file_glob).compiled().pattern()
    found = found.filter(F.col("name").rlike(f"(?s)^(?:{glob})$"))
    return found.select("gcs_uri", "length", "modified")
