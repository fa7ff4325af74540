"""Small files on the cluster's file system, by the Hadoop client Spark already carries.

Only names and pointer texts pass through here, never rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import SparkSession


class FileSystem:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        """Names of the entries of a directory; none if it does not exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def create(self, path: str, text: str) -> bool:
        """Writes a new file that appears whole or not at all; False if it is already there.

        The text goes to a name of its own first and is then renamed without overwriting.
        HDFS and the local file system do that in one step. On an object store whose
        renaming is copying, keep the tables' root on a store that offers atomic rename."""
        jvm = self._jvm
        target = self._path(path)
        draft = self._path(f"{target.getParent()}/.draft-{uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.makeQualified(target).toUri(), self._conf
        )
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never_overwrite = self._gateway.new_array(kind, 0)
        try:
            context.rename(
                self._fs.makeQualified(draft), self._fs.makeQualified(target), never_overwrite
            )
        except Exception:
            self._fs.delete(draft, False)
            if self.exists(path):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        """Removes a file or a folder with all it holds, if it is there."""
        self._fs.delete(self._path(path), True)

    def size(self, path: str) -> int:
        return self._fs.getFileStatus(self._path(path)).getLen()

    def age_hours(self, path: str) -> float:
        changed = self._fs.getFileStatus(self._path(path)).getModificationTime()
        return (self._jvm.java.lang.System.currentTimeMillis() - changed) / 3.6e6

    def rename(self, path: str, to: str) -> None:
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"cannot rename {path} to {to}")

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def set_time(self, path: str, millis: int) -> None:
        """Sets the time of change, where the store can."""
        self._fs.setTimes(self._path(path), millis, -1)

    def mounted(self, paths: Iterable[str]) -> dict[str, str] | None:
        """Path -> uri, as Spark writes it, of folders of a file system that is mounted on every
        machine; None if a path is none. Folders within another one are left out."""
        found = {}
        for text in paths:
            path = self._path(text)
            system = path.getFileSystem(self._conf)
            uri = system.makeQualified(path).toUri()
            pattern = any(c in uri.getPath() for c in "*?[]{}\\")
            if uri.getScheme() != "file" or pattern or not system.exists(path):
                return None
            if not system.getFileStatus(path).isDirectory():
                return None
            # Spark writes the files of a listing without an authority, however the folder is named.
            found[uri.getPath().rstrip("/") or "/"] = "file:" + uri.getRawPath().rstrip("/")
        inner = {p for p in found for q in found if p != q and p.startswith(q.rstrip("/") + "/")}
        return {p: u for p, u in found.items() if p not in inner}

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for run-scoped data: below ``spark.checkpoint.dir``, which a cluster
    names as its shared folder. Only in a session on one machine a local temporary folder
    may take its place; elsewhere executors would each write to a disk of their own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        return "file://" + tempfile.mkdtemp(prefix=f"logledger-{purpose}-") + "/data"
    unique = spark._jvm.java.util.UUID.randomUUID().toString()
    return f"{shared.rstrip('/')}/logledger-{purpose}-{unique}"
