"""Binary files in the shared folder, written and read by tasks.

Names are unique to an attempt, and a file counts only if the task's result names it: the rest
of a lost or repeated task is never read.
"""

from __future__ import annotations

import os
import uuid
from typing import BinaryIO
from urllib.parse import unquote, urlparse


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else uri
    return None


def new_name(folder: str, kind: str) -> str:
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}.{kind}"


def create(uri: str) -> BinaryIO:
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow.fs import FileSystem

    store, path = FileSystem.from_uri(uri)
    return store.open_output_stream(path)


def read(uri: str) -> BinaryIO:
    path = _local(uri)
    if path is not None:
        return open(path, "rb")
    from pyarrow.fs import FileSystem

    store, path = FileSystem.from_uri(uri)
    return store.open_input_file(path)
