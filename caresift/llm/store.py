"""Binary files in shared storage, written and read by tasks.

Every task attempt writes files of its own name; the table that names the
files of the attempts that succeeded decides what is read. Files of lost
attempts are never named, so a rerun task cannot damage a result.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.session import scratch_path

#: Bytes of stored files that one reading task is given.
BYTES_PER_TASK = 8 << 20


def open_store(uri: str):
    """The file system of ``uri`` (local, or any that pyarrow knows) and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:") :].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared scratch space, created."""
    uri = scratch_path(spark, label)
    store, path = open_store(uri)
    store.create_dir(path, recursive=True)
    return uri


def new_file(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def tasks_for(df: DataFrame, size_column: str, bytes_per_task: int = BYTES_PER_TASK) -> int:
    """How many tasks the stored bytes of an index call for."""
    total = df.agg(F.sum(size_column)).first()[0] or 0
    return max(1, math.ceil(total / bytes_per_task))
