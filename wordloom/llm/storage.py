"""Binary files that tasks write to and read from the shared folder.

Spark's own readers list the files; their bytes go through Arrow's file systems,
which know local, S3, GCS and HDFS paths by their URI.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote, urlsplit

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path in it."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


class Output:
    """A file that exists under ``uri`` only after :meth:`close`.

    Every attempt at a task writes a file of its own, so a task that runs again,
    or twice at once, never touches what another attempt has written. Readers
    learn the names from the rows of the attempt that Spark committed.
    """

    def __init__(self, folder: str, label: str, suffix: str) -> None:
        self.name = f"{label}-{uuid.uuid4().hex}{suffix}"
        self.uri = f"{folder}/{self.name}"
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        self._store, self._path = store, f"{path}/{self.name}"
        self._part = f"{path}/.{self.name}.part"
        self._file = store.open_output_stream(self._part)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._file.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._file.close()
        self._store.move(self._part, self._path)


def listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``(path, length)`` of the files of ``folder`` whose names match; nothing is read of them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").cast("bigint").alias("length"))
