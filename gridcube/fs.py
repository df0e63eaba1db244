"""Small-file access through the Hadoop FileSystem Spark itself uses.

Only metadata goes through here (JSON records of a few kilobytes, directory
listings). Cell data is read and written by Spark jobs alone.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


OBJECT_STORES = frozenset(["s3", "s3a", "s3n", "gs", "wasb", "wasbs", "oss", "cos", "swift"])


class SharedFs:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path  # looked up once: each step to it is a call to the JVM
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._scheme = self._fs.getUri().getScheme()
        self._local = self._scheme == "file"

    @staticmethod
    def _plain(path: str) -> str:
        return path[len("file:"):] if path.startswith("file:") else path

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def list(self, path: str) -> list[tuple[str, bool, int]]:
        """(name, is_directory, modification time in ms) of each entry, by name."""
        if not self.exists(path):
            return []
        return sorted(
            (s.getPath().getName(), s.isDirectory(), s.getModificationTime())
            for s in self._fs.listStatus(self._path(path))
        )

    def size(self, path: str) -> tuple[int, int]:
        """(bytes, files) below a path."""
        if not self.exists(path):
            return 0, 0
        summary = self._fs.getContentSummary(self._path(path))
        return summary.getLength(), summary.getFileCount()

    def read_text(self, path: str) -> str:
        if self._local:
            with open(self._plain(path), encoding="utf-8") as stream:
                return stream.read()
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Create a file that must not exist yet. False if another writer was first.

        The text is staged under a private name and published by one atomic step,
        so a reader never sees half a record. Needs a file system whose rename is
        atomic and refuses an existing target (HDFS), or a local disk.
        """
        if self._scheme in OBJECT_STORES:
            raise ValueError(f"{self._scheme} does not refuse to rename onto an existing file, so two writers could both win")
        parent, name = path.rsplit("/", 1)
        staged = f"{parent}/.{name}.{uuid.uuid4().hex}"
        if self._local:
            os.makedirs(self._plain(parent), exist_ok=True)
            with open(self._plain(staged), "x", encoding="utf-8") as stream:
                stream.write(text)
            try:
                os.link(self._plain(staged), self._plain(path))
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(self._plain(staged))
        self._fs.mkdirs(self._path(parent))
        stream = self._fs.create(self._path(staged), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not self.exists(path) and self._fs.rename(self._path(staged), self._path(path)):
            return True
        self.delete(staged)
        return False

    def make(self, path: str) -> None:
        """A folder, if there is none yet."""
        self._fs.mkdirs(self._path(path))

    def move(self, path: str, target: str) -> None:
        self._fs.mkdirs(self._path(target.rsplit("/", 1)[0]))
        if not self._fs.rename(self._path(path), self._path(target)):
            raise OSError(f"cannot move {path} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
