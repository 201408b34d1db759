"""Paths on the session's file system: where work files go, and the few driver-side file operations we need."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

SHARED_DIR = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}
_handed_out: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may do without the setting; it gets a temporary folder of its own.
    """
    configured = spark.conf.get(SHARED_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="logtally-")
    return _local_roots[application]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created there yet."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def literal(path: str) -> str:
    """A path for Spark's readers, which would take some of its characters for a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the folders that ``fresh_dir`` has handed out in this session. What was read from them must be done with."""
    for path in _handed_out.pop(spark.sparkContext.applicationId, []):
        Files(spark, path).delete(path)


class Files:
    """File operations through Hadoop's file system API, so that they work on every store Spark can reach."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, folder: str) -> list[str]:
        """Names in a folder, none if it isn't there. The path is taken literally, whatever characters it has."""
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(folder)))

    def modified_millis(self, path: str) -> int:
        """Of the last change, by the store's clock."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime()

    def set_modified(self, path: str, millis: int) -> None:
        self._fs.setTimes(self._path(path), millis, -1)

    def age_seconds(self, path: str) -> float:
        """Since the last change, by the store's clock and this driver's."""
        return time.time() - self.modified_millis(path) / 1000

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def file_count(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getFileCount()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write a new small file so that readers see it whole or not at all; an existing one is an error.

        On file systems whose rename is atomic and refuses an existing target, as HDFS and local disks, one of several
        publishers wins. An object store gives no such promise; there, keep one writer per ledger or table.
        """
        if self.exists(path):
            raise FileExistsError(path)
        parent, name = path.rsplit("/", 1)
        hidden = f"{parent}/.{name}-{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(hidden), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not self._fs.rename(self._path(hidden), self._path(path)):
            self._fs.delete(self._path(hidden), False)
            raise FileExistsError(path)

    def rename(self, path: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        self._fs.rename(self._path(path), self._path(target))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
