"""Where jobs stage tables, and the file-system calls Spark has no API for."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def stage_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the cluster's shared ``spark.checkpoint.dir``.

    Only a session on one machine without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="hitledger-")
        root = _local_roots[context.applicationId]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


class Files:
    """Hadoop file-system metadata operations (never file contents)."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = self._jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._uri = jvm.java.net.URI
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        # Paths out of ``_metadata`` are URIs, all others plain.
        if path.startswith("file:///") or "%" in path:
            return self._path(self._uri(path))
        return self._path(path)

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._at(path)).toString()

    def make_marker(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def glob(self, pattern: str) -> list[str]:
        return sorted(s.getPath().toString() for s in self._fs.globStatus(self._path(pattern)) or [])

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def folders(self, path: str) -> list[str]:
        """Names of the partition directories (``name=value``) right below ``path``."""
        return [name for s in self._list(path) if s.isDirectory() and "=" in (name := s.getPath().getName())]

    def _list(self, path: str):
        return self._fs.listStatus(self._path(path)) if self.exists(path) else []

    def levels(self, path: str) -> list[str]:
        """Names of the partition levels on the way to the first data file below ``path``; none without a file."""
        return (self.exists(path) and self._levels(self._path(path))) or []

    def _levels(self, path) -> list[str] | None:
        entries = self._fs.listStatusIterator(path)
        while entries.hasNext():
            entry = entries.next()
            name = entry.getPath().getName()
            if name[0] in "_.":
                continue
            if not entry.isDirectory():
                return []
            if "=" in name and (below := self._levels(entry.getPath())) is not None:
                return [name.split("=", 1)[0], *below]
        return None

    def write_text(self, path: str, text: str) -> None:
        """A small control file."""
        out = self._fs.create(self._path(path), True)
        out.write(text.encode())
        out.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def set_time(self, path: str, moment: datetime) -> None:
        self._fs.setTimes(self._at(path), int(moment.timestamp() * 1000), -1)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def at_once(calls: Iterable[Callable[[], None]], threads: int = 16) -> None:
    """File-system calls side by side; the first error is raised after all have ended."""
    with ThreadPoolExecutor(threads) as pool:
        for done in [pool.submit(call) for call in calls]:
            done.result()


def matching_paths(spark: SparkSession, globs: list[str]) -> list[str]:
    """Directories that exist, so that a scan of missing partitions is empty, not an error."""
    files = Files(spark, globs[0])
    return [path for glob in globs for path in files.glob(glob)]
