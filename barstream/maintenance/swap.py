"""Putting rewritten data in the place of old data.

Only names are moved.  A Parquet directory has no atomic exchange, so no other
job may read or write the dataset meanwhile.  Old entries are set aside first and
deleted last: whatever interrupts the exchange, both versions are still on disk,
in the ``_replaced`` and ``_rewritten`` directories of the dataset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

STREAM_LOG = "_spark_metadata"


def plain_path(spark: SparkSession, uri: str) -> str:
    """A file metadata path, which is URI-encoded, as a path for a reader."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


class Exchange:
    """One exchange on the dataset at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        run = uuid.uuid4().hex
        self.path = path.rstrip("/")
        self.rewritten = f"{self.path}/_rewritten-{run}"
        self.replaced = f"{self.path}/_replaced-{run}"
        self._jvm = spark._jvm
        root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if self._fs.exists(self._at(self.path, STREAM_LOG)):
            raise ValueError(
                f"{path} has a streaming sink's log, which names its files; "
                "write the result to a new directory with dest="
            )
        self._root = self._fs.makeQualified(root)

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def relative(self, file_uri: str) -> str:
        """A file's (or directory's) name below the dataset."""
        entry = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(file_uri))
        entry = self._fs.makeQualified(entry)
        return self._root.toUri().relativize(entry.toUri()).getPath().rstrip("/")

    def run(self, old: list[str]) -> None:
        """Set ``old`` entries aside, move the rewritten ones in, drop the old."""
        for entry in old:
            self._move(self._at(self.path, entry), self._at(self.replaced, entry))
        for entry in self._leaves(self._at(self.rewritten), ""):
            self._move(self._at(self.rewritten, entry), self._at(self.path, entry))
        for folder in (self.rewritten, self.replaced):
            self._fs.delete(self._at(folder), True)

    def _leaves(self, folder, prefix: str) -> list[str]:
        """Names of the data files below ``folder``."""
        if not self._fs.exists(folder):
            return []
        found = []
        for status in self._fs.listStatus(folder):
            name = status.getPath().getName()
            if status.isDirectory():
                found += self._leaves(status.getPath(), f"{prefix}{name}/")
            elif not name.startswith(("_", ".")):
                found.append(prefix + name)
        return found

    def _move(self, source, target) -> None:
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(source, target):
            raise OSError(f"could not move {source} to {target}")
