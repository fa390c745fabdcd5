"""Files and folders, wherever Hadoop's file systems reach: local disks, HDFS, s3a, gs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession

from ..errors import TideError


class Files:
    """A folder's or a file's place, by a path as Spark takes it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark._jvm
        self._place = jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._place.getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = jvm

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self) -> bool:
        return self._fs.exists(self._place)

    def is_folder(self) -> bool:
        return self.exists() and self._fs.getFileStatus(self._place).isDirectory()

    def listed(self) -> Iterator[tuple[str, int]]:
        """All files below, or the file itself, with their sizes; hidden ones left out."""
        found = self._fs.listFiles(self._place, True)
        top = self._fs.makeQualified(self._place).toUri().getPath()
        while found.hasNext():
            status = found.next()
            path = status.getPath().toUri().getPath()
            inner = path[len(top) :].strip("/")
            if any(part[:1] in ("_", ".") for part in inner.split("/") if part):
                continue
            yield status.getPath().toString(), status.getLen()

    def qualified(self) -> str:
        """The path as listed() gives paths below it."""
        return self._fs.makeQualified(self._place).toString()

    def folders(self, prefix: str) -> list[str]:
        """The folders here whose names begin so, hidden ones too."""
        found = self._fs.listStatus(self._place) if self.exists() else []
        return [s.getPath().toString() for s in found if s.isDirectory() and s.getPath().getName().startswith(prefix)]

    def delete(self) -> None:
        self._fs.delete(self._place, True)

    def rename(self, source: str, target: str) -> None:
        place = self._at(target)
        self._fs.mkdirs(place.getParent())
        if not self._fs.rename(self._at(source), place):
            raise TideError(f"cannot rename {source} to {target}")

    def replace(self, moves: list[tuple[str, str]]) -> None:
        """Puts files that are written already in this place: what was here is renamed first, and deleted last, or put back if a move fails."""
        old = f"{self.path.rstrip('/')}.{uuid.uuid4().hex[:10]}.old"
        was_there = self.exists()
        if was_there:
            self.rename(self.path, old)
        try:
            for source, target in moves:
                self.rename(source, target)
        except Exception:
            if was_there:
                self.delete()
                self.rename(old, self.path)
            raise
        if was_there:
            self._fs.delete(self._at(old), True)

    def read(self) -> str:
        stream = self._fs.open(self._place)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, text: str, overwrite: bool) -> None:
        self.write_blocks([text.encode("utf-8")], overwrite)

    def write_blocks(self, blocks: Iterable[bytes], overwrite: bool) -> None:
        """A file of blocks, of which one is held at a time."""
        if self.exists() and not overwrite:
            raise TideError(f"{self.path} exists")
        stream = self._fs.create(self._place, overwrite)
        try:
            for block in blocks:
                stream.write(bytearray(block))
        finally:
            stream.close()
