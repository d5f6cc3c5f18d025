"""Folders of a table: what is in them, and moving whole ones. Names only; data stays with the tasks."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """The file system that holds ``root``; paths are below it."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def names(self, name: str = "", prefix: str = "") -> list[str]:
        """Names in a folder that begin with ``prefix``; none if it is missing."""
        if not self.exists(name):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self.fs.listStatus(self._path(name)))
                      if n.startswith(prefix))

    def make(self, name: str = "") -> None:
        self.fs.mkdirs(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def move(self, name: str, to: str) -> None:
        """Put a folder where ``to`` says, instead of what is there."""
        self.delete(to)
        self.fs.mkdirs(self._path(to).getParent())
        if not self.fs.rename(self._path(name), self._path(to)):
            raise OSError(f"could not move {self.root}/{name} to {to}")

    def read_text(self, name: str) -> str | None:
        """A small file's text."""
        if not self.exists(name):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str, replace: bool = True) -> None:
        """Write a small file; with ``replace=False`` an existing one raises, so only one writer can create it."""
        stream = self.fs.create(self._path(name), replace)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
