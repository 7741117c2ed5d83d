"""Folders on the session's file systems, through Hadoop's interface on the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """One folder, and what has to be done with it as a whole."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _inside(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def exists(self, name: str | None = None) -> bool:
        return self._files.exists(self._at if name is None else self._inside(name))

    def names(self) -> list[str]:
        """Names of what lies directly in it; none if it is not there."""
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._at)) if self.exists() else []

    def text(self, name: str) -> str:
        """A small file in it, whole."""
        stream = self._files.open(self._inside(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def mark(self, name: str) -> bool:
        """Create an empty file, whole or not at all; False if it was there."""
        self._files.mkdirs(self._at)
        return self._files.createNewFile(self._inside(name))

    def rename_to(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not self._files.rename(self._at, target):
            raise OSError(f"{self.path} could not be renamed to {path}")

    def delete(self, name: str | None = None) -> None:
        self._files.delete(self._at if name is None else self._inside(name), True)

    @property
    def qualified(self) -> str:
        """Its path as Spark's readers show it before the names of files in it."""
        return self._files.makeQualified(self._at).toString()

    @property
    def parent(self) -> Folder:
        return Folder(self.spark, self._at.getParent().toString())

    @property
    def name(self) -> str:
        return self._at.getName()
