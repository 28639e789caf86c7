"""Folders of a table, through the file system that Spark itself reads them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """Listing, removal and renaming below one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        """Names of the entries, sorted; none where there is no such folder."""
        folder = self._path(f"{self.root}/{below}".rstrip("/"))
        return sorted(x.getPath().getName() for x in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def rename(self, name: str, to: str) -> None:
        if not self._fs.rename(self._path(f"{self.root}/{name}"), self._path(f"{self.root}/{to}")):
            raise OSError(f"cannot rename {self.root}/{name} to {to}")
