"""Files below a folder, matched by suffix and exact name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def match_paths(paths: DataFrame, column: str, suffix: str, name: str | None = None) -> DataFrame:
    """Rows whose path ends in ``suffix`` and, if given, is named ``name``."""
    base = base_name(F.col(column))
    hit = base.endswith(suffix)
    return paths.where(hit if name is None else hit & (base == name))


def match_files(spark: SparkSession, root: str, suffix: str, name: str | None = None) -> DataFrame:
    """All matching files and folders below ``root``: ``path``, ``length`` (0 for a
    folder), ``folder``; contents are not read, names that begin with a dot or an
    underscore count.

    The driver walks the folders, as every listing does, and goes into none that
    matches: a container may be a folder.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    filesystem = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found, open_now = [], [hadoop]
    while open_now:
        for status in filesystem.listStatus(open_now.pop()):
            path, folder = status.getPath(), status.isDirectory()
            base = path.getName()
            if base.endswith(suffix) and (name is None or base == name):
                found.append((path.toString(), 0 if folder else status.getLen(), folder))
            elif folder:
                open_now.append(path)
    return spark.createDataFrame(found, "path string, length long, folder boolean").orderBy("path")
