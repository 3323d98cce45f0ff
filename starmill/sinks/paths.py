"""Folders of written tables: does one exist, move one, remove one."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _at(spark, path)
    return files.exists(folder)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder."""
    files, folder = _at(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]


def make(spark: SparkSession, path: str) -> None:
    files, folder = _at(spark, path)
    files.mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if it is not there."""
    files, folder = _at(spark, path)
    files.delete(folder, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one."""
    files, folder = _at(spark, source)
    _, place = _at(spark, target)
    files.delete(place, True)
    if not files.rename(folder, place):
        raise OSError(f"cannot move {source} to {target}")


def files_below(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Names of the data files below a folder by their directory's path from it."""
    files, folder = _at(spark, path)
    base, found = files.makeQualified(folder).toUri().getPath(), {}
    listing = files.listFiles(folder, True)
    while listing.hasNext():
        file = listing.next().getPath()
        if not file.getName().startswith(("_", ".")):
            directory = file.getParent().toUri().getPath().removeprefix(base).strip("/")
            found.setdefault(directory, []).append(file.getName())
    return found
