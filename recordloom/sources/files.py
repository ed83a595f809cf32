"""Folders and small marker files, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as a plain one, if it lies on a mounted file system; else None."""
    place, system = _opened(spark, path)
    uri = system.makeQualified(place).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders in a folder, in order of their names; none if it does not exist."""
    place, system = _opened(spark, path)
    if not system.exists(place):
        return []
    return sorted(str(s.getPath()) for s in system.listStatus(place) if s.isDirectory())


def folders_with(spark: SparkSession, path: str, mark: str) -> list[str]:
    """Those that hold a file named `mark`."""
    found = []
    for folder in folders(spark, path):
        place, system = _opened(spark, f"{folder}/{mark}")
        if system.exists(place):
            found.append(folder)
    return found


def drop(spark: SparkSession, path: str) -> None:
    place, system = _opened(spark, path)
    system.delete(place, True)


def read_mark(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if it does not exist."""
    place, system = _opened(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_mark(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and rename it over the old one: readers see either."""
    place, system = _opened(spark, path)
    fresh, _ = _opened(spark, f"{path}.new")
    stream = system.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, place, options)
