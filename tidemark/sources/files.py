"""Folders and small files on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(sc._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their bytes, 0 for folders; none where there's no folder."""
    at, files = _at(spark, path)
    return {s.getPath().getName(): s.getLen() for s in files.listStatus(at)} if files.exists(at) else {}


def deleted(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.delete(at, True)


def renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Whether the name has changed: never over a file that is there."""
    at, files = _at(spark, source)
    to = _at(spark, target)[0]
    files.mkdirs(to.getParent())
    return not files.exists(to) and files.rename(at, to)


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file under another name first, so that readers see all of it or nothing; whether it wasn't there yet."""
    aside = f"{path}.writing"
    at, files = _at(spark, aside)
    out = files.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return renamed(spark, aside, path)


def get_text(spark: SparkSession, path: str) -> str:
    at, files = _at(spark, path)
    source = files.open(at)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
