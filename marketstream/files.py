"""Small files beside tables, in whatever store Spark reads: listing, reading, and writing a
name that must not be taken."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return bool(files.exists(at))


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    files, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, at = _at(spark, path)
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``path`` in one move; False, and nothing changed, if it exists already."""
    files, at = _at(spark, path)
    files.mkdirs(at.getParent())
    draft = _at(spark, f"{at.getParent().toString()}/.{uuid.uuid4().hex}")[1]
    out = files.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    # a move to a name that is taken fails
    if not files.exists(at) and files.rename(draft, at):
        return True
    files.delete(draft, False)
    return False
