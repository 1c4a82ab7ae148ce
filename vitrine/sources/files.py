"""Small questions to the file system that holds a path, whichever it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries in order, hidden ones left out; none if it is not there."""
    fs, at = _at(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n for n in names if not n.startswith("."))


def create(spark: SparkSession, path: str, text: str = "") -> None:
    """A new small file; an error if it is there already.

    The text is written under another name first, so that nobody reads half of it.
    """
    fs, at = _at(spark, path)
    if fs.exists(at):
        raise FileExistsError(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, at):
        raise FileExistsError(path)


def text_of(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)
