"""Small files and folders of any file system Spark reaches, by way of Hadoop's own API."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: a plain one is on the default file system."""
    place, fs = _at(spark, path)
    return fs.makeQualified(place).toString()


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it is not there."""
    place, fs = _at(spark, path)
    fs.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path."""
    place, fs = _at(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory())


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if it is not there."""
    place, fs = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place, fs = _at(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(place).toUri(), conf)
    context.rename(fs.makeQualified(aside), fs.makeQualified(place), options)
