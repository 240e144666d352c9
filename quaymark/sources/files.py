"""Small texts and folders through the file system that holds them: manifests, pointers, run states."""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _located(spark, path)
    return system.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, sorted; none if there is no such folder."""
    where, system = _located(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    where, system = _located(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a file or folder another name on the file system that holds it."""
    where, system = _located(spark, path)
    if not system.rename(where, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{path} could not be moved to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if it isn't there."""
    where, system = _located(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place in one step: a reader sees the old text or the new one, never a part."""
    beside = f"{path}.{uuid.uuid4().hex}"
    where, system = _located(spark, beside)
    stream = system.create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE
    context = fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(where, fs.Path(path), flags)
