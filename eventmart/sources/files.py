"""File operations on whatever file system a path belongs to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists (local, HDFS, object store)."""
    system, hadoop_path = _system(spark, path)
    return system.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove ``path`` with what is in it; nothing happens if it is missing."""
    system, hadoop_path = _system(spark, path)
    system.delete(hadoop_path, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    system, old_path = _system(spark, old)
    _, new_path = _system(spark, new)
    if not system.rename(old_path, new_path):
        raise OSError(f"could not rename {old} to {new}")


def number_in(spark: SparkSession, path: str, first: int) -> int:
    """The number a small file holds; the file is made with ``first`` if missing."""
    system, hadoop_path = _system(spark, path)
    if system.exists(hadoop_path):
        source = system.open(hadoop_path)
        try:
            return source.readLong()
        finally:
            source.close()
    target = system.create(hadoop_path, False)
    try:
        target.writeLong(first)
    finally:
        target.close()
    return first


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in the folder ``path``; none if it is missing."""
    system, hadoop_path = _system(spark, path)
    if not system.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in system.listStatus(hadoop_path)]


def read_text(spark: SparkSession, path: str) -> str:
    system, hadoop_path = _system(spark, path)
    stream = system.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` appear whole; False if it is there already.

    The text is written aside first; the rename that shows it fails where the
    name is taken.
    """
    context = spark.sparkContext
    jvm = context._jvm
    system, hadoop_path = _system(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    place = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hadoop_path.toUri(), context._jsc.hadoopConfiguration()) \
        if hadoop_path.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(context._jsc.hadoopConfiguration())
    none = context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        place.rename(aside, hadoop_path, none)
    except Py4JJavaError as failed:
        system.delete(aside, False)
        if "FileAlreadyExistsException" in failed.java_exception.getClass().getName() or system.exists(hadoop_path):
            return False
        raise
    return True
