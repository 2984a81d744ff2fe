"""File-system steps Spark's readers and writers do not offer, for small files and folders."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class FileTaken(Exception):
    """The file to be created is already there."""


@dataclass(frozen=True)
class Entry:
    """A file or folder of a listing."""

    name: str
    size: int
    modified: datetime


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_files(spark: SparkSession, path: str) -> list[Entry]:
    """Files and folders directly below ``path``; none if there is no such folder."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return [
        Entry(
            status.getPath().getName(),
            status.getLen(),
            datetime.fromtimestamp(status.getModificationTime() / 1000, UTC),
        )
        for status in fs.listStatus(target)
    ]


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; ``FileTaken`` if there is one, which then stays as it is."""
    fs, target = _resolve(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        # Only that the file is there; anything else is a failure of its own.
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise FileTaken(path) from error
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)
