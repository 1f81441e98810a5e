"""Paths on any Hadoop file system: whether they exist, what is in a folder, small text files, the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, from one listing."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``, from one listing."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isFile()]


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, time of change) of every file under ``path``; empty if there is nothing."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    found, left = [], fs.listFiles(where, True)
    while left.hasNext():
        f = left.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return found


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, where = _open(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an error if it is there already."""
    fs, where = _open(spark, path)
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors see, under ``spark.checkpoint.dir``; a local one only where unset (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        top = spark.sparkContext.getCheckpointDir()
    return f"{top.rstrip('/')}/airlens/{name}-{uuid.uuid4().hex}"
