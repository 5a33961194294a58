"""Paths on any store that Spark reads, through the file-system classes Spark itself brings. Metadata calls only."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder with all in it; False when there was none."""
    p, fs = _at(spark, path)
    return bool(fs.delete(p, True))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none for a folder that does not exist."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def content_summary(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) below a path, as one call to the store; both zero when it does not exist."""
    p, fs = _at(spark, path)
    if not fs.exists(p):
        return 0, 0
    found = fs.getContentSummary(p)
    return int(found.getFileCount()), int(found.getLength())


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that must not exist yet; False when it does.

    On a local path the file appears whole or not at all. Other stores must refuse to create a file twice, as HDFS does
    and S3 does with conditional creation; there a reader may see the file before its text.
    """
    p, fs = _at(spark, path)
    if fs.getUri().getScheme() == "file":
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        temporary = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(temporary, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(temporary, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(temporary)
    try:
        stream = fs.create(p, False)
    except Exception as e:
        if re.search("FileAlreadyExists|already exists", str(e)):
            return False
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True
