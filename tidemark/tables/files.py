"""Directory operations on whatever file system a path names."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file; FileNotFoundError if there is none."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of the last change; 0 if there is no such file."""
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else 0.0


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless there is one of that name: then False and nothing changes.

    The file system has to rename without overwriting in one step, as HDFS does; local files are linked, which is such a step.
    """
    fs, target = _path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            none = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(fs.makeQualified(draft), fs.makeQualified(target), none)
        return True
    except (FileExistsError, Py4JJavaError):
        if not fs.exists(target):
            raise
        return False
    finally:
        fs.delete(draft, False)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def has_data(spark: SparkSession, path: str) -> bool:
    return any(not name.startswith(("_", ".")) for name in children(spark, path))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below a folder, as paths relative to it."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    base = fs.getFileStatus(p).getPath().toString().rstrip("/") + "/"
    found, listing = [], fs.listFiles(p, True)
    while listing.hasNext():
        name = listing.next().getPath().toString()[len(base):]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append(name)
    return sorted(found)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength()
