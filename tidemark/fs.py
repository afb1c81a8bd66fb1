"""Metadata operations on the Hadoop file system behind a path.

Only names, markers and control events pass through here, never data.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _handle(spark, path)
    return fs.exists(hpath)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; empty when it does not exist."""
    fs, hpath = _handle(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hpath))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, hpath = _handle(spark, pattern)
    found = fs.globStatus(hpath)
    return sorted(status.getPath().toString() for status in found) if found else []


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, hpath = _handle(spark, path)
    fs.mkdirs(hpath)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, hsource = _handle(spark, source)
    if not fs.rename(hsource, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> bool:
    """Remove ``path`` and what is below it; False when there was nothing."""
    fs, hpath = _handle(spark, path)
    return fs.delete(hpath, True)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of its text, unless there is one; False if there was.

    It is written under another name and takes its own in one step that fails
    when the name is taken: a link on a local file system, whose rename would
    overwrite, a rename elsewhere.
    """
    fs, hpath = _handle(spark, path)
    folder = hpath.getParent()
    fs.mkdirs(folder)
    aside = spark._jvm.org.apache.hadoop.fs.Path(folder, f".new-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(aside.toUri().getPath(), hpath.toUri().getPath())
        else:
            hadoop = spark._jvm.org.apache.hadoop.fs
            overwrite = getattr(hadoop, "Options$Rename")
            context = hadoop.FileContext.getFileContext(fs.getUri(),
                                                        spark._jsc.hadoopConfiguration())
            context.rename(aside, fs.makeQualified(hpath),
                           spark.sparkContext._gateway.new_array(overwrite, 0))
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as failure:
        if "FileAlreadyExistsException" in str(failure.java_exception):
            return False
        raise
    finally:
        fs.delete(aside, False)
