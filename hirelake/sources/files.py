"""The few file-system calls that Spark's readers and writers do not offer, on any file system that Spark reads."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """The file system of a path and the path, with scheme."""
    sc = spark.sparkContext
    plain = sc._jvm.org.apache.hadoop.fs.Path(path)
    system = plain.getFileSystem(sc._jsc.hadoopConfiguration())
    return system, system.makeQualified(plain)


def children(spark: SparkSession, path: str) -> dict[str, float]:
    """Names directly below a folder with their modification times (seconds); none where there is no folder."""
    system, folder = _path(spark, path)
    if not system.exists(folder):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in system.listStatus(folder)}


def read_text(spark: SparkSession, path: str) -> str:
    system, file = _path(spark, path)
    stream = system.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text unless it exists, in one step; false where it exists.

    The text is written under another name first. The last step is a rename that refuses to replace, atomic on HDFS and on
    stores that rename atomically, or a hard link on local disks. A store without either needs one writer at a time.
    """
    system, target = _path(spark, path)
    folder = target.getParent()
    system.mkdirs(folder)
    url = urlparse(target.toString())
    if url.scheme == "file":
        name = unquote(url.path)
        draft = f"{name}.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(folder, f".{target.getName()}.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        keep = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(draft, target, keep)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(draft, False)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all below it."""
    system, target = _path(spark, path)
    system.delete(target, True)


def size_of(spark: SparkSession, *globs: str) -> int:
    """Bytes of all files that the patterns name or hold; only what they name is listed. None for no match."""
    total = 0
    for glob in globs:
        system, pattern = _path(spark, glob)
        total += sum(system.getContentSummary(s.getPath()).getLength() for s in system.globStatus(pattern) or [])
    return total
