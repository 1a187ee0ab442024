"""Versions that are committed by creating a file that must not exist: of two writers, one wins and the other tries again."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file with its whole content, or return False where it exists already.

    The content is written beside it and gets its name in one step: by a hard link on a local disk, elsewhere by a rename that
    refuses an existing target, as HDFS has it.  Object stores without such a rename cannot keep versions.
    """
    fs, target = _file(spark, path)
    fs.mkdirs(target.getParent())
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    if fs.getUri().getScheme() == "file":
        local, final = beside.toUri().getPath(), target.toUri().getPath()
        with open(local, "w", encoding="utf-8") as f:
            f.write(content)
        try:
            os.link(local, final)
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
        return True
    out = fs.create(beside, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    if fs.rename(beside, target):
        return True
    fs.delete(beside, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _file(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file(spark, path)
    fs.delete(target, True)


def latest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number and content of the last commit below a folder; (0, None) before the first."""
    fs, folder = _file(spark, f"{path}/_commits")
    if not fs.exists(folder):
        return 0, None
    names = (s.getPath().getName() for s in fs.listStatus(folder))
    version = max((int(n) for n in names if n.isdigit()), default=0)
    return version, read_text(spark, f"{path}/_commits/{version:012d}") if version else None


def commit(spark: SparkSession, path: str, version: int, content: str) -> bool:
    """Make `content` that version, unless another writer was first."""
    return create_once(spark, f"{path}/_commits/{version:012d}", content)


def commit_table(spark: SparkSession, path: str, write: Callable[[str | None, str], None]) -> int:
    """Commit a table that follows from the version before; returns its number.

    `write` gets the folder of that version, or None, and the folder to write.  A writer that another one overtook starts
    again from the version that won, so no rows are lost; its own folder, which no commit names, is deleted.
    """
    while True:
        version, old = latest(spark, path)
        name = uuid.uuid4().hex
        write(old and f"{path}/data/{old}", f"{path}/data/{name}")
        if commit(spark, path, version + 1, name):
            return version + 1
        remove(spark, f"{path}/data/{name}")
