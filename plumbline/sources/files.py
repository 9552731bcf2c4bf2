"""Small files and folders through Hadoop's file systems: what tables are made of, not their rows."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def listed(spark: SparkSession, folder: str) -> dict[str, dt.datetime]:
    """Names in a folder, but hidden ones, and when each was last changed; a folder that is not there holds nothing."""
    fs, where = _at(spark, folder)
    try:
        found = list(fs.listStatus(where))
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return {}
        raise
    changed = {s.getPath().getName(): s.getModificationTime() / 1000 for s in found}
    return {name: dt.datetime.fromtimestamp(at, dt.timezone.utc) for name, at in changed.items() if not name.startswith(".")}


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    fs, where = _at(spark, path)
    try:
        stream = fs.open(where)
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole, unless the name is taken: of several writers one succeeds.

    The text goes to a file of another name first, and renaming is what publishes it. That is one step where the file
    system renames in one step, as HDFS does.
    """
    fs, where = _at(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(f"{where.getParent()}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    refusing = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(where), refusing)
        return True
    except Py4JJavaError as e:
        fs.delete(temporary, False)
        if _is(e, "FileAlreadyExistsException"):
            return False
        raise


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    fs, where = _at(spark, path)
    fs.delete(where, True)
