"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine may do without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="asiento-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for one intermediate table."""
    return f"{_OWNER.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written within are removed at its end, when results must be written.

    Without an owner they stay in the shared folder, since a plan that reads them may still run.
    """
    folder = new_path(spark, "scratch")
    token = _OWNER.set(folder)
    try:
        yield folder
    finally:
        _OWNER.reset(token)
        drop(spark, folder)


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _file_system(spark, path)
    return files.exists(at)


def mark(spark: SparkSession, path: str) -> None:
    """Leave a sign that ``exists`` finds."""
    at, files = _file_system(spark, path)
    if not files.mkdirs(at):
        raise OSError(f"cannot create {path}")


def drop(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table, if it is there."""
    at, files = _file_system(spark, path)
    files.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if there is none."""
    at, files = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(at)] if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    at, files = _file_system(spark, path)
    stream = files.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this text, whole or not at all; False if another has made it.

    On a cluster's file system a rename refuses to replace a file. Java's rename of local files
    does not, so there a second name for the draft is made instead, which does.
    """
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/draft-{uuid.uuid4().hex}"
    at, files = _file_system(spark, draft)
    if files.getScheme() == "file":
        local = at.toUri().getPath()
        target = f"{os.path.dirname(local)}/{name}"
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "x", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(local, target)
        except FileExistsError:
            return False
        finally:
            os.remove(local)
        return True
    stream = files.create(at, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(at), files.makeQualified(hadoop.Path(path)), options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
            raise
        files.delete(at, False)
        return False


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def unsized(table: DataFrame) -> DataFrame:
    """A side of a join that grows with the business, and so is sorted, never broadcast.

    Spark judges it by the bytes of its files. Compressed columns, and maps that a query unfolds from
    fewer rows, take many times that in memory, and a broadcast passes all of it through the driver.
    """
    return table.hint("merge")


def write_shared(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return the written table.

    Later jobs read files instead of recomputing the lineage, a lost executor costs one
    task, and Spark plans joins from the size of the files.
    """
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
