"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only for a local session without the setting (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (folder or _own_root()).rstrip("/")


#: the paths that the run of this context wrote
_run: ContextVar[list[str] | None] = ContextVar("tables", default=None)


@contextmanager
def run_tables() -> Iterator[list[str]]:
    """A list of the paths that materialize() writes in this block and context, for discard_tables(); other runs have lists of their own."""
    token = _run.set([])
    try:
        yield _run.get()
    finally:
        _run.reset(token)


@cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="spark-shared-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends there, and the copy survives lost executors."""
    path = shared_path(df.sparkSession, name)
    if (tables := _run.get()) is not None:
        tables.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard_tables(spark: SparkSession, tables: list[str], *keep: DataFrame) -> None:
    """Removes a run's tables, but for some, and takes them from its list."""
    kept = {file.rpartition("/")[0].rpartition("/")[2] for df in keep for file in df.inputFiles()[:1]}
    for path in [p for p in tables if p.rpartition("/")[2] not in kept]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        tables.remove(path)


def discard(df: DataFrame) -> None:
    """Removes the files of a table that materialize() wrote."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if shared_root(spark).split(":")[-1].lstrip("/") in folder.toString():
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def open_fs(path: str):
    """(pyarrow file system, path in it) for a URI or a plain path, for range reads and binary files inside tasks."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if colon and scheme in ("s3a", "s3n"):  # Hadoop's names of what pyarrow calls s3
        path = f"s3:{rest}"
    if scheme == "dbfs":  # mounted on every node
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path
