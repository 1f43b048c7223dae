"""Shared folder, materialised tables and Arrow batch limits.

Lineage is cut by writing a table under ``spark.checkpoint.dir``, which every
executor of a cluster can read; a folder of our own is used only where that
setting is absent, as in tests.  Nothing is kept in a machine-local temporary
folder, so a lost executor loses no intermediate result.
"""

from __future__ import annotations

import atexit
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of an Arrow batch handed to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; on a local master a folder of our own where none is set."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="thicket-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder inside the shared folder; removed when the driver ends."""
    path = f"{shared_folder(spark)}/thicket-{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any Hadoop file system; silent when the session is gone."""
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:
        return


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.thicket_path = path
    return out


def table_bytes(df: DataFrame) -> int:
    """Bytes of the files behind df as Spark estimates them, without reading any; 0 where it cannot tell."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def release(df: DataFrame) -> None:
    """Deletes the files of a materialised table that nothing reads any more."""
    remove(df.sparkSession, df.thicket_path)


def bounded_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Gives freed memory of a worker back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """An Arrow function that gives freed memory back, now and then and at its end; idle workers stay small."""

    @wraps(run)
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for i, out in enumerate(run(batches), 1):
                yield out
                if i % 16 == 0:
                    release_memory()
        finally:
            release_memory()

    return go


def open_shared(path: str, mode: str):
    """A file of the shared folder in a Python worker: a local path or any pyarrow file system."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        if "w" in mode:
            os.makedirs(os.path.dirname(url.path), exist_ok=True)
        return open(url.path, mode)
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_output_stream(inner) if "w" in mode else system.open_input_file(inner)


def commit_shared(part: str, final: str) -> None:
    """Gives a finished file its name in one step; a repeated task replaces it by the same bytes."""
    url = urlparse(part)
    if url.scheme in ("", "file"):
        os.replace(url.path, urlparse(final).path)
        return
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(part)
    system.move(inner, fs.FileSystem.from_uri(final)[1])
