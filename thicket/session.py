"""Session settings that the plans rely on."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Adaptive execution splits skewed joins and sizes shuffles at run time; broadcasts stay under Spark's size limit.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(master: str | None = None, partitions: int | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; partitions sets the shuffle partitions before adaptive coalescing."""
    builder = SparkSession.builder.appName("thicket")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}), **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small where a Python task makes several numbers of each word of a row."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder inside the cluster's shared one (spark.checkpoint.dir), removed when the driver ends.

    Only a local master gets a folder of its own where the setting is absent.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="thicket-")
        spark.conf.set("spark.checkpoint.dir", found)
    path = f"{found.rstrip('/')}/thicket-{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has ended
        return


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, for results that are used more than once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
