"""What a run did: rows read and written, digests, settings and time of each step.

Counts are observed on the rows as they pass (``DataFrame.observe``), so they
come with the jobs that the step runs anyway and nothing is read twice for them.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG = "at int, step string, rows long, skipped boolean, rows_read long, digest string, seconds double, error string, settings string"


def row_digest(df: DataFrame) -> Column:
    """An aggregate that is equal for equal rows in any order and partitioning; repeated rows count."""
    plain = [F.col(f"`{f.name}`") if "map<" not in f.dataType.simpleString() else F.col(f"`{f.name}`").cast("string") for f in df.schema]
    return F.hex(F.sum(F.xxhash64(*plain).cast("decimal(38,0)")).cast("string").cast("binary"))


class RunLog:
    """Collects a row for each step; a step that fails has its error and leaves those before it."""

    def __init__(self, spark: SparkSession, **settings: object):
        self.spark, self.settings, self.rows = spark, json.dumps(settings, sort_keys=True, default=str), []
        self._read: list[Observation] = []
        self._written: list[Observation] = []

    @contextmanager
    def step(self, name: str, skipped: bool = False) -> Iterator[RunLog]:
        self._read, self._written, began, error = [], [], time.monotonic(), None
        try:
            yield self
        except Exception as e:
            error = f"{type(e).__name__}: {e}"[:1000]
            raise
        finally:
            done = [] if error or skipped else [o.get for o in self._written]
            read = [] if error or skipped else [o.get for o in self._read]
            seconds = round(time.monotonic() - began, 3)
            self.rows.append((len(self.rows), name, sum(d["rows"] for d in done[:1]), skipped, sum(d["rows"] for d in read), done[0]["digest"] if done else None, seconds, error, self.settings))

    def read(self, df: DataFrame) -> DataFrame:
        """df, whose rows are counted where they are read; use it in one plan."""
        seen = Observation()
        self._read.append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def written(self, df: DataFrame) -> DataFrame:
        """df, whose rows are counted and digested where they are written; the first one of a step is its result."""
        seen = Observation()
        self._written.append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), row_digest(df).alias("digest"))

    def write(self, df: DataFrame, path: str) -> None:
        self.written(df).write.mode("overwrite").parquet(path)

    def frame(self) -> DataFrame:
        """(at, step, rows, skipped, rows_read, digest, seconds, error, settings) of the steps so far."""
        return self.spark.createDataFrame(self.rows, LOG)

    def save(self, path: str) -> None:
        """Adds the steps to a log of runs."""
        self.frame().coalesce(1).write.mode("append").json(path)
