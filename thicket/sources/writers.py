"""Sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; mode 'append' adds files."""
    df.write.mode(mode).json(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One sorted text line a value."""
    df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").sort("value").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, skip_empty: bool = True, sep: str = ",") -> bool:
    """A CSV with header; nothing for an empty table. Tells whether it wrote."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return True


def write_documents(df: DataFrame, name: str, content: str, path: str, extension: str = "md") -> int:
    """One file a row, path/name.extension, written by the tasks; tells how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, inner = fs.FileSystem.from_uri(path)
                system.create_dir(inner, recursive=True)
                part = f"{inner}/.{n}.{uuid.uuid4().hex[:8]}"
                with system.open_output_stream(part) as f:
                    f.write((c or "").encode())
                system.move(part, f"{inner}/{n}.{extension}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return df.select(F.col(name).cast("string"), F.col(content).cast("string")).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def report(summary: DataFrame, samples: DataFrame, title: str, n: int = 5) -> dict[str, str]:
    """{'md', 'json'} of a one-row summary and the first n samples."""
    row, some = summary.first().asDict(), [r.asDict(recursive=True) for r in samples.limit(n).collect()]
    lines = [f"# {title}", "", *[f"- {k}: {v}" for k, v in row.items()], "", "## Samples", ""]
    text = "\n".join(lines + [f"- {r}" for r in some]) + "\n"
    return {"md": text, "json": json.dumps({"title": title, "summary": row, "samples": some}, ensure_ascii=False, default=str)}


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(name, sha256, size) of the files of a folder: what a run records about its inputs."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
