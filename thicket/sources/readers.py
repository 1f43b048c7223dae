"""Sources: catalogue JSON, CSV, text folders, JSON lines, HTML links, folder profiles, state."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from thicket.operators.documents import latest
from thicket.session import stored


def page_sizes(total: int, size: int) -> list[int]:
    """Rows to ask for on each page; the last asks for the remainder."""
    n = math.ceil(total / size) if size > 0 else 0
    return [size if i < n - 1 else total - size * (n - 1) for i in range(n)]


#: Pages of a partition.
PAGES = 64


class PagedSource(DataSource):
    """A paged service as a table: one partition for each PAGES pages.

    Option 'fetcher' names module:function(page, size, options) -> {totalFilas,
    tamanioPagina, resultados: [rows]}.  The first page is asked for with
    'pagesize' rows and says how many there are; the last page asks for the rest.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self):
        return self.options["schema"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def _page(self, page: int, size: int) -> dict:
        import importlib

        module, _, function = self.options["fetcher"].partition(":")
        return with_retries(lambda: getattr(importlib.import_module(module), function)(page, size, self.options))

    def partitions(self):
        first = self._page(1, int(self.options.get("pagesize", 1000)))
        sizes = page_sizes(int(first["totalFilas"]), int(first["tamanioPagina"]))
        pages = list(enumerate(sizes, 1))
        return [InputPartition(pages[lo : lo + PAGES]) for lo in range(0, len(pages), PAGES)]

    def read(self, partition) -> Iterator[tuple]:
        for page, size in partition.value:
            yield from self._page(page, size)["resultados"]


def retryable(e: Exception) -> bool:
    """Busy and unreachable services: status 429 or 5xx, time-outs and lost connections."""
    status = getattr(e, "status", None)
    return status == 429 or status is not None and 500 <= status < 600 or status is None and isinstance(e, (OSError, TimeoutError))


def with_retries(call: Callable, retries: int = 3, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random, again: Callable[[Exception], bool] = retryable):
    """Calls again after 2**n seconds plus jitter, or after the failure's own retry_after; other failures are raised at once."""
    for n in range(retries + 1):
        try:
            return call()
        except Exception as e:
            if n == retries or not again(e):
                raise
            sleep(float(getattr(e, "retry_after", 0) or 2**n + jitter()))


def look_up(keys: DataFrame, key: str, fetch: Callable[[str], str | None], concurrency: int = 8) -> DataFrame:
    """(key, json): one call a distinct key, at most concurrency at a time; a failing call gives null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k in b.column(0).to_pylist():
                try:
                    out.append(with_retries(lambda k=k: fetch(k)))
                except Exception:  # the service is foreign; a missing answer is a null here
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [key, "json"])

    return keys.select(F.col(key).cast("string")).filter(F.col(key).isNotNull()).distinct().repartition(concurrency, key).mapInArrow(run, f"{key} string, json string")


def catalogue(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Records of all pages with 'resultados', by nregistro; of a repeated key the record of the last page."""
    reader = spark.read.option("multiLine", True)
    pages = (reader.schema(schema) if schema else reader).json(path).select("*", F.col("_metadata.file_name").alias("_file"))
    rows = pages.filter(F.col("resultados").isNotNull()).select("_file", F.posexplode("resultados").alias("_at", "r")).select("_file", "_at", "r.*")
    number = F.regexp_extract("_file", r"(\d+)\D*$", 1).try_cast("int")
    return latest(rows.withColumn("_page", number), "nregistro", F.desc_nulls_last("_page"), F.desc("_file"), F.desc("_at")).drop("_file", "_at", "_page")


def json_value(c: Column, schema: str) -> Column:
    """A JSON text as a struct; null where it does not parse."""
    return F.from_json(c, schema)


def json_source(spark: SparkSession, source: str, schema: str) -> DataFrame:
    """The rows of a JSON file, or of a JSON text where no such file exists; a text that is neither raises ValueError."""
    if not source.lstrip().startswith(("{", "[")):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return spark.read.schema(schema).option("multiLine", True).json(source)
    try:
        json.loads(source)
    except ValueError as e:
        raise ValueError(f"neither a file nor JSON: {source[:80]!r}") from e
    kind = "array<struct<{}>>" if source.lstrip().startswith("[") else "struct<{}>"
    fields = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in StructType.fromDDL(schema))
    row = spark.range(1).select(F.from_json(F.lit(source), kind.format(fields)).alias("v"))
    return row.select(F.explode("v").alias("v")).select("v.*") if kind.startswith("array") else row.select("v.*")


def lookup_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A ';' file of strings; of a repeated key the first row of the file."""
    rows = spark.read.option("header", True).option("sep", ";").csv(path).withColumn("position", F.monotonically_increasing_id())
    return latest(rows, key, F.asc("position"))


def text_folder(spark: SparkSession, path: str, pattern: str = "*.md", recursive: bool = False) -> DataFrame:
    """(name, path, content) of each file; name without its extension."""
    rows = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive)
    return rows.select(F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias("name"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def json_lines(spark: SparkSession, path: str, schema: str | None = None, n: int | None = None) -> DataFrame:
    rows = (spark.read.schema(schema) if schema else spark.read).json(path)
    return rows.limit(n) if n else rows


def links(html: Column) -> Column:
    """href values of the links of a page, in order; in double, single or no quotes."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, r"""^["']|["']$""", ""))


def follow_interstitial(pages: DataFrame, part: str, base: str, fetch: Callable[[str], bytes | None], concurrency: int = 8) -> DataFrame:
    """(id, link, content): of pages(id, html) the first link that holds part is fetched; null without a link or an answer."""
    found = pages.select(F.col("id").cast("string").alias("id"), first_link(F.col("html"), part, base).alias("link"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for link in b.column(1).to_pylist():
                try:
                    out.append(with_retries(lambda link=link: fetch(link)) if link else None)
                except Exception:  # the service is foreign; a missing answer is a null here
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["id", "link", "content"])

    return found.repartition(concurrency, "id").mapInArrow(run, "id string, link string, content binary")


def first_link(html: Column, part: str, base: str = "") -> Column:
    """The first link that holds part, after base; null without one."""
    found = F.get(F.filter(links(html), lambda x: F.contains(x, F.lit(part))), F.lit(0))
    return F.when(found.isNotNull(), F.concat(F.lit(base), found))


def folder_profile(spark: SparkSession, path: str) -> DataFrame:
    """(dir, files, mb) of each folder; hidden files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    named = files.filter(~F.rlike("path", F.lit(r"/\.[^/]*$"))).select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), "length")
    return named.groupBy("dir").agg(F.count("*").alias("files"), F.round(F.sum("length") / 1e6, 3).alias("mb"))


def convert_files(spark: SparkSession, path: str, convert: Callable[[bytes], str], pattern: str = "*.pdf") -> DataFrame:
    """(name, text, error): files through a converter in the tasks; a file that fails gives its error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for name, content in zip(f["path"], f["content"]):
                try:
                    rows.append((name.rsplit("/", 1)[-1].rsplit(".", 1)[0], convert(content), None))
                except Exception as e:  # the converter is foreign code; its failure is data here
                    rows.append((name.rsplit("/", 1)[-1].rsplit(".", 1)[0], None, str(e)))
            yield pd.DataFrame(rows, columns=["name", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "name string, text string, error string")


def state(spark: SparkSession, path: str, schema: str, defaults: dict) -> dict:
    """The one row of a state table; the defaults where it is absent or unreadable."""
    try:
        row = spark.read.schema(schema).json(path).first()
    except Exception:  # a damaged state file means a fresh start
        row = None
    return defaults | {k: v for k, v in (row.asDict() if row else {}).items() if v is not None}


def line_rows(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of a text file or folder; a stream of them with spark.readStream.text."""
    return spark.read.text(path)


def batch_numbers(lines: DataFrame, size: int, order: str) -> DataFrame:
    """lines with batch, counted from 0 in order; a shorter last batch is dropped.

    The place of a line is found by counting: tasks number the lines of a range
    and add the sizes of the ranges before it.
    """
    placed = stored(lines.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "lines")
    counts = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())  # one row a task
    ahead, total = {}, 0
    for part, n in counts:
        ahead[part], total = total, total + n
    if not ahead:
        return placed.drop("_part").withColumn("batch", F.lit(0).cast("long"))
    before = F.try_element_at(F.create_map(*[F.lit(x).cast("long") for kv in ahead.items() for x in kv]), F.col("_part").cast("long"))
    place = before + F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    whole = total // size * size
    return placed.withColumn("_at", place).filter(F.col("_at") < whole).withColumn("batch", F.floor(F.col("_at") / size)).drop("_part", "_at")


def minibatches(rows: list, size: int) -> Iterator[list]:
    """Full batches only; a shorter last one is dropped."""
    for i in range(0, len(rows) - size + 1, size):
        yield rows[i : i + size]
