"""A change feed as a streaming source with offsets of its own.

Every change has a position that only grows.  An offset is a position; a
micro-batch is the changes after its start up to its end, and asking for the
same range again gives the same rows, so a batch that is repeated after a
failure is the same batch.  What is asked is a client, named by the option
``client`` as module:class: ``latest()`` gives the newest position, ``parts``
cuts a range into pieces that tasks read side by side, ``read`` gives the rows
of a piece.  ``FolderFeed`` reads segments that Spark jobs have appended to a
folder, ``ServiceFeed`` a paged service of dated changes.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from thicket.sources.readers import page_sizes, with_retries


class ChangeFeed(DataSource):
    """Format ``change_feed``; options: schema (DDL), client, since (changes after it, default -1), until (up to it), and the client's own."""

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return self.options["schema"]

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self.options, schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(self.options, schema)


class _Feed:
    def __init__(self, options, schema: StructType):
        self.options = dict(options) | {"columns": to_arrow_schema(schema)}
        module, _, name = self.options.get("client", "thicket.streaming.feed:FolderFeed").partition(":")
        self.client = getattr(importlib.import_module(module), name)(self.options)
        self.since = int(self.options.get("since", -1))

    def latest(self) -> int:
        until = self.options.get("until")
        newest = self.client.latest() if until is None else int(until)
        return max(newest, self.since)

    def pieces(self, since: int, until: int) -> list[InputPartition]:
        return [InputPartition(p) for p in self.client.parts(since, until)] if until > since else []

    def read(self, partition: InputPartition) -> Iterator:
        return self.client.read(partition.value)


class _Stream(_Feed, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"position": self.since}

    def latestOffset(self) -> dict:
        return {"position": self.latest()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.pieces(start["position"], end["position"])


class _Batch(_Feed, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.pieces(self.since, self.latest()) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator:
        return iter(()) if partition.value is None else super().read(partition)


class FolderFeed:
    """Segments of a folder that append_changes() writes; options: path, position (the column's name)."""

    def __init__(self, options: dict):
        from pyarrow import fs

        self.columns, self.position = options.get("columns"), options.get("position", "position")
        self.system, self.path = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] else (fs.LocalFileSystem(), options["path"])

    def _segments(self) -> list[tuple[int, int, list[str]]]:
        """(first, last, files) of every segment whose writing has ended."""
        from pyarrow import fs

        by: dict[str, list[str]] = {}
        for f in self.system.get_file_info(fs.FileSelector(self.path, recursive=True, allow_not_found=True)):
            if f.type == fs.FileType.File:
                folder, _, name = f.path.rpartition("/")
                by.setdefault(folder, []).append(name)
        out = []
        for folder, names in by.items():
            kind, _, bounds = folder.rpartition("/")[2].partition("=")
            if kind == "segment" and "_SUCCESS" in names:
                first, last = map(int, bounds.split("-"))
                out.append((first, last, [f"{folder}/{n}" for n in sorted(names) if n.endswith(".parquet")]))
        return sorted(out)

    def latest(self) -> int:
        return max((last for _, last, _ in self._segments()), default=-1)

    def parts(self, since: int, until: int) -> list[tuple[str, int, int]]:
        return [(f, since, until) for first, last, files in self._segments() if first <= until and last > since for f in files]

    def read(self, part: tuple[str, int, int]) -> Iterator:
        """The rows of a file in the range; groups of rows that lie outside it are not read."""
        from pyarrow import compute, parquet

        path, since, until = part
        with parquet.ParquetFile(self.system.open_input_file(path), coerce_int96_timestamp_unit="us") as file:
            at = file.schema_arrow.get_field_index(self.position)
            bounds = [file.metadata.row_group(i).column(at).statistics for i in range(file.num_row_groups)]
            wanted = [i for i, s in enumerate(bounds) if s is None or not s.has_min_max or s.min <= until and s.max > since]
            for batch in file.iter_batches(batch_size=10_000, row_groups=wanted, columns=list({*self.columns.names, self.position})):
                position = batch.column(batch.schema.get_field_index(self.position))
                inside = compute.and_(compute.greater(position, since), compute.less_equal(position, until))
                yield batch.filter(inside).select(self.columns.names).cast(self.columns)


class ServiceFeed:
    """A service of dated changes in pages; options: url, pagesize, lag (ms that the service may be late).

    It is asked with fecha, pagina and pagesize, and answers {totalFilas,
    resultados: [{fecha, nregistro, cambio}]}, fecha in ms since 1970: the
    position.  Pages of one range are read side by side; busy services are
    asked again.  Rows are (fecha, nregistro, cambio).
    """

    def __init__(self, options: dict):
        self.url, self.size, self.lag = options["url"], int(options.get("pagesize", 1500)), int(options.get("lag", 0))

    def _ask(self, since: int, page: int, size: int) -> dict:
        query = urllib.parse.urlencode({"fecha": since, "pagina": page, "pagesize": size})

        def get() -> dict:
            with urllib.request.urlopen(f"{self.url}?{query}", timeout=60) as answer:
                return json.load(answer)

        return with_retries(get)

    def latest(self) -> int:
        return int(time.time() * 1000) - self.lag

    def parts(self, since: int, until: int) -> list[tuple[int, int, int]]:
        total = int(self._ask(since, 1, 1)["totalFilas"])
        return [(since, until, page) for page in range(1, len(page_sizes(total, self.size)) + 1)]

    def read(self, part: tuple[int, int, int]) -> Iterator[tuple]:
        since, until, page = part
        for r in self._ask(since, page, self.size).get("resultados", []):
            if since < int(r["fecha"]) <= until:
                yield int(r["fecha"]), r.get("nregistro"), r.get("cambio") or []


def append_changes(rows: DataFrame, folder: str, position: str = "position") -> tuple[int, int] | None:
    """Adds a segment of changes, whose positions must lie after those of the feed; gives its first and last position, None for no rows.

    Rows are dealt by ranges of position, so a range of the feed is in few files.
    """
    ends = rows.agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("n"), F.count(position).alias("placed")).first()
    if not ends.n:
        return None
    newest = FolderFeed({"path": folder, "position": position}).latest()
    if ends.placed < ends.n or ends.first <= newest or ends.first < 0:
        raise ValueError(f"positions must be whole numbers after {newest}")
    rows.repartitionByRange(position).sortWithinPartitions(position).write.mode("overwrite").parquet(f"{folder}/segment={ends.first:020d}-{ends.last:020d}")
    return ends.first, ends.last


def stream(spark: SparkSession, schema: str, **options: str) -> DataFrame:
    """The feed as a streaming table."""
    spark.dataSource.register(ChangeFeed)
    return spark.readStream.format("change_feed").option("schema", schema).options(**options).load()


def between(spark: SparkSession, schema: str, since: int, until: int, **options: str) -> DataFrame:
    """The changes after since, up to until, as a table."""
    spark.dataSource.register(ChangeFeed)
    return spark.read.format("change_feed").option("schema", schema).options(since=since, until=until, **options).load()
