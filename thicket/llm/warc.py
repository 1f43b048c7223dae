"""WARC archives as a chunked record table.

A record is stored as rows (record_id, chunk_no, data): row 0 starts with the
WARC and HTTP headers, and a payload of more than ``CHUNK`` bytes goes on over
the following rows.  Writing encodes a payload piece by piece, once for its
digest and once for its rows, so neither writing nor reading holds a record's
bytes beyond a chunk besides the given text.  Every row carries the payload's SHA-1
up to and including it, which locates damage.  The rows of an archive in order
of record_id and chunk_no are a valid WARC 1.1 file (export_archives).  Record
ids are those of the table, which are unique; the page is named by a header of
its own, as pages may repeat or have no id.

Equal payloads are stored once: the record of the largest page_id is the
response and the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.llm.runtime import bounded_batches, commit_shared, lean, materialise, open_shared

CHUNK = 256 << 10
#: The date of all records; a parameter of the archive, not of the pages.
DATE = "2024-01-01T00:00:00Z"
PREFIX, REVISIT = "urn:thicket:record:", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "archive int, record_id long, chunk_no int, n_chunks int, data binary, sha1_so_far string"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def byte_chunks(text: str) -> Iterator[bytes]:
    """The UTF-8 bytes of a text in chunks of CHUNK, encoded piece by piece; one empty chunk for an empty text."""
    held = bytearray()
    for at in range(0, len(text), CHUNK // 4):
        held += text[at : at + CHUNK // 4].encode("utf-8", "surrogatepass")
        while len(held) > CHUNK:
            yield bytes(held[:CHUNK])
            del held[:CHUNK]
    yield bytes(held)


def record_headers(record: int, page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """WARC and HTTP headers of a record; the payload follows unless it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{PREFIX}{record}>", f"X-Page-ID: {'' if page_id is None else page_id}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


@lean
def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    archive, record = TaskContext.get().partitionId(), 0
    names = ["archive", "record_id", "chunk_no", "n_chunks", "data", "sha1_so_far"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
    for batch in batches:
        rows, held = [], 0
        for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
            whole, size, n, revisit = hashlib.sha1(), 0, 0, refers_to is not None
            for part in byte_chunks(html or ""):
                whole.update(part)
                size, n = size + len(part), n + 1
            head = record_headers(record + (archive << 40), page_id, url, size, base32_sha1(whole.digest()), refers_to, revisit)
            n = 1 if revisit else n
            running = hashlib.sha1()
            for k, part in enumerate([b""] if revisit else byte_chunks(html or "")):
                running.update(part)
                data = (head if k == 0 else b"") + part + (b"\r\n\r\n" if k == n - 1 else b"")
                rows.append(((archive), record + (archive << 40), k, n, data, base32_sha1(running.digest())))
                held += len(data)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            record += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def write_archive(pages: DataFrame, name: str = "archive") -> DataFrame:
    """The record table of pages(page_id, url, html), written to the shared folder.

    Null html is empty.  Of equal payloads the one of the largest page_id is
    the response; rows that repeat that page_id are all responses, a null
    page_id is the least, and payloads with null ids alone are all responses.
    Payloads of any length are written whole; other columns are ignored; an
    empty table gives an empty archive.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    keys = rows.select("page_id", "sha")
    kept = keys.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    revisits = keys.join(kept, "sha").filter("NOT page_id <=> refers_to").select(F.col("page_id").alias("p"), F.col("sha").alias("s"), "refers_to").distinct()
    typed = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s")), "left").select("page_id", "url", "html", "refers_to")
    return materialise(typed.mapInArrow(_emit, CHUNKS), name)


def _headers(data: bytes) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}, end + 4


@lean
def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams chunk rows in order; holds one chunk and a running digest."""
    state: dict = {}
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    number = lambda s: int(s) if s else None
    for batch in batches:
        rows = []
        for record, k, n, data, so_far in zip(*(batch.column(c).to_pylist() for c in ("record_id", "chunk_no", "n_chunks", "data", "sha1_so_far"))):
            if k == 0:
                warc, at = _headers(data)
                http, more = _headers(data[at:])
                state = {"id": record, "next": 0, "warc": warc, "size": int(http["content-length"]), "sha": hashlib.sha1(), "got": 0}
                data = data[at + more :]
            if state.get("id") != record or state["next"] != k:
                raise ValueError(f"record {record}: chunk {k} is out of order")
            state["next"] += 1
            part = data[:-4] if k == n - 1 else data
            state["sha"].update(part)
            state["got"] += len(part)
            if base32_sha1(state["sha"].digest()) != so_far:
                raise ValueError(f"record {record}: chunk {k} is damaged")
            if k < n - 1:
                continue
            warc, revisit = state["warc"], state["warc"]["warc-type"] == "revisit"
            digest = warc["warc-payload-digest"].removeprefix("sha1:")
            if not revisit and (state["got"] != state["size"] or digest != so_far):
                raise ValueError(f"record {record}: the payload differs from its headers")
            rows.append((number(warc["x-page-id"]), state["size"], digest, warc["warc-type"], number(warc.get("x-refers-to-page-id")) if revisit else None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def read_archive(chunks: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, from its bytes.

    Records of one chunk are read where they lie; only longer ones are brought
    together, in order, by record.
    """
    bounded_batches(chunks.sparkSession)
    columns = ["record_id", "chunk_no", "n_chunks", "data", "sha1_so_far"]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    short = chunks.filter("n_chunks = 1").select(columns).mapInArrow(_parse, schema)
    long = chunks.filter("n_chunks > 1").select(columns).repartition("record_id").sortWithinPartitions("record_id", "chunk_no").mapInArrow(_parse, schema)
    return short.unionByName(long)


def _export(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out, done, size = None, None, [], 0
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if archive != current:
                    if out:
                        out.close()
                        commit_shared(f"{folder}/.{current:06d}.part", f"{folder}/{current:06d}.warc")
                        done.append((current, size))
                    current, size, out = archive, 0, open_shared(f"{folder}/.{archive:06d}.part", "wb")
                out.write(data)
                size += len(data)
        if out:
            out.close()
            commit_shared(f"{folder}/.{current:06d}.part", f"{folder}/{current:06d}.warc")
            done.append((current, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in ((0, pa.int32()), (1, pa.int64()))], ["archive", "bytes"])

    return lean(run)


def export_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Writes each archive as NNNNNN.warc below a shared folder; returns archive and bytes."""
    rows = chunks.select("archive", "data", "record_id", "chunk_no").repartition("archive").sortWithinPartitions("archive", "record_id", "chunk_no")
    return materialise(rows.select("archive", "data").mapInArrow(_export(folder), "archive int, bytes long"), "exported")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    return read_archive(write_archive(pages))
