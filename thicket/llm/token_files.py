"""Token ids in Arrow stream files of fixed-size-list batches.

A shard holds the documents of one range of doc_id in ascending order as two
Arrow streams: ``NNNNNN-TAG.tokens.arrow`` with columns ids
(fixed_size_list<uint16 or uint32>[LENGTH]) and mask
(fixed_size_list<bool>[LENGTH]), LENGTH tokens a row and ROWS rows a batch,
and ``NNNNNN-TAG.index.arrow`` with doc_id, start and n_tokens of each document.
Every attempt at a task has a tag of its own, and the manifest, which Spark
commits once, names the tag that counts: both files of a shard are always of
one attempt, and what a lost one has left is never read.
Batches are uncompressed, so a mapped file gives any sequence without a copy;
only the last row of a shard is padded, where mask is false.

Texts are dealt by range and encoded where they land, so ids are never
shuffled.  White space separates tokens in the given tokenizer, so each
distinct word is encoded once a task.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.llm import tokens
from thicket.llm.ranges import range_bounds, range_id, slot_of, slots
from thicket.llm.runtime import bounded_batches, commit_shared, lean, materialise, open_shared, table_bytes, workspace

LENGTH, ROWS = 1024, 64
#: Bytes of a table, as stored, behind a shard.
SHARD_BYTES = 256 << 20
#: Bits of the table of remembered words, and ids held before it starts anew.
TABLE_BITS, REMEMBERED = 20, 24_000_000
#: Words that the tokenizer's own rules split into letters and one mark, whatever stands around them.
PLAIN = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+[.,;:!?]?")


class WordEncoder:
    """Encodes texts word by word; a word is what stands between ASCII white space.

    Ids of words are remembered in a direct-mapped table keyed by word hash, in
    which a newer word displaces an older one, so its memory is fixed.  Plain
    words are handed to the library many at a time, joined by spaces, and told
    apart by the tokens that end a word; all others are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = np.uint32 if self.tokenizer.get_vocab_size() > 1 << 16 else np.uint16
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.keys, self.slots = np.zeros(1 << TABLE_BITS, np.uint64), np.zeros(1 << TABLE_BITS, np.int64)
        self.first, self.size, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0
        self.flat, self.used = np.zeros(1 << 18, self.wide), 0

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Slots of newly encoded words."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(sizes) > len(self.first):
            self.first, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size))
        new = slice(self.count, self.count + len(sizes))
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[new], self.size[new] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(ids)
        self.count += len(sizes)
        return np.arange(new.start, new.stop)

    def _learn(self, words: list[str]) -> np.ndarray:
        slots = np.zeros(len(words), np.int64)
        plain = [i for i, w in enumerate(words) if PLAIN.fullmatch(w)]
        for k in range(0, len(plain), 4000):
            part = plain[k : k + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words[i] for i in part)], add_special_tokens=False)[0].ids, np.int64)
            marks = np.array([1 if words[i][-1].isalpha() else 2 for i in part])
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != marks.sum() or ends[-1] != len(ids):
                raise AssertionError("the tokenizer does not mark word ends as expected")
            slots[part] = self._add(ids, np.diff(ends[np.cumsum(marks) - 1], prepend=0))
        other = sorted(set(range(len(words))) - set(plain))
        for k in range(0, len(other), 1000):
            part = other[k : k + 1000]
            coded = [e.ids for e in self.tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False)]
            slots[part] = self._add(np.array([x for c in coded for x in c], np.int64), np.array([len(c) for c in coded]))
        return slots

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of a run of rows, tokens per row), runs in row order."""
        for lo, hi, data, firsts, lasts in tokens.text_runs(column, tokens.PIECE):
            if hi - lo == 1 and len(data) > 2 * tokens.PIECE:
                parts = [self._run(p, np.zeros(1, np.int64), np.array([len(p)])) for p in tokens.cut(data, tokens.PIECE)]
                yield np.concatenate([p[0] for p in parts]), np.array([sum(len(p[0]) for p in parts)])
            else:
                yield self._run(data, firsts, lasts)

    def _run(self, data: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, starts, ends = tokens._hash_piece(data, firsts, lasts, tokens.EXACT)
        if not len(hashes):
            return np.zeros(0, self.wide), np.zeros(len(firsts), np.int64)
        if self.used > REMEMBERED:
            self.forget()
        at = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        slots = self.slots[at]
        missing = np.flatnonzero(self.keys[at] != hashes)
        if len(missing):
            unique, where, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            raw = data.tobytes()
            learnt = self._learn([raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in missing[where].tolist()])
            slots[missing] = learnt[back]
            to = (unique >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            self.keys[to], self.slots[to] = unique, learnt
        sizes = self.size[slots]
        total = int(sizes.sum())
        where = np.arange(total) + np.repeat(self.first[slots] - (np.cumsum(sizes) - sizes), sizes)
        running = np.concatenate([[0], np.cumsum(sizes)])
        words = np.searchsorted(starts, np.append(firsts, len(data)))
        return self.flat[where], np.diff(running[words])


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder a worker; it is kept from task to task."""
    return WordEncoder(path)


def shard_path(folder: str, number: int, tag: str, kind: str) -> str:
    return f"{folder}/{number:06d}-{tag}.{kind}.arrow"


class _Shard:
    """Writes one shard; nothing longer than a batch and one text's ids is held."""

    def __init__(self, folder: str, number: int, wide):
        kind = pa.from_numpy_dtype(wide)
        self.folder, self.number, self.wide = folder, number, wide
        self.schema = pa.schema([("ids", pa.list_(kind, LENGTH)), ("mask", pa.list_(pa.bool_(), LENGTH))])
        self.index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.tag = uuid.uuid4().hex[:8]
        self.files = {k: open_shared(self._part(k), "wb") for k in ("tokens", "index")}
        self.writers = {"tokens": pa.ipc.new_stream(self.files["tokens"], self.schema), "index": pa.ipc.new_stream(self.files["index"], self.index)}
        self.waiting: list[np.ndarray] = []
        self.held = self.total = self.docs = 0

    def _part(self, kind: str) -> str:
        return f"{self.folder}/.{self.number:06d}.{kind}.{self.tag}"

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = self.total + np.cumsum(counts) - counts
        self.writers["index"].write_batch(pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(counts)], schema=self.index))
        self.total += len(ids)
        self.docs += len(doc_ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= LENGTH * ROWS:
            joined = np.concatenate(self.waiting)
            full = len(joined) // (LENGTH * ROWS) * LENGTH * ROWS
            for i in range(0, full, LENGTH * ROWS):
                self._write(joined[i : i + LENGTH * ROWS], LENGTH * ROWS)
            self.waiting, self.held = [joined[full:]], len(joined) - full

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.writers["tokens"].write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(ids), LENGTH), pa.FixedSizeListArray.from_arrays(pa.array(mask), LENGTH)], schema=self.schema))

    def close(self) -> tuple[int, int, int, str]:
        if self.held:
            joined = np.concatenate(self.waiting)
            padded = np.zeros(-(-len(joined) // LENGTH) * LENGTH, self.wide)
            padded[: len(joined)] = joined
            self._write(padded, len(joined))
        for k in ("tokens", "index"):
            self.writers[k].close()
            self.files[k].close()
            commit_shared(self._part(k), shard_path(self.folder, self.number, self.tag, k))
        return self.number, self.docs, self.total, self.tag


def _write(path: str, folder: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, done = word_encoder(path), None, []
        for batch in batches:
            number = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(number)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi == lo:
                    continue
                if shard is None or shard.number != number[lo]:
                    if shard:
                        done.append(shard.close())
                    shard = _Shard(folder, int(number[lo]), encoder.wide)
                row, names = lo, batch.column(1).to_pylist()
                for ids, counts in encoder.encode(batch.column(2).slice(lo, hi - lo)):
                    ends = np.cumsum(counts)
                    ids = np.insert(ids, ends, end_id)
                    shard.add(names[row : row + len(counts)], ids, counts + 1)
                    row += len(counts)
        if shard:
            done.append(shard.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string() if k == 3 else pa.int64()) for k in range(4)], ["shard", "n_docs", "n_tokens", "tag"])

    return lean(run)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, shards: int = 0) -> DataFrame:
    """Writes docs as shards below folder and returns their manifest: shard, n_docs, n_tokens, start, tag.

    Documents are written in ascending doc_id order, null ids first, rows that
    repeat an id in the order of their texts; null and empty texts have the end
    id only.  The manifest has one row per shard; an empty table writes nothing.
    shards is how many there are at most; by default it follows the size of the
    table, about SHARD_BYTES each, and the cluster.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = shards or max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table_bytes(docs) // SHARD_BYTES))
    bounds = range_bounds(rows, "doc_id", n)
    shard = range_id(F.col("doc_id"), bounds).cast("long")
    # One partition a shard: a shard's slot is a number that Spark's hash puts there.
    n = max(1, len(bounds))
    dealt = rows.select(shard.alias("shard"), "doc_id", "text").withColumn("slot", slot_of(F.col("shard"), slots(spark, n))).repartition(n, "slot").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), F.coalesce("text", F.lit("")))
    manifest = materialise(dealt.select("shard", "doc_id", "text").mapInArrow(_write(tokenizer_path, folder, end_id), "shard long, n_docs long, n_tokens long, tag string"), "manifest")
    total, out = 0, []
    for r in manifest.orderBy("shard").collect():  # one row a shard, as many as asked for
        out.append((r.shard, r.n_docs, r.n_tokens, total, r.tag))
        total += r.n_tokens
    return spark.createDataFrame(out, "shard long, n_docs long, n_tokens long, start long, tag string")


class TokenShard:
    """Random access to a shard; a local file is mapped, so sequences are views of it."""

    def __init__(self, folder: str, number: int, tag: str):
        path = shard_path(folder, number, tag, "tokens")
        url = urlparse(path)
        self.source = pa.memory_map(url.path) if url.scheme in ("", "file") else open_shared(path, "rb")
        self.batches = list(pa.ipc.open_stream(self.source))

    def sequence(self, row: int) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of a row of LENGTH tokens; the ids are a view."""
        batch = self.batches[row // ROWS]
        at = row % ROWS * LENGTH
        return batch.column("ids").values.to_numpy()[at : at + LENGTH], batch.column("mask").values.slice(at, LENGTH)

    def slices(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from start on, in as many views as batches hold them."""
        while count:
            k, at = divmod(start, LENGTH * ROWS)
            part = self.batches[k].column("ids").values.to_numpy()[at : at + count]
            yield part
            start += len(part)
            count -= len(part)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base, tag in zip(*(batch.column(i).to_pylist() for i in range(3))):
                shard = TokenShard(folder, number, tag)
                with open_shared(shard_path(folder, number, tag, "index"), "rb") as source:
                    for index in pa.ipc.open_stream(source):
                        start, count = index.column("start").to_numpy(), index.column("n_tokens").to_numpy()
                        sums = []
                        for s, c in zip(start.tolist(), count.tolist()):
                            crc = 0
                            for part in shard.slices(s, c):
                                crc = zlib.crc32(part.astype("<u4"), crc)
                            sums.append(crc)
                        yield pa.RecordBatch.from_arrays([index.column("doc_id"), pa.array(start + base), index.column("n_tokens"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return lean(run)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (over all shards), n_tokens and ids_crc32 of every document, from the files."""
    shards = manifest.select("shard", "start", "tag").repartition(max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism)), "shard")
    return shards.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes docs to token files in the shared folder and reads them back."""
    folder = workspace(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer_path, folder, end_id), folder)
