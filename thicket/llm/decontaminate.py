"""Benchmark decontamination by size-partitioned MinHash containment search.

Benchmark items are partitioned by size: an item of L shingles belongs to the
least class u = 8, 16, 32, ... with L <= u.  For each class, a document is cut
into blocks of u shingles and searched through windows of two adjacent blocks,
so any run of at most u shingles lies inside one window, however long the
document is.  An item contained to 0.8 in a window has a Jaccard similarity of
0.19 at least, and one of ``BANDS`` single-row MinHash bands then agrees with a
probability above 1 - 2e-6.  Window minima come from block minima, so the
permutations are evaluated once a shingle for all classes.

An item of at most ``FEW`` shingles has too few for bands, and one of fewer words
than a shingle only its whole sequence; their candidates are the documents with
such a shingle or sequence.

Candidates are verified by exact containment of the item's distinct shingles
in the whole document.  Documents are only compared with two bit maps of fixed
size (the items' bands and shingles); what passes is joined with the item
tables, where Spark broadcasts by its own size limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.llm import tokens
from thicket.llm.prefilter import split_listed
from thicket.llm.runtime import bounded_batches, lean, materialise

BANDS, SEED, LEAST_CLASS = 64, 3, 8
#: Items of at most this many shingles are searched by the shingles themselves; the mark of their keys.
FEW, MARK = 4, np.uint64(0x66657720736869)
#: Bits of each bit map; 4 MB whatever the size of the benchmark.
MAP_BITS = 25


def _class_of(made: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST_CLASS, 1 << np.ceil(np.log2(np.maximum(made, 1))).astype(np.int64))


def _band_keys(minima: np.ndarray, size_class: np.ndarray) -> np.ndarray:
    """64-bit keys of (class, band, value)."""
    tag = (np.arange(BANDS, dtype=np.uint64)[None, :] << np.uint64(40)) + (size_class.astype(np.uint64)[:, None] << np.uint64(48))
    return tokens.mix(minima.astype(np.uint64) + tag + np.uint64(1))


def _bit(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _test(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _bit(keys)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def _index(shingle: int):
    multipliers, offsets = tokens.permutations(BANDS, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, counts in tokens.hashed_words(batch.column(1)):
                shingles, made = tokens.shingle_hashes(words, counts, shingle)
                ids = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                minima = tokens.minhash(shingles, made, multipliers, offsets)
                full = made > FEW
                keys = _band_keys(minima[full], _class_of(made[full]))
                few = np.repeat(made <= FEW, made)
                words_of = np.repeat(np.minimum(counts, shingle), made)  # below LEAST_CLASS: the words of a sequence
                rows = [
                    (np.repeat(ids[full], BANDS), keys.reshape(-1), np.repeat(_class_of(made[full]), BANDS), True),
                    (np.repeat(ids, made)[few], tokens.mix(shingles[few] ^ MARK), words_of[few], True),
                    (np.repeat(ids, made), shingles, np.repeat(_class_of(made), made), False),
                ]
                for item, key, size, band in rows:
                    yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(key.view(np.int64)), pa.array(size), pa.array(np.full(len(key), band))], ["item_id", "key", "size_class", "band"])

    return lean(run)


def _bit_maps(index: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The bit maps of the items' shingles and bands; the tasks gather the bits of each 64-bit word.

    The driver gets one row a word that has bits, 2 ** (MAP_BITS - 5) in all at most.
    """
    at = F.shiftrightunsigned("key", 64 - MAP_BITS)
    bits = index.select("band", at.alias("at")).selectExpr("band", "CAST(at >> 6 AS INT) AS word", "shiftleft(1L, CAST(at & 63 AS INT)) AS bit")
    found = bits.groupBy("band", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    maps = np.zeros((2, 1 << (MAP_BITS - 6)), "<i8")
    maps[found["band"].to_numpy().astype(np.int64), found["word"].to_numpy()] = found["bits"].to_numpy()
    return maps[0].view(np.uint8), maps[1].view(np.uint8)


def _search(shingle: int, shingle_bits, band_bits, sizes: list[int]):
    classes = [s for s in sizes if s >= LEAST_CLASS]
    short = [s for s in sizes if s < shingle]
    multipliers, offsets = tokens.permutations(BANDS, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shingle_bits.value, np.uint8)
        banded = np.frombuffer(band_bits.value, np.uint8)
        for batch in batches:
            for lo, hi, words, counts in tokens.hashed_words(batch.column(1)):
                shingles, made = tokens.shingle_hashes(words, counts, shingle)
                if not len(shingles):
                    continue
                ids = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                hit = np.flatnonzero(_test(known, shingles))
                yield _rows(np.repeat(ids, made)[hit], shingles[hit], False)
                marked = tokens.mix(shingles[hit] ^ MARK)
                few = _test(banded, marked)
                yield _rows(np.repeat(ids, made)[hit][few], marked[few], True)
                for n in short:  # whole items of fewer words than a shingle
                    sequences, several = tokens.shingle_hashes(words, counts, n)
                    of = np.repeat(ids, several)
                    inside = np.repeat(counts >= n, several) & _test(known, sequences)
                    of, sequences = of[inside], sequences[inside]
                    yield _rows(of, sequences, False)
                    yield _rows(of, tokens.mix(sequences ^ MARK), True)
                if not classes:
                    continue
                # Block minima of the least class; each next class halves the blocks of a document.
                blocks = -(-made // LEAST_CLASS)
                first = np.cumsum(made) - made
                inside = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                heads = np.repeat(first, blocks) + inside * LEAST_CLASS
                low = (shingles >> np.uint64(32)).astype(np.uint32)
                minima = np.stack([np.minimum.reduceat(low * a + b, heads) for a, b in zip(multipliers, offsets)])
                size = LEAST_CLASS
                while True:
                    row = np.repeat(np.arange(hi - lo), blocks)
                    if size in classes:
                        joined = minima.copy()
                        pair = row[1:] == row[:-1]
                        joined[:, :-1][:, pair] = np.minimum(minima[:, :-1][:, pair], minima[:, 1:][:, pair])
                        keys = _band_keys(joined.T, np.full(len(row), size))
                        at = np.argwhere(_test(banded, keys))
                        if len(at):
                            yield _rows(ids[row[at[:, 0]]], keys[at[:, 0], at[:, 1]], True)
                    if size >= max(classes):
                        break
                    halved = -(-blocks // 2)
                    inside = np.arange(int(halved.sum())) - np.repeat(np.cumsum(halved) - halved, halved)
                    heads = np.repeat(np.cumsum(blocks) - blocks, halved) + 2 * inside
                    minima = np.minimum.reduceat(minima, heads, axis=1)
                    blocks, size = halved, size * 2

    return lean(run)


def _rows(ids: np.ndarray, keys: np.ndarray, band: bool) -> pa.RecordBatch:
    both = np.unique(np.stack([ids.astype(np.int64), keys.view(np.int64)], axis=1), axis=0) if len(ids) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(np.full(len(both), band))], ["doc_id", "key", "band"])


def contained_items(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, containment: float = 0.8) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles, containment) of the pairs at or over the bound.

    Every pair given back is exact; a pair is missed with a probability below
    2e-6 (the bands), never for items of at most FEW shingles.

    containment is the share of the item's distinct shingles (A-Z folded words)
    that the whole document holds.  An item of fewer words than a shingle has
    one shingle, its whole sequence, which a document holds where these words
    follow each other; null, empty and wordless texts and null ids are in no pair.  Rows
    that repeat an id count as one text with all their shingles.  Other
    columns are ignored; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    index = materialise(items.mapInArrow(_index(shingle), "item_id long, key long, size_class long, band boolean").distinct(), "items")
    known, banded = _bit_maps(index)
    classes = {r.size_class for r in index.filter("band").select("size_class").distinct().collect()}  # one a power of two
    send = spark.sparkContext.broadcast
    search = _search(shingle, send(known.tobytes()), send(banded.tobytes()), sorted(classes))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    found = materialise(text.mapInArrow(search, "doc_id long, key long, band boolean"), "found")
    bands = index.filter("band").select("item_id", "key")
    shingles = index.filter("NOT band").select("item_id", "key")
    candidates = found.filter("band").join(bands, "key").select("doc_id", "item_id").distinct()
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("item_shingles"))
    # Only the shingles of candidates are counted, so one that is common to many documents and items costs nothing.
    held = candidates.join(shingles, "item_id").join(found.filter("NOT band").distinct(), ["doc_id", "key"]).groupBy("doc_id", "item_id").agg(F.count("*").alias("shared_shingles"))
    share = F.col("shared_shingles") / F.col("item_shingles")
    return held.join(sizes, "item_id").select("doc_id", "item_id", "item_shingles", "shared_shingles", share.alias("containment")).filter(F.col("containment") >= containment)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, containment: float = 0.8) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark item; a null doc_id is kept.

    Only texts that a map of fixed size cannot rule out are shuffled to be
    joined with the contaminated ids.  Odd rows are treated as in contained_items.
    """
    dirty = materialise(contained_items(docs, benchmark, shingle, containment).select("doc_id").distinct(), "contaminated")
    maybe, never = split_listed(docs, dirty)
    return maybe.join(dirty, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(never)
