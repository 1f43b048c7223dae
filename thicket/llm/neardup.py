"""MinHash near-duplicates by a multi-index Hamming join.

A text's distinct word shingles are summarised by ``CHUNKS * WIDTH`` 8-bit
min-wise symbols.  The signature is split into ``CHUNKS`` chunks; by the
pigeonhole principle two signatures that differ in fewer than
``2 * CHUNKS`` symbols have a chunk with at most one differing symbol.  That
chunk agrees on all symbols but one, so each text is entered under ``WIDTH`` keys a chunk, one for each
symbol left out: every pair under the signature-distance threshold shares a
key.  A pair of Jaccard similarity 0.8 shares no key with a probability of
about 4e-6, one of 0.85 with 3e-9; unrelated texts must agree in seven symbols.

Texts with equal shingle sets are one class and only its least document takes
part.  Within a key, each document is tied to the least one of the key, so
the ties are linear in the key's size.  Links are confirmed on full shingle
sets in two steps.  First, each document is compared with the ``STARS`` documents
that it is tied to by most keys; what links is one label, which settles nearly
all documents of a group of near copies with rows in proportion to them.  Then
labels tied together are a family, every pair that shares a key and is not
settled lies in one family, and only pairs of different labels are compared:
small families whole, larger ones in pairs of blocks of bounded weight (see
``_units``), where blocks of one label are not paired.  A task walks the links
of its block pair breadth first and gives back a spanning forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thicket.llm import tokens
from thicket.llm.components import connected_components
from thicket.llm.prefilter import split_listed
from thicket.llm.runtime import bounded_batches, lean, materialise

CHUNKS, WIDTH, SEED = 18, 8, 6
#: Documents that each one is compared with first, and members of a star in one task.
STARS, STAR = 3, 1024
#: Weight of a block of a family: a document weighs 1 for each ``HEAVY`` shingles begun.
BLOCK, HEAVY = 128, 4096
#: Documents whose keys are gathered before the shuffle, and rows of a batch of keys.
GATHER, ROWS = 8192, 100_000


def _whole(side: DataFrame) -> DataFrame:
    """A side that grows with the documents: joined by merging.

    Compressed files of ids are a small part of their size in memory, so one
    under Spark's limit for broadcasts can fill the driver, through which they pass.
    """
    return side.hint("merge")


def _signatures(shingle: int):
    multipliers, offsets = tokens.permutations(CHUNKS * WIDTH, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, counts in tokens.hashed_words(batch.column(1)):
                shingles, made = tokens.shingle_hashes(words, counts, shingle)
                symbols = tokens.minhash(shingles, made, multipliers, offsets).astype(np.uint8)
                ends = np.cumsum(made)
                size, one, two = (np.zeros(hi - lo, np.int64) for _ in range(3))
                for i in np.flatnonzero(made):
                    unique = np.unique(shingles[ends[i] - made[i] : ends[i]])
                    size[i] = len(unique)
                    one[i] = np.add.reduce(tokens.mix(unique)).view(np.int64)
                    two[i] = np.add.reduce(tokens.mix(unique ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(size), pa.array(one), pa.array(two), pa.array([s.tobytes() for s in symbols], pa.binary())],
                    ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return lean(run)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, signature) of every text; equal sets have equal (n_shingles, set_a, set_b)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_signatures(shingle), "doc_id long, n_shingles long, set_a long, set_b long, signature binary")


def _doc_keys(signatures: list[bytes]) -> np.ndarray:
    """Row by CHUNKS * WIDTH: the key of every chunk with each of its symbols left out."""
    place = np.arange(CHUNKS * WIDTH, dtype=np.uint64).reshape(CHUNKS, WIDTH)
    symbols = np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    terms = tokens.mix(symbols + (place << np.uint64(20)) + np.uint64(1))
    return tokens.mix(terms.sum(axis=2, dtype=np.uint64)[:, :, None] - terms + (place << np.uint64(40))).reshape(-1, CHUNKS * WIDTH)


@lean
def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, least, n): once for each key of GATHER documents its least one, and the other documents' ties to it.

    A tie carries its least document, a key of its own, and the number n of keys
    that tie them; a key's own row has no least document.  So a key that very many documents have is shuffled once for each
    GATHER of them.
    """

    def tied(ids: np.ndarray, signatures: list[bytes]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(ids, kind="stable")
        keys, first, place = np.unique(_doc_keys(signatures)[order].reshape(-1), return_index=True, return_inverse=True)
        owner = ids[order][np.arange(len(place)) // (CHUNKS * WIDTH)]
        least = owner[first]
        other = owner != least[place]
        ties, often = np.unique(np.stack([owner[other], least[place[other]]]), axis=1, return_counts=True)
        for k, d, m, n in ((keys, least, None, np.ones(len(keys), np.int64)), (tokens.mix(ties[0].view(np.uint64) * tokens._M1 + ties[1].view(np.uint64)), ties[0], ties[1], often)):
            for lo in range(0, len(k), ROWS):
                part = slice(lo, lo + ROWS)
                own = pa.nulls(len(k[part]), pa.int64()) if m is None else pa.array(m[part])
                yield pa.RecordBatch.from_arrays([pa.array(k[part].view(np.int64)), pa.array(d[part]), own, pa.array(n[part].astype(np.int32))], ["key", "doc_id", "least", "n"])

    ids, signatures = [], []
    for batch in batches:
        ids += batch.column("head").to_pylist()
        signatures += batch.column("signature").to_pylist()
        if len(ids) >= GATHER:
            yield from tied(np.array(ids, np.int64), signatures)
            ids, signatures = [], []
    if ids:
        yield from tied(np.array(ids, np.int64), signatures)


def _forest(ids: list[int], sides: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between the labels of these documents; of two sides, only links across.

    Each document reached is compared at once with all that are not yet reached;
    with it, all documents of its label are reached.
    """
    names = np.array(ids, np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    items = np.unique(np.concatenate(sets), return_inverse=True)[1]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    held = np.zeros(int(items.max()) + 1, bool)
    across = len(np.unique(sides)) > 1
    left = np.ones(len(ids), bool)
    by_label = np.argsort(labels, kind="stable")
    ordered = labels[by_label]

    def reach(at: int) -> list[int]:
        mates = by_label[np.searchsorted(ordered, labels[at]) : np.searchsorted(ordered, labels[at], side="right")]
        mates = mates[left[mates]]
        left[mates] = False
        return mates.tolist()

    rest, rest_items, rest_starts = np.arange(len(ids)), items, bounds[:-1]
    for seed in range(len(ids)):
        queue = reach(seed) if left[seed] else []
        while queue:
            at = queue.pop()
            count = int(left.sum())
            if not count:
                return
            if 2 * count <= len(rest):
                keep = left[rest]
                rest_items = rest_items[np.repeat(keep, sizes[rest])]
                rest = rest[keep]
                rest_starts = np.cumsum(sizes[rest]) - sizes[rest]
            own = items[bounds[at] : bounds[at + 1]]
            held[own] = True
            both = np.add.reduceat(held[rest_items], rest_starts, dtype=np.int64)
            held[own] = False
            near = left[rest] & (both > 0) & (100 * both >= percent * (sizes[at] + sizes[rest] - both))
            if across:
                near &= sides[rest] != sides[at]
            for other in rest[near].tolist():
                if left[other]:
                    yield int(names[at]), int(names[other])
                    queue += reach(other)


def _linked(shingle: int, percent: int):
    """Links of every unit; the rows of a unit follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, sides, labels, sets = None, [], [], [], []

        def links() -> Iterator[pa.RecordBatch]:
            found = list(_forest(ids, np.array(sides), np.array(labels, np.int64), sets, percent)) if len(ids) > 1 else []
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            units = list(zip(*(batch.column(c).to_pylist() for c in ("family", "i", "j"))))
            docs, side, label = (batch.column(c).to_pylist() for c in ("doc_id", "side", "label"))
            for lo, hi, words, counts in tokens.hashed_words(batch.column("text")):
                shingles, made = tokens.shingle_hashes(words, counts, shingle)
                ends = np.cumsum(made)
                for row in range(lo, hi):
                    if units[row] != unit:
                        yield from links()
                        unit, ids, sides, labels, sets = units[row], [], [], [], []
                    ids.append(docs[row])
                    sides.append(side[row])
                    labels.append(label[row])
                    sets.append(np.unique(shingles[ends[row - lo] - made[row - lo] : ends[row - lo]]))
        yield from links()

    return lean(run)


def _stars(shingle: int, percent: int):
    """Links of members with their star's centre, the first row of each (centre, salt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            stars = list(zip(batch.column("centre").to_pylist(), batch.column("salt").to_pylist()))
            docs, found = batch.column("doc_id").to_pylist(), []
            for lo, hi, words, counts in tokens.hashed_words(batch.column("text")):
                shingles, made = tokens.shingle_hashes(words, counts, shingle)
                ends = np.cumsum(made)
                for row in range(lo, hi):
                    mine = np.unique(shingles[ends[row - lo] - made[row - lo] : ends[row - lo]])
                    if stars[row] != star:
                        star, own = stars[row], mine
                        continue
                    at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    both = int((own[at] == mine).sum())
                    if 100 * both >= percent * (len(own) + len(mine) - both):
                        found.append((star[0], docs[row]))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return lean(run)


def _star_links(ties: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b): of each document's STARS centres by number of shared keys, those that it links with."""
    best = Window.partitionBy("a").orderBy(F.desc("n"), "b")
    pairs = materialise(ties.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= STARS).select(F.col("b").alias("centre"), F.col("a").alias("doc_id")), "pairs")
    sizes = pairs.groupBy("centre").agg(F.ceil(F.count("*") / STAR).cast("long").alias("salts"))
    members = pairs.join(_whole(sizes), "centre").select("centre", F.pmod(F.xxhash64("doc_id"), "salts").alias("salt"), "doc_id", F.lit(1).alias("side"))
    centres = sizes.select("centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("centre").alias("doc_id"), F.lit(0).alias("side"))
    rows = members.unionByName(centres)
    listed = pairs.select("doc_id").union(pairs.select("centre"))
    dealt = rows.join(_whole(split_listed(texts, listed)[0]), "doc_id").repartition("centre", "salt").sortWithinPartitions("centre", "salt", "side")
    return dealt.select("centre", "salt", "doc_id", "text").mapInArrow(_stars(shingle, percent), "a long, b long")


def _units(families: DataFrame, percent: int) -> DataFrame:
    """(doc_id, label, family, i, j, side): the block pairs that each document of families(doc_id, label, family, n_shingles) takes part in.

    A family of at most BLOCK weight is one unit.  In a larger one, documents
    are dealt to bands of set sizes, each band's upper end ``100 / percent``
    times its lower, as two sets further apart cannot be linked.  In a band, a
    label of more than half a block has blocks of its own, the others share
    some; a document's block is chosen by a hash of doc_id.  Units are the pairs
    of blocks of one band or of neighbouring bands but for those of one label,
    so a document is copied once for each block of other labels: rows grow with
    the documents times the blocks of what is not settled.
    """
    weighed = families.withColumn("weight", F.ceil(F.col("n_shingles") / HEAVY))
    whole = weighed.groupBy("family").agg(F.sum("weight").alias("total"))
    step = float(np.log(100 / percent)) * (1 + 1e-9)  # rounding cannot put two sizes of that ratio two bands apart
    size = F.floor(F.log("n_shingles") / step) if percent < 100 else F.col("n_shingles")
    band = F.when(F.col("total") <= BLOCK, 0).otherwise(size).cast("int")
    banded = weighed.join(_whole(whole), "family").withColumn("band", band)
    own = banded.groupBy("family", "band", "label").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    apart = F.when((F.col("total") > BLOCK) & (F.col("w") > BLOCK // 2), F.col("label")).otherwise(F.lit(-1).cast("long"))
    named = own.join(_whole(whole), "family").withColumn("group", apart)
    groups = named.groupBy("family", "band", "group").agg(F.least(F.sum("n"), F.ceil(F.sum("w") / BLOCK)).cast("int").alias("blocks"))
    lists = groups.groupBy("family", "band").agg(F.collect_list(F.struct("group", "blocks")).alias("list"))  # one entry a large label
    above = lists.select("family", (F.col("band") - 1).alias("band"), F.col("list").alias("next"))
    below = lists.select("family", (F.col("band") + 1).alias("band"), F.col("list").alias("last"))
    counts = groups.join(_whole(lists), ["family", "band"]).join(_whole(above), ["family", "band"], "left").join(_whole(below), ["family", "band"], "left")
    placed = banded.join(_whole(named.select("family", "band", "label", "group")), ["family", "band", "label"]).join(_whole(counts), ["family", "band", "group"])
    name = lambda b, g, k: F.array(b.cast("long"), g.cast("long"), k.cast("long"))
    none = F.array().cast("array<array<bigint>>")
    blocks = lambda b, rows: F.coalesce(F.flatten(F.transform(rows, lambda g: F.transform(F.sequence(F.lit(0), g["blocks"] - 1), lambda k: name(b, g["group"], k)))), none)
    others = F.concat(blocks(F.col("band"), F.col("list")), blocks(F.col("band") + 1, F.col("next")), blocks(F.col("band") - 1, F.col("last")))
    mine = name(F.col("band"), F.col("group"), F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    foreign = F.filter(others, lambda o: (F.col("group") == -1) | (o[1] != F.col("group")))
    each = placed.select("doc_id", "label", "family", mine.alias("mine"), F.explode(foreign).alias("other"))
    first = F.col("mine") <= F.col("other")
    return each.select("doc_id", "label", "family", F.when(first, F.col("mine")).otherwise(F.col("other")).alias("i"), F.when(first, F.col("other")).otherwise(F.col("mine")).alias("j"), (~first).cast("int").alias("side"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A n B| >= percent * |A u B| on their sets
    of distinct word shingles (A-Z folded); a text of fewer words has one
    shingle, the whole sequence.  Null and wordless texts have an empty set
    and link with nothing.  component_id is the least doc_id reachable.  Rows
    that repeat a doc_id are one document, whose text is the least of theirs;
    a row with a null doc_id joins no component (null) and is kept.  Texts of any
    length are read whole; other columns of docs are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = texts.filter("doc_id IS NOT NULL")
    if named.groupBy("doc_id").count().filter("count > 1").head(1):
        texts = named.groupBy("doc_id").agg(F.min("text").alias("text")).unionByName(texts.filter("doc_id IS NULL"))
    sets = materialise(shingle_sets(texts, shingle), "sets")
    classes = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("head"), F.min("signature").alias("signature"))
    heads = materialise(classes, "heads")
    keyed = heads.select("head", "signature").mapInArrow(_keys, "key long, doc_id long, least long, n int")
    least = F.coalesce("least", F.min("doc_id").over(Window.partitionBy("key")))
    ties = materialise(keyed.select(F.col("doc_id").alias("a"), least.alias("b"), "n").filter("a <> b").groupBy("a", "b").agg(F.sum("n").alias("n")), "ties")
    settled = materialise(connected_components(_star_links(ties, texts, shingle, percent)).select(F.col("node").alias("doc_id"), F.col("component").alias("label")), "labels")
    side = lambda c: _whole(settled.select(F.col("doc_id").alias(c), F.col("label").alias(f"label_{c}")))
    open_ = ties.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).filter("a <> b")
    open_ = connected_components(open_).select(F.col("node").alias("label"), F.col("component").alias("family"))
    labelled = heads.select(F.col("head").alias("doc_id"), "n_shingles").join(_whole(settled), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    families = materialise(labelled.join(_whole(open_), "label"), "families")
    units = materialise(_units(families, percent), "units")
    keys = ["family", "i", "j"]
    compared = units.join(_whole(split_listed(texts, units)[0]), "doc_id").repartition(*keys).sortWithinPartitions(*keys)
    links = compared.select(*(F.to_json(k).alias(k) if k != "family" else F.col(k) for k in keys), "side", "label", "doc_id", "text").mapInArrow(_linked(shingle, percent), "a long, b long")
    between = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    joined = connected_components(between).select(F.col("node").alias("label"), "component")
    parts = settled.join(_whole(joined), "label", "full").select(F.coalesce("doc_id", "label").alias("head"), F.coalesce("component", "label").alias("component"))
    inner = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(_whole(heads.select("n_shingles", "set_a", "set_b", "head")), ["n_shingles", "set_a", "set_b"])
    assigned = inner.join(_whole(parts), "head", "left").select("doc_id", F.coalesce("component", "head").alias("component_id"))
    rows = sets.select("doc_id", "n_shingles").join(_whole(assigned), "doc_id", "left")
    whole = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "n_shingles", whole.alias("component_id"), F.coalesce(F.col("doc_id") == whole, F.lit(True)).alias("kept"))
