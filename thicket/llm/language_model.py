"""Trigram language model as an Elias-Fano trie in memory-mapped level files.

Words are 64-bit hashes.  Level 1 is split into shards by the hash's leading
bits: each holds its words as an Elias-Fano sequence with exact counts (the
base score needs them); a word's id is its rank over all shards.  Levels 2 and
3 are grids of blocks, context shard by word group, so that the successors of a
frequent context never meet in one task; their number follows the tokens.  In a
block, an n-gram is one monotone number, context * width + word, both counted
from the start of the block; its high bits are the pointers into the contexts,
and an n-gram is found by a successor search relative to its context.  Its rank
over all blocks is its id as a context of the next level.  Each n-gram has a
16-bit code of its log10 probability, each context one of its back-off weight;
none is below 0.5 / N, so the step log10(2N) / 65535 spans all of them at any
size N of the training part.

    p(w | u v) = (c(uvw) - D) / c(uv) + b(uv) p(w | v),   b(uv) = D k(uv) / c(uv)
    p(w | v)   = (c(vw) - D) / c(v) + b(v) p(w),          b(v) = D k(v) / c(v)
    p(w)       = (c(w) + 0.1) / (N + 0.1 (V + 1))

k counts the different successors of a context.  The end of a text is a token
and the context of the first word, which has no longer one.  Nothing is pruned.

Tasks that read texts sum the n-grams of a piece of text and send them on as
sorted, packed blobs, one for each block; a triple goes with its first pair, so
the task of a block has the pairs and the triples that begin with them, and
writes the files of both.  The files are only mapped by the tasks that score.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.llm import tokens
from thicket.llm.elias_fano import EliasFano, build, read_arrays, write_arrays
from thicket.llm.ranges import slot_of, slots
from thicket.llm.runtime import bounded_batches, commit_shared, lean, materialise, workspace

PIECE = 4 << 20
#: Discount of counts, the largest code, orders of the model, and n-grams for which a block is meant.
DISCOUNT, TOP_CODE, ORDERS, BLOCK = 0.5, 65535, 3, 2 << 20
ALPHA = 0.1
#: Merged entries that wait for more before they are summed, and bytes of level files kept where they cannot be mapped.
WAITING, KEPT_BYTES = 4 << 20, 256 << 20
#: The end of a text, also the context of its first word; equals no word's hash in practice.
END = np.uint64(0xE0D0C0B0A0908070)


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with their tokens: each text's words, then END."""
    for lo, hi, words, counts in tokens.hashed_words(column, PIECE):
        yield lo, hi, np.insert(words, np.cumsum(counts), END), counts + 1


def _count_words(bits: int):
    """(block, blob) of the words of each piece of text, a shard being a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words, _ in _words(batch.column(0)):
                unique, n = np.unique(words, return_counts=True)
                cuts = np.searchsorted(unique >> np.uint64(64 - bits), np.arange((1 << bits) + 1).astype(np.uint64))
                shards = [s for s in range(1 << bits) if cuts[s] < cuts[s + 1]]
                blobs = [pack(unique[cuts[s] : cuts[s + 1]], n[cuts[s] : cuts[s + 1]]) for s in shards]
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(blobs, pa.binary())], ["block", "blob"])

    return lean(run)


def _store(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    part = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    write_arrays(part, arrays)
    commit_shared(part, f"{folder}/{name}")


def _narrow(counts: np.ndarray) -> np.ndarray:
    top = int(counts.max()) if len(counts) else 0
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint32 if top < 1 << 32 else np.uint64)


def _write_words(folder: str, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for shard, word, n in _merged(batches):
            sequence = build(word - np.uint64(shard << (64 - bits)), 1 << (64 - bits))
            _store(folder, f"words-{shard}", sequence | {"counts": _narrow(n)})
            done.append((shard, len(word), int(n.sum())))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.int64()) for k in range(3)], ["shard", "words", "tokens"])

    return lean(run)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys as gaps and their counts, both as narrow as they allow."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    wide = int(gaps.max()) >= 1 << 32
    counts = _narrow(counts)
    return np.array([len(keys), wide, counts.itemsize], "<u8").tobytes() + gaps.astype("<u8" if wide else "<u4").tobytes() + counts.tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, wide, size = (int(x) for x in np.frombuffer(blob, "<u8", 3))
    gaps = np.frombuffer(blob, "<u8" if wide else "<u4", n, 24)
    return np.cumsum(gaps, dtype=np.uint64), np.frombuffer(blob, f"<u{size}", n, 24 + gaps.nbytes).astype(np.int64)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")  # runs of sorted keys are merged
    keys, counts = keys[order], counts[order]
    heads = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    return keys[heads], np.add.reduceat(counts, heads)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, keys, counts) of each block, whose blobs follow each other; no more waits than its size and WAITING entries."""
    current, parts, waiting = None, [], 0
    for batch in batches:
        for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            if block != current:
                if current is not None:
                    yield current, *_summed(parts)
                current, parts, waiting = block, [], 0
            parts.append(unpack(blob.as_buffer()))
            waiting += len(parts[-1][0])
            if waiting > max(WAITING, 2 * len(parts[0][0])):
                parts, waiting = [_summed(parts)], 0
    if current is not None:
        yield current, *_summed(parts)


class Level:
    """The grid of an order's blocks: where contexts' shards and words' groups start, and how many n-grams each block has."""

    def __init__(self, order: int, contexts: np.ndarray, words: np.ndarray, sizes: np.ndarray | None = None):
        self.order, self.contexts, self.words = order, contexts, words
        self.groups = len(words) - 1
        self.blocks = (len(contexts) - 1) * self.groups
        self.sizes = np.zeros(self.blocks, np.int64) if sizes is None else sizes
        self.bases = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def width(self, block: int) -> int:
        g = block % self.groups
        return max(1, int(self.words[g + 1] - self.words[g]))

    def shard_size(self, shard: int) -> int:
        return int(self.contexts[shard + 1] - self.contexts[shard])

    def numbers(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, number in it) of n-grams."""
        shard = np.searchsorted(self.contexts, context, side="right") - 1
        group = np.searchsorted(self.words, word, side="right") - 1
        block = (shard * self.groups + group).astype(np.uint16 if self.blocks < 1 << 16 else np.uint32)
        return block, ((context - self.contexts[shard]) * (self.words[group + 1] - self.words[group]) + word - self.words[group]).astype(np.uint64)

    def place(self, context: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(block, where its n-grams are among the given ones, their numbers in ascending order)."""
        block, value = self.numbers(context, word)
        order = np.argsort(block, kind="stable")
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(block[order])) + 1, [len(order)]])
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if lo < hi:
                part = order[lo:hi]
                part = part[np.argsort(value[part])]
                yield int(block[part[0]]), part, value[part]


class Model:
    """The levels of a folder; small enough to be sent to tasks."""

    def __init__(self, folder: str, bits: int, sizes: list[int], total: int):
        self.folder, self.bits, self.total = folder, bits, total
        self.bases = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.vocabulary = int(self.bases[-1])
        self.step = float(np.log10(max(1, total) / DISCOUNT)) / TOP_CODE
        self.levels: dict[int, Level] = {}
        self.open: OrderedDict[str, dict] = OrderedDict()

    def __getstate__(self):
        return self.__dict__ | {"open": OrderedDict()}

    def file(self, name: str) -> dict:
        """The arrays of a level file; mapped files stay open, others are kept up to KEPT_BYTES."""
        if name in self.open:
            self.open.move_to_end(name)
            return self.open[name]
        arrays = read_arrays(f"{self.folder}/{name}")
        if "meta" in arrays:
            arrays["sequence"] = EliasFano(arrays)
        self.open[name] = arrays
        if urlparse(self.folder).scheme not in ("", "file"):
            size = lambda held: sum(a.nbytes for a in held.values() if isinstance(a, np.ndarray))
            while len(self.open) > 1 and sum(map(size, self.open.values())) > KEPT_BYTES:
                self.open.popitem(last=False)
        return arrays

    def look_up(self, words: np.ndarray, backoff: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id or -1, count, back-off in log10) of sorted distinct words."""
        ids, counts, weights = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64), np.zeros(len(words))
        shards = (words >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.searchsorted(shards, np.arange((1 << self.bits) + 1))
        for shard in np.flatnonzero(np.diff(cuts)):
            if self.bases[shard] == self.bases[shard + 1]:
                continue
            part = slice(cuts[shard], cuts[shard + 1])
            held = self.file(f"words-{shard}")
            at, found = held["sequence"].successor(words[part] - np.uint64(int(shard) << (64 - self.bits)))
            ids[part][found] = self.bases[shard] + at[found]
            counts[part][found] = held["counts"][at[found]]
            if backoff:
                weights[part][found] = self.file(f"backoff1-{shard}")["codes"][at[found]] * -self.step
        return ids, counts, weights

    def find(self, order: int, context: np.ndarray, word: np.ndarray, codes: bool, backoff: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id or -1, log10 probability or NaN, log10 back-off as a context or 0) of n-grams of known contexts and words."""
        level = self.levels[order]
        ids, logs, weights = np.full(len(word), -1, np.int64), np.full(len(word), np.nan), np.zeros(len(word))
        for block, part, value in level.place(context, word):
            if not level.sizes[block]:
                continue
            at, found = self.file(f"keys{order}-{block}")["sequence"].successor(value)
            at, part = at[found], part[found]
            ids[part] = level.bases[block] + at
            if codes:
                logs[part] = self.file(f"codes{order}-{block}")["codes"][at] * -self.step
            if backoff:
                weights[part] = self.file(f"backoff{order}-{block}")["codes"][at] * -self.step
        return ids, logs, weights

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ALPHA) / (self.total + ALPHA * (self.vocabulary + 1)))

    def coded(self, share: np.ndarray) -> np.ndarray:
        """The codes of probabilities from 0.5 / N to 1."""
        return np.clip(np.rint(-np.log10(share) / self.step), 0, TOP_CODE).astype(np.uint16)


class Run:
    """The tokens of a run of texts with their ids: of the word, of the word before it, and whether it is a text's first."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, model: Model, backoff: bool):
        unique, back = np.unique(np.append(words, END), return_inverse=True)
        ids, n, weights = model.look_up(unique, backoff)
        self.token, self.first = back[:-1], np.cumsum(counts) - counts
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[self.first] = back[-1]
        self.ids, self.n, self.before, self.weight = ids[self.token], n[self.token], ids[before], weights[before]

    def longer(self, model: Model, order: int, codes: bool = False, backoff: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(known, ids, logs, weights) of the n-grams that end at each token; known tells where it was looked for."""
        context = self.before
        if order == 3:
            context = np.empty_like(self.ids)
            context[1:] = self.pairs[:-1]
            context[self.first] = -1
        known = np.flatnonzero((context >= 0) & (self.ids >= 0))
        ids, logs, weights = np.full(len(context), -1, np.int64), np.full(len(context), np.nan), np.zeros(len(context))
        ids[known], logs[known], weights[known] = model.find(order, context[known], self.ids[known], codes, backoff)
        return known, ids, logs, weights


def _count(model: Model, level: Level):
    """(block, blob, triples) of each piece of text: its pairs in the block, and the triples that begin with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words, counts in _words(batch.column(0)):
                r = Run(words, counts, model, False)  # all words are of the training part
                follows = np.ones(len(words), bool)
                follows[np.cumsum(counts) - 1] = False
                blocks, blobs, triples = [], [], []
                for block, part, value in level.place(r.before, r.ids):
                    new = np.concatenate([[True], value[1:] != value[:-1]])
                    heads = np.flatnonzero(new)
                    blocks.append(block)
                    blobs.append(pack(value[heads], np.diff(np.append(heads, len(value)))))
                    some = follows[part]
                    pair = (np.cumsum(new) - 1)[some]
                    triples.append(pack_triples(len(heads), pair, r.ids[part[some] + 1]))
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(blobs, pa.binary()), pa.array(triples, pa.binary())], ["block", "blob", "triples"])

    return lean(run)


def _joined(n: int, pair: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """A number for each pair's place, one of n, and word of at most so many bits."""
    if max(0, n - 1).bit_length() + bits > 64:
        raise OverflowError(f"{n} pairs and words of {bits} bits do not fit 64 bits: more blocks are needed")
    return (pair.astype(np.uint64) << np.uint64(bits)) | word.astype(np.uint64)


def pack_triples(n: int, pair: np.ndarray, word: np.ndarray) -> bytes:
    """Of each of n pairs, by place, how many words follow it, and these words with their counts."""
    bits = int(word.max(initial=0)).bit_length()
    keys = np.sort(_joined(n, pair, word, bits))
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return _triple_bytes(*_split(n, keys[heads], bits), np.diff(np.append(heads, len(keys))))


def _split(n: int, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(words after each of n pairs, these words) of sorted numbers of _joined()."""
    return np.bincount((keys >> np.uint64(bits)).astype(np.int64), minlength=n), keys & np.uint64((1 << bits) - 1)


def _triple_bytes(kinds: np.ndarray, word: np.ndarray, counts: np.ndarray) -> bytes:
    kinds, counts = _narrow(kinds), _narrow(counts)
    wide = len(word) > 0 and int(word.max()) >= 1 << 32
    return np.array([len(kinds), len(word), kinds.itemsize, wide, counts.itemsize], "<u8").tobytes() + kinds.tobytes() + word.astype("<u8" if wide else "<u4").tobytes() + counts.tobytes()


def unpack_triples(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, m, kind, wide, size = (int(x) for x in np.frombuffer(blob, "<u8", 5))
    kinds = np.frombuffer(blob, f"<u{kind}", n, 40)
    word = np.frombuffer(blob, "<u8" if wide else "<u4", m, 40 + kinds.nbytes)
    return kinds.astype(np.int64), word, np.frombuffer(blob, f"<u{size}", m, 40 + kinds.nbytes + word.nbytes)


def _joined_triples(pairs: np.ndarray, items: list[tuple], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of pair's place and word, counts) of items(pairs, kinds, words, counts) over the sorted pairs that hold all of theirs."""
    keys = [_joined(len(pairs), np.repeat(np.searchsorted(pairs, own), kinds), word, bits) for own, kinds, word, _ in items]
    return _summed([(k, c.astype(np.int64)) for k, (*_, c) in zip(keys, items)])


def _merge(folder: str, level: Level, vocabulary: int, orders: int):
    """Writes keys and counts of each block's pairs and of the triples that begin with them; yields (block, pairs, triples)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, items, waiting, done, bits = None, [], [], 0, [], vocabulary.bit_length()

        def compact() -> np.ndarray:
            nonlocal parts, waiting
            parts = [_summed(parts)]
            pairs = parts[0][0]
            if items and orders > 2:
                keys, counts = _joined_triples(pairs, items, bits)
                items[:] = [(pairs, *_split(len(pairs), keys, bits), counts)]
            waiting = 0
            return pairs

        def close() -> None:
            pairs = compact()
            shard = current // level.groups
            _store(folder, f"keys2-{current}", build(pairs, max(1, level.shard_size(shard) * level.width(current))) | {"counts": _narrow(parts[0][1])})
            triples = 0
            if orders > 2:
                _, kinds, word, counts = items[0]
                triples = len(word)
                keys = np.repeat(np.arange(len(pairs), dtype=np.uint64), kinds) * np.uint64(vocabulary) + word
                _store(folder, f"keys3-{current}", build(keys, max(1, len(pairs) * vocabulary)) | {"counts": _narrow(counts)})
            done.append((current, len(pairs), triples))

        for batch in batches:
            for block, blob, more in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if block != current:
                    if current is not None:
                        close()
                    current, parts, items, waiting = block, [], [], 0
                parts.append(unpack(blob.as_buffer()))
                items.append((parts[-1][0], *unpack_triples(more.as_buffer())))
                waiting += len(parts[-1][0]) + len(items[-1][2])
                if waiting > max(WAITING, 2 * (len(parts[0][0]) + len(items[0][2]))):
                    compact()
        if current is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.int64()) for k in range(3)], ["block", "pairs", "triples"])

    return lean(run)


def _context_counts(model: Model, level: Level, shard: int) -> np.ndarray:
    """The counts of the contexts of a shard: words, or n-grams of the order below."""
    if level.order == 2:
        return model.file(f"words-{shard}")["counts"] if level.shard_size(shard) else np.zeros(0, np.uint32)
    return model.file(f"keys{level.order - 1}-{shard}")["counts"] if level.shard_size(shard) else np.zeros(0, np.uint32)


def _write_backoff(folder: str, model: Model, level: Level):
    """Back-off codes of the contexts of each shard, from all of its blocks; 1 for contexts without successors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                size = level.shard_size(shard)
                kinds = np.zeros(size, np.int64)
                for block in range(shard * level.groups, (shard + 1) * level.groups):
                    if level.sizes[block]:
                        keys = model.file(f"keys{level.order}-{block}")["sequence"].values()
                        kinds += np.bincount((keys // np.uint64(level.width(block))).astype(np.int64), minlength=size)
                counts = _context_counts(model, level, shard)
                share = np.where(kinds > 0, DISCOUNT * kinds / np.maximum(counts, 1), 1.0)
                if size:
                    _store(folder, f"backoff{level.order - 1}-{shard}", {"codes": model.coded(share)})
            yield batch

    return lean(run)


def _write_codes(folder: str, model: Model, level: Level):
    """Codes of the log10 probabilities of each block's n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                if not level.sizes[block]:
                    continue
                held, shard = model.file(f"keys{level.order}-{block}"), block // level.groups
                context, word = np.divmod(held["sequence"].values().astype(np.int64), level.width(block))
                word += int(level.words[block % level.groups])
                backoff = model.file(f"backoff{level.order - 1}-{shard}")["codes"][context] * -model.step
                if level.order == 2:
                    lower = model.log_base(_word_counts(model, word))
                else:
                    below = model.levels[level.order - 1]
                    last = (model.file(f"keys{below.order}-{shard}")["sequence"].values() % np.uint64(below.width(shard))).astype(np.int64) + int(below.words[shard % below.groups])
                    lower = model.find(below.order, last[context], word, True, False)[1]
                share = (held["counts"] - DISCOUNT) / _context_counts(model, level, shard)[context] + 10 ** (backoff + lower)
                _store(folder, f"codes{level.order}-{block}", {"codes": model.coded(share)})
            yield batch

    return lean(run)


def _word_counts(model: Model, word: np.ndarray) -> np.ndarray:
    out = np.empty(len(word))
    of = np.searchsorted(model.bases, word, side="right") - 1
    for s in np.unique(of):
        out[of == s] = model.file(f"words-{s}")["counts"][word[of == s] - model.bases[s]]
    return out


def score_run(model: Model, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, base log10 probability, log10 probability) of each token."""
    r = Run(words, counts, model, True)
    base = model.log_base(r.n.astype(np.float64))
    _, r.pairs, logs, weights = r.longer(model, 2, True, True)
    full = np.where(np.isnan(logs), base + r.weight, logs)
    if 3 in model.levels:
        _, _, logs, _ = r.longer(model, 3, True)
        ahead = np.zeros(len(full))
        ahead[1:] = weights[:-1]  # back-off of the pair before, 0 where the model lacks it
        ahead[r.first] = 0
        full = np.where(np.isnan(logs), full + ahead, logs)
    return r.n, base, full


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, counts in _words(batch.column("text")):
                n, base, full = score_run(model, words, counts)
                heads = np.cumsum(counts) - counts
                sums = [np.add.reduceat(x, heads) for x in ((n > 0).astype(np.int64), base, full)]
                rows = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, rows), batch.column("held_out").slice(lo, rows), pa.array(counts.astype(np.int64)), pa.array(sums[0]), pa.array(np.full(rows, model.total)), pa.array(sums[1]), pa.array(sums[2])],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return lean(run)


def _starts(bases: np.ndarray, groups: int) -> np.ndarray:
    """Starts of groups of words: every so many shards, or parts of the ids where there are more groups than shards."""
    size = int(bases[-1])
    return np.array([size * g // groups for g in range(groups + 1)], np.int64)


def train(texts: DataFrame, folder: str, orders: int = ORDERS) -> Model:
    """Counts texts(text), writes the level files below folder and returns the model of 2 or 3 orders."""
    spark = texts.sparkSession
    text = texts.select(F.col("text").cast("string").alias("text"))
    # About six bytes a token; only the number of blocks depends on it.
    guess = (text.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    blocks = max(4, -(-guess // BLOCK))
    bits = max(1, min(16, (blocks - 1).bit_length() // 2 + 1))
    n = 1 << bits
    dealt = lambda counted, k: counted.withColumn("slot", slot_of(F.col("block"), slots(spark, k))).repartition(k, "slot").sortWithinPartitions("block").drop("slot")
    sharded = dealt(text.mapInArrow(_count_words(bits), "block long, blob binary"), n)
    sizes, total = [0] * n, 0
    for r in materialise(sharded.mapInArrow(_write_words(folder, bits), "shard long, words long, tokens long"), "shards").collect():  # one row a shard
        sizes[r.shard] = r.words
        total += r.tokens
    model = Model(folder, bits, sizes, total)
    level = Level(2, model.bases, _starts(model.bases, max(1, -(-blocks // n))))
    counted = text.mapInArrow(_count(model, level), "block long, blob binary, triples binary")
    merged = dealt(counted, level.blocks).mapInArrow(_merge(folder, level, model.vocabulary, orders), "block long, pairs long, triples long")
    pairs, triples = np.zeros(level.blocks, np.int64), np.zeros(level.blocks, np.int64)
    for r in materialise(merged, "blocks").collect():  # one row a block
        pairs[r.block], triples[r.block] = r.pairs, r.triples
    levels = [Level(2, level.contexts, level.words, pairs)]
    if orders > 2:
        levels.append(Level(3, levels[0].bases, np.array([0, model.vocabulary], np.int64), triples))
    for level in levels:
        for count, step in ((len(level.contexts) - 1, _write_backoff), (level.blocks, _write_codes)):
            spark.range(0, count, 1, count).mapInArrow(step(folder, model, level), "id long").write.format("noop").mode("overwrite").save()
        model.levels[level.order] = level
    return model


def score_documents(docs: DataFrame, orders: int = ORDERS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The model learns from the documents whose crc32(doc_id as text) mod 10 is
    not 0 (a null doc_id counts as the empty text, so it is held out).  Null
    and empty texts have one token, the end.  base_score is the sum of
    log10((c + 0.1) / (N + 0.1 (V + 1))); score the model's log10 probability.
    Repeated rows count as often as they occur; texts of any length are read
    whole; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("held_out", held)
    model = train(rows.filter(~F.col("held_out")).select("text"), workspace(spark, "model"), orders)
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
