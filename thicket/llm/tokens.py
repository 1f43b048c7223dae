"""Vectorised word hashing over Arrow string buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8
text, with A-Z folded to lower case.  Every word gets a 64-bit hash, computed
for a whole piece of text at once: with odd P, the prefix sums of
``byte * P**i`` modulo 2**64 give the hash of any slice by one subtraction and
one multiplication with ``P**-start``.  A text of any length is hashed in
pieces of about ``PIECE`` bytes, cut at white space, so the working memory is
bounded by the piece and the word hashes of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint64) + np.uint64(1)
FOLD[65:91] += np.uint64(32)
EXACT = np.arange(256, dtype=np.uint64) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i < n, grown on demand."""
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + 1)
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        for name, base in (("up", _P), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if offsets is not None else np.zeros(len(column) + 1, np.int32)
    return at.astype(np.int64), np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)


def word_spans(data: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in data; firsts/lasts are the bounds of its texts."""
    space = SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = True
    before[1:] = space
    after = before[1:].copy()
    before = before[:-1]
    after[:-1] = space[1:]
    after[-1:] = True
    full = lasts > firsts
    before[firsts[full]] = True
    after[lasts[full] - 1] = True
    solid = ~space
    return np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1


def _hash_piece(data: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, table: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = word_spans(data, firsts, lasts)
    return hash_spans(data, starts, ends, table), starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = FOLD) -> np.ndarray:
    """64-bit hashes of slices of data, whose bytes are mapped by table."""
    up, down = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes += (ends - starts).astype(np.uint64) * _M1
    return mix(hashes)


def hashed_words(column: pa.Array, piece: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, word hashes, words per row) for runs of rows."""
    for lo, hi, data, firsts, lasts in text_runs(column, piece or PIECE):
        if hi - lo == 1 and len(data) > 2 * (piece or PIECE):
            parts = [_hash_piece(p, np.zeros(1, np.int64), np.array([len(p)]))[0] for p in cut(data, piece or PIECE)]
            words = np.concatenate(parts)
            yield lo, hi, words, np.array([len(words)])
            continue
        words, starts, _ = _hash_piece(data, firsts, lasts)
        bounds = np.searchsorted(starts, np.append(firsts, len(data)))
        yield lo, hi, words, np.diff(bounds)


def text_runs(column: pa.Array, piece: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows of at most about piece bytes: (first row, end row, bytes, firsts, lasts)."""
    at, data = string_buffers(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + piece, side="right")) - 1)
        hi = min(hi, n)
        base = at[lo]
        yield lo, hi, data[base : at[hi]], at[lo:hi] - base, at[lo + 1 : hi + 1] - base
        lo = hi


def cut(data: np.ndarray, piece: int) -> Iterator[np.ndarray]:
    """Pieces of one text, cut at white space; a longer word stays whole."""
    lo = 0
    while lo < len(data):
        hi = min(lo + piece, len(data))
        while hi < len(data):
            gap = np.flatnonzero(SPACE[data[hi : hi + piece]])
            if len(gap):
                hi += int(gap[0])
                break
            hi = min(hi + piece, len(data))
        yield data[lo:hi]
        lo = hi


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, shingles per row) of n-word shingles, repeats kept.

    A row with 1 to n-1 words has one shingle, the whole sequence; a row
    without words has none.  The hash depends on the words and their number.
    """
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    total = int(made.sum())
    if not total:
        return np.zeros(0, np.uint64), made
    skipped = np.repeat(firsts - (np.cumsum(made) - made), made)
    at = np.arange(total) + skipped
    short = np.repeat(counts < n, made)
    out = np.zeros(total, np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    left = np.repeat(counts, made) if short.any() else None
    step = np.uint64(1)
    for k in range(n):
        term = padded[at + k] * step
        if left is not None:
            term = np.where(short & (left <= k), np.uint64(0), term)
        out += term
        step = np.uint64((int(step) * int(_P)) % (1 << 64))
    out += (np.where(short, left, n) if left is not None else np.full(total, n)).astype(np.uint64) * _M2
    return mix(out), made


def permutations(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """k odd multipliers and offsets for 32-bit min-wise hashing."""
    r = np.random.Generator(np.random.PCG64(seed))
    return (r.integers(0, 1 << 32, k, dtype=np.uint64) | np.uint64(1)).astype(np.uint32), r.integers(0, 1 << 32, k, dtype=np.uint64).astype(np.uint32)


def minhash(shingles: np.ndarray, made: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row by k: minimum of each permutation over the row's shingles; rows without shingles get 2**32-1."""
    out = np.full((len(made), len(multipliers)), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(made > 0)
    if len(full):
        heads = (np.cumsum(made) - made)[full]
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        for k, (a, b) in enumerate(zip(multipliers, offsets)):
            out[full, k] = np.minimum.reduceat(low * a + b, heads)
    return out
