"""Elias-Fano sequences in memory-mapped level files.

A non-decreasing sequence is split into low bits, stored plainly, and high
bits, stored in unary: a one for each element and a zero after each bucket of
equal high bits.  The position of the h-th zero points to the end of bucket h,
so the successor of a value is found by two selects and a binary search inside
one bucket.  All operations take whole arrays of queries.
"""

from __future__ import annotations

import json
from urllib.parse import urlparse

import numpy as np

from thicket.llm.runtime import open_shared

#: Widths that low bits are stored in, each as arrays of unsigned integers; the last 4 bits of a width lie two to a byte.
WIDTHS = {4: (4,), 8: (8,), 12: (8, 4), 16: (16,), 20: (16, 4), 24: (16, 8), 28: (16, 8, 4), 32: (32,), 36: (32, 4), 40: (32, 8), 44: (32, 8, 4), 48: (32, 16)}
_SELECT = np.full((256, 8), 8, np.uint8)
for _byte in range(256):
    for _k, _bit in enumerate([i for i in range(8) if not _byte >> i & 1]):
        _SELECT[_byte, _k] = _bit


def build(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of the sequence; values are unsigned, sorted and below universe."""
    n = len(values)
    share = universe / max(1, n)
    # Of the widths, the one of the least size: low bits, and a bit for each element and bucket.
    low = min(WIDTHS, key=lambda w: (w + 1 + share / 2.0**w, w))
    out: dict[str, np.ndarray] = {"meta": np.array([n, low, (universe - 1 >> low) + 1 if universe else 0], np.int64)}
    rest = values.astype(np.uint64)
    for k, width in enumerate(WIDTHS[low]):
        part = (rest & np.uint64((1 << width) - 1)).astype(f"u{max(1, width // 8)}")
        if width == 4:
            part = np.append(part, np.zeros(n % 2, np.uint8))
            part = part[::2] | part[1::2] << 4
        out[f"low{k}"] = part
        rest = rest >> np.uint64(width)
    high = rest.astype(np.int64)
    bits = np.zeros((int(out["meta"][2]) + n + 7) // 8 * 8 + 8, np.uint8)
    bits[high + np.arange(n)] = 1
    packed = np.packbits(bits, bitorder="little")
    out["bits"] = np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)])
    per_word = 64 - np.bitwise_count(out["bits"].view(np.uint64)).astype(np.int64)
    out["zeros"] = np.concatenate([[0], np.cumsum(per_word)[:-1]]).astype(np.uint32)
    return out


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits, self.buckets = (int(x) for x in arrays["meta"])
        widths = WIDTHS[self.low_bits]
        self.lows = [(arrays[f"low{k}"], w, np.uint64(sum(widths[:k]))) for k, w in enumerate(widths)]
        self.words, self.zeros = arrays["bits"].view(np.uint64), arrays["zeros"]

    def _bounds(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first element, index after the last) of each bucket.

        The ones right before the bucket's zero are its elements; where they
        reach the start of a word, the zero before is looked for as well.
        """
        word, place = self._zero(bucket)
        end = word * 64 + place - bucket
        below = self.words[word] << (np.uint64(63) - place.astype(np.uint64)) << np.uint64(1)  # the bits before, at the top
        rest = ~below
        for shift in (1, 2, 4, 8, 16, 32):
            rest |= rest >> np.uint64(shift)
        run = 64 - np.bitwise_count(rest).astype(np.int64)  # leading ones
        start = end - run
        open_ = np.flatnonzero(run >= place)
        if len(open_):
            first = bucket[open_] == 0
            word, place = self._zero(np.where(first, 0, bucket[open_] - 1))
            start[open_] = np.where(first, 0, word * 64 + place - (bucket[open_] - 1))
        return start, end

    def _zero(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, place in it) of the zero that ends each bucket."""
        word = np.searchsorted(self.zeros, bucket.astype(self.zeros.dtype), side="right") - 1
        left = bucket - self.zeros[word]
        free = ~self.words[word]
        at = np.zeros(len(bucket), np.uint64)
        for width in (32, 16, 8):  # halves, until the byte that holds the zero asked for
            low = np.bitwise_count(free & np.uint64((1 << width) - 1)).astype(np.int64)
            over = left >= low
            left -= np.where(over, low, 0)
            step = np.where(over, np.uint64(width), np.uint64(0))
            at += step
            free >>= step
        return word, at.astype(np.int64) + _SELECT[~free.astype(np.uint8), left]

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = None
        for held, width, shift in self.lows:
            part = held[at] if width > 4 else held[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & 15
            out = part.astype(np.uint64) << shift if out is None else out | part.astype(np.uint64) << shift
        return out

    def values(self) -> np.ndarray:
        """The whole sequence."""
        ones = np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(np.arange(self.n))

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first element of the value's bucket or later that is not below it, whether it equals the value).

        Sorted values are found faster, as neighbours share what is read.
        """
        if not self.n or not len(values):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        values = values.astype(np.uint64)
        bucket = (values >> np.uint64(self.low_bits)).astype(np.int64)
        low = values & np.uint64((1 << self.low_bits) - 1)
        lo, end = self._bounds(bucket)
        # Most buckets hold few elements: step through them, and halve what is left of the others.
        equal = np.zeros(len(values), bool)
        open_ = np.flatnonzero(lo < end)
        at, until, asked = lo[open_], end[open_], low[open_]
        for _ in range(4):
            here = self._low(at)
            less = here < asked
            equal[open_[here == asked]] = True
            at = at + less
            on = less & (at < until)
            lo[open_[~on]] = at[~on]
            open_, at, until, asked = open_[on], at[on], until[on], asked[on]
            if not len(open_):
                return lo, equal
        while len(open_):
            mid = (at + until) >> 1
            less = self._low(mid) < asked
            at, until = np.where(less, mid + 1, at), np.where(less, until, mid)
            on = at < until
            lo[open_[~on]] = at[~on]
            open_, at, until, asked = open_[on], at[on], until[on], asked[on]
        inside = np.flatnonzero(~equal & (lo < end))
        equal[inside] = self._low(lo[inside]) == low[inside]
        return lo, equal


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A level file: a length, a JSON directory, and the arrays at multiples of 64 bytes."""
    directory, at = {}, 0
    for name, a in arrays.items():
        at += -at % 64
        directory[name] = [a.dtype.str, len(a), at]
        at += a.nbytes
    head = json.dumps(directory).encode()
    head += b" " * (-(8 + len(head)) % 64)
    with open_shared(path, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        done = 0
        for name, a in arrays.items():
            gap = directory[name][2] - done
            f.write(b"\0" * gap + np.ascontiguousarray(a).tobytes())
            done += gap + a.nbytes


def read_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a level file, mapped where the shared folder is mounted."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        raw = np.memmap(url.path, np.uint8, "r").view(np.ndarray)
    else:
        with open_shared(path, "rb") as f:
            raw = np.frombuffer(f.read(), np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    base = 8 + size
    return {k: raw[base + at : base + at + np.dtype(kind).itemsize * n].view(kind) for k, (kind, n, at) in json.loads(raw[8:base].tobytes()).items()}
