"""Byte-pair token counts: texts cut by one expression, every distinct piece merged once a task, sizes added up in the row."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thicket.session import small_batches

#: Distinct pieces whose sizes a task holds.
HELD = 500_000
# White space as Unicode has it, and how byte-level BPE cuts a text before merging.
_SPACE = "\\t-\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
PIECES = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def pieces(text: Column) -> Column:
    """The pieces of a text, in order; they hold all of it, and no token crosses them."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECES), F.lit(0))


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a file of 'token-in-base64 rank' lines, once a worker."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merged(piece: bytes, known: dict[bytes, int]) -> list[bytes]:
    """The tokens of a piece: of all neighbours the pair of least rank is joined, the first of equals, until none is known.

    The pairs wait in a heap and parts are linked, so a piece of n bytes takes
    about n * log(n) steps.
    """
    if piece in known:
        return [piece]
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts):
            pair = parts[i] + parts[j]
            if pair in known:
                heapq.heappush(heap, (known[pair], i, pair))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or parts[i] + parts[j] != pair:
            continue  # one of the two has been joined to another since
        parts[i], parts[j] = pair, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p is not None]


def _counts(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sizes = ranks(path), {}
        for batch in batches:
            lists = batch.column(1)
            coded = lists.flatten().dictionary_encode()
            pieces = coded.dictionary.to_pylist()
            if len(sizes) > HELD:
                sizes = {}
            for p in pieces:
                if p not in sizes:
                    sizes[p] = len(merged(p.encode(), known))
            each = np.array([sizes[p] for p in pieces], np.int64)[coded.indices.to_numpy()]
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            upto = np.r_[0, np.cumsum(each)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(np.r_[0, upto[ends]]))], ["_key", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens) of every row by a byte-pair rank file; null and empty texts have 0.

    Rows stay where they are: a task merges each piece that it meets once, and
    starts its table of pieces anew when it holds more than HELD.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("_key"), pieces(F.col(f"`{text}`").cast("string")).alias("pieces"))
    return rows.mapInArrow(_counts(path), f"_key {kind}, n_tokens long").withColumnRenamed("_key", key)
