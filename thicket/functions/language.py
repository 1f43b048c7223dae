"""Language identification by hashed character trigrams, learned from labelled texts.

A text's form is its letters (A-Z folded, every other script as it is) with one
space in place of anything else and one at either end; its trigrams are hashed
into ``BUCKETS``.  The model is naive Bayes with add-one smoothing: for each
label and bucket a whole number of micro-nats, so scores are exact sums.  A
model has at most ``BUCKETS`` rows a label, whatever it was learned from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
#: Multipliers of the first two characters of a trigram, and micro-nats of a nat.
FIRST, SECOND, SCALE = 40503, 257, 1_000_000
#: Labels whose counts a task holds at a time, and bytes of text that are hashed at a time.
HELD_LABELS, PIECE = 64, 1 << 20
MODEL = "label string, bucket int, weight long"
#: Bytes of letters as they are in the form, 32 for all others.
_FORM = np.full(256, 32, np.uint8)
_FORM[97:123], _FORM[65:91], _FORM[128:] = np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)


def _runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about PIECE bytes: (first row, end row, bytes, ends of the rows in them)."""
    column = column.fill_null("")
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw, lo = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), 0
    while lo < len(column):
        hi = max(lo + 1, min(int(np.searchsorted(at, at[lo] + PIECE, side="right")) - 1, len(column)))
        yield lo, hi, raw[at[lo] : at[hi]], at[lo + 1 : hi + 1] - at[lo]
        lo = hi


def _grams(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each trigram, trigrams of each row) of rows that follow each other in raw."""
    n = len(ends)
    form = np.insert(np.append(np.uint8(32), _FORM[raw]), ends + 1, np.uint8(32))  # a space at either end of each row
    edges = np.append(0, ends + 1 + np.arange(n))
    keep = np.append(True, (form[1:] != 32) | (form[:-1] != 32))
    start = keep & ((form & 0xC0) != 0x80)  # first bytes of characters
    chars = np.frombuffer(form[keep].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    if len(chars) != int(start.sum()):
        raise ValueError("a text is not UTF-8")
    # The space that stands for an edge: itself, or the one before that it merged with.
    edge = np.cumsum(start)[edges] - 1
    hashed = (chars[:-2] * FIRST + chars[1:-1] * SECOND + chars[2:]) % BUCKETS
    inner = np.ones(len(chars), bool)
    inner[edge] = False  # a trigram round an edge would join two rows
    return hashed[inner[1:-1]], np.maximum(np.diff(edge) - 1, 0)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for label, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["label", "bucket", "n"])
        held.clear()

    for batch in batches:
        labels = batch.column(0).to_pylist()
        for lo, hi, raw, ends in _runs(batch.column(1)):
            buckets, sizes = _grams(raw, ends)
            stops = np.cumsum(sizes)
            for label, stop, size in zip(labels[lo:hi], stops, sizes):
                if label not in held:
                    if len(held) >= HELD_LABELS:
                        yield from rows()
                    held[label] = np.zeros(BUCKETS, np.int64)
                if size:
                    np.add.at(held[label], buckets[stop - size : stop], 1)
    yield from rows()


def fit(docs: DataFrame, label: str = "lang", text: str = "text") -> DataFrame:
    """(label, bucket, weight) learned from docs; a null bucket holds the weight of those that a label lacks.

    Rows without a label are not learned from; null texts have no trigrams, so
    a label may have a null bucket only.  Tasks count their texts, so at most a
    row for each label and bucket leaves a task.
    """
    counted = docs.select(F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{text}`").cast("string").alias("text")).filter("label IS NOT NULL").mapInArrow(_count, "label string, bucket int, n long")
    counts = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    labels = docs.select(F.col(f"`{label}`").cast("string").alias("label")).filter("label IS NOT NULL").distinct()
    total = F.log(F.coalesce(F.col("total"), F.lit(0)) + F.lit(float(BUCKETS)))
    totals = labels.join(counts.groupBy("label").agg(F.sum("n").alias("total")), "label", "left").select("label", total.alias("log_total"))
    micro = lambda c: F.round(c * SCALE).cast("long").alias("weight")
    known = counts.join(totals, "label").select("label", "bucket", micro(F.log(F.col("n") + F.lit(1.0)) - F.col("log_total")))
    return known.unionByName(totals.select("label", F.lit(None).cast("int").alias("bucket"), micro(-F.col("log_total"))))


class Identifier:
    """A fitted model at the driver: labels in order and a row of weights for each."""

    def __init__(self, model: DataFrame):
        rows = model.toArrow()  # BUCKETS + 1 rows a label at most
        names, bucket, weight = np.array(rows["label"].to_pylist(), object), rows["bucket"].to_pylist(), rows["weight"].to_numpy()
        self.labels = sorted(set(names), key=lambda x: x.encode())
        place = {x: i for i, x in enumerate(self.labels)}
        self.weights = np.zeros((len(self.labels), BUCKETS), np.int32)
        for name, b, w in zip(names, bucket, weight):
            if b is None:
                self.weights[place[name]] = w
        at = np.array([b is not None for b in bucket], bool)
        self.weights[[place[x] for x in names[at]], [b for b in bucket if b is not None]] = weight[at]


def predict(docs: DataFrame, model: DataFrame, keep: Iterable[str] = ("doc_id",), text: str = "text", default: str = "es") -> DataFrame:
    """The kept columns of every row with predicted, margin and n_grams.

    margin is the score of the predicted label less that of the second, in
    micro-nats: 0 for one label.  Equal scores go to the label that is first in
    UTF-8 order.  A text without letters (null and empty ones too) gets the
    default and margin 0, and so does every text under an empty model.  Texts
    are read whole, one label's scores at a time.
    """
    found, keep = Identifier(model), list(keep)
    sent = docs.sparkSession.sparkContext.broadcast((found.labels, found.weights))  # 256 KB a label
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").cast("string").alias("__text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights = sent.value
        for batch in batches:
            names, margins, sizes = [], [], []
            for lo, hi, raw, ends in _runs(batch.column(len(keep))):
                buckets, size = _grams(raw, ends)
                scores = np.zeros((max(2, len(labels)), hi - lo), np.int64)
                full = np.flatnonzero(size)
                if len(full) and labels:
                    first = (np.cumsum(size) - size)[full]
                    for k, row in enumerate(weights):
                        scores[k, full] = np.add.reduceat(row[buckets].astype(np.int64), first)
                scores = scores[: len(labels)]
                best = scores.argmax(0) if labels else np.zeros(hi - lo, int)
                top = np.sort(scores, 0)[-2:]
                names += [labels[b] if s and labels else default for b, s in zip(best, size)]
                margins += (top[1] - top[0]).tolist() if len(top) == 2 else [0] * (hi - lo)
                sizes += size.tolist()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(margins, pa.int64()), pa.array(sizes, pa.int64())], inner)

    # Any name may be kept, also one with a dot, which Arrow functions cannot take.
    inner = [*(f"c{i}" for i in range(len(keep))), "predicted", "margin", "n_grams"]
    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema[:-1])), "predicted string", "margin long", "n_grams long"])
    return rows.toDF(*inner[: len(keep)], "text").mapInArrow(run, schema).toDF(*keep, *inner[len(keep) :])
