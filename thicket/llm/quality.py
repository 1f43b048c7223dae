"""Quality by importance resampling of hashed n-gram models.

Two bag-of-n-grams generative models are estimated over hashed buckets: the
target from labelled documents of quality 1 and the raw one from all documents.
The n-grams are tokens and pairs of neighbouring tokens, a token being a run of
letters and digits or a run of other characters (white space separates); a pair
of one token with itself is one n-gram, whatever the token.  A text's importance
is the ratio of its two likelihoods; as its logarithm grows with the length,
``log_weight`` is that of a passage of PASSAGE n-grams with the text's mean, so
that short and long texts are sampled alike.  Documents are sampled without
replacement by Gumbel top-k: the k largest values of log_weight plus keyed
Gumbel noise of scale 1.  k is a parameter; where it is not given, it is the
share of quality 1 among the labelled documents, of all documents.
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

BUCKETS = 1 << 16
#: At most about this many labelled rows of quality 1 are used to fit the target model.
LABEL_ROWS = 200_000
#: N-grams of the passage that log_weight is for.
PASSAGE = 100
#: Pseudo-counts a bucket by which the target model leans on the raw one.
PRIOR = 1
SEED = 20

# Byte classes of tokens: white space, letters and digits, others.
CLASS = np.full(256, 2, np.uint8)
CLASS[[*range(48, 58), *range(65, 91), ord("_"), *range(97, 123), *range(128, 256)]] = 1
CLASS[tokens.SPACE] = 0
#: The n-gram of a token with itself.
REPEAT = tokens.mix(np.array([0x5EED], np.uint64))[0]


def _token_hashes(data: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the tokens of a run of texts."""
    kind = CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[firsts] = edge[lasts] = True
    at = np.flatnonzero(edge)
    solid = kind[at[:-1]] > 0
    starts = at[:-1][solid]
    return tokens.hash_spans(data, starts, at[1:][solid], tokens.EXACT), starts


def _ngrams(data: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, row of each, last token) of the n-grams of a run of texts; before: the last token of the text's part before."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes, starts = _token_hashes(data, firsts, lasts)
    row = np.searchsorted(firsts, starts, side="right") - 1
    left, right, of = hashes[:-1], hashes[1:], row[1:]
    inside = row[1:] == row[:-1]
    left, right, of = left[inside], right[inside], of[inside]
    if before is not None and len(before) and len(hashes):
        left, right, of = np.append(left, before), np.append(right, hashes[:1]), np.append(of, row[:1])
    pairs = np.where(left == right, REPEAT, tokens.mix(left * np.uint64(3) + right))
    grams = np.concatenate([hashes, pairs])
    return (grams % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([row, of]), hashes[-1:]


def _runs(column: pa.Array) -> Iterator[tuple[int, int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, end row, parts of (buckets, row of each)); a very long text comes in parts."""

    def parts(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        last = None
        for piece in tokens.cut(data, tokens.PIECE):
            bucket, row, end = _ngrams(piece, np.zeros(1, np.int64), np.array([len(piece)]), last)
            last = end if len(end) else last
            yield bucket, row

    for lo, hi, data, firsts, lasts in tokens.text_runs(column, tokens.PIECE):
        if hi - lo == 1 and len(data) > 2 * tokens.PIECE:
            yield lo, hi, parts(data)
        else:
            yield lo, hi, iter([_ngrams(data, firsts, lasts)[:2]])


def _count(good_ids):
    """Bucket counts of all texts, and of those whose doc_id is in the sorted good_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.frombuffer(good_ids.value, np.int64)
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(listed, ids)
            good = (at < len(listed)) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            good[good] = listed[at[good]] == ids[good]
            for lo, hi, parts in _runs(batch.column("text")):
                for bucket, row in parts:
                    raw += np.bincount(bucket, minlength=BUCKETS)
                    target += np.bincount(bucket[good[lo:hi][row]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    return lean(run)


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each bucket; the target leans on the raw model, which is smoothed by 0.5."""
    if not target.sum():
        return np.zeros(len(raw))
    prior = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    strength = PRIOR * len(raw)
    return np.round(np.log((target + strength * prior) / (target.sum() + strength) / prior), 9)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """(log ratio of each bucket, share of quality 1 among the labelled documents); zeros and 1 without labels of quality 1."""
    spark = docs.sparkSession
    bounded_batches(spark)
    once = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    total, good = once.agg(F.count("*"), F.count_if(F.col("quality") == 1)).first()
    if not good:
        return np.zeros(BUCKETS), 1.0
    # At most twice LABEL_ROWS ids, chosen by a hash: the only part of the labels that leaves the tasks.
    chosen = once.filter("quality = 1").filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * min(1, LABEL_ROWS / good))).select("doc_id").limit(2 * LABEL_ROWS)
    ids = spark.sparkContext.broadcast(np.sort(chosen.toArrow()["doc_id"].to_numpy()).tobytes())
    counts = _texts(docs).mapInArrow(_count(ids), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    found = counts.toArrow()  # at most BUCKETS rows
    raw[found["bucket"].to_numpy()], target[found["bucket"].to_numpy()] = found["raw"].to_numpy(), found["target"].to_numpy()
    return log_ratio(raw, target), good / total


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def gumbel(ids: np.ndarray) -> np.ndarray:
    """The keyed noise of each doc_id."""
    noise = tokens.mix(ids.astype(np.int64).view(np.uint64) ^ np.uint64(SEED * 0x9E3779B9))
    return -np.log(-np.log(((noise >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)))


def _score(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for lo, hi, parts in _runs(batch.column("text")):
                for bucket, row in parts:
                    weight[lo:hi] += np.bincount(row, ratio[bucket], minlength=hi - lo)
                    n[lo:hi] += np.bincount(row, minlength=hi - lo)
            weight *= PASSAGE / np.maximum(n, 1)
            key = np.round(weight + gumbel(batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)), 9)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(weight, 6)), pa.array(key)], ["doc_id", "log_weight", "sample_key"])

    return lean(run)


def weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, log_weight and sample_key of every row."""
    return _texts(docs).mapInArrow(_score(ratio.astype(np.float64)), "doc_id long, log_weight double, sample_key double")


def top_k_key(keys: DataFrame, k: int, column: str = "sample_key") -> float:
    """The k-th largest value, by counting into finer and finer bins; the driver sees bin counts only."""
    if k <= 0:
        return float("inf")
    lo, hi, total = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= total:
        return float("-inf")
    above, bins = 0, 4096
    for _ in range(12):
        width = (hi - lo) / bins
        if width <= 0 or lo + width == lo:
            break
        part = keys.filter((F.col(column) >= lo) & (F.col(column) <= hi)).groupBy(F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)).alias("bin"))
        for r in part.agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy(F.desc("bin")).collect():
            if above + r.n >= k:
                lo, hi, left = r.lo, r.hi, r.n
                break
            above += r.n
        if lo == hi or left == k - above:
            break
    return lo


def quality_sample(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """doc_id, log_weight, sample_key, kept for every row of docs.

    Equal keys at the boundary are all kept.  Null and empty texts have
    log_weight 0 and are sampled like any other; a row with a null doc_id
    cannot be told from others and is kept.  A doc_id labelled more than once
    has its highest quality; without a label of quality 1 everything is kept.
    Rows that repeat are sampled alike; texts of any length are read whole;
    other columns are ignored; an empty table gives an empty result.
    """
    ratio, share = fit(docs, labels)
    scored = materialise(weights(docs, ratio), "weights")
    bound = top_k_key(scored, round(share * scored.count()) if k is None else k)
    return scored.withColumn("kept", F.col("doc_id").isNull() | (F.col("sample_key") >= bound))


def keep_quality(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows of docs, all columns, that the sampling keeps.

    Only texts that a map of fixed size cannot rule out are shuffled to be
    joined with the rejected ids.  Odd rows are treated as in quality_sample.
    """
    scored = quality_sample(docs, labels, k)
    gone = materialise(scored.filter(~F.col("kept")).select("doc_id").distinct(), "rejected")
    maybe, never = split_listed(docs, gone)
    return maybe.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(never)
