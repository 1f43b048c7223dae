"""Token counts from a cache keyed by content and tokenizer.

The cache is a Parquet table of (tokenizer, content, n_tokens), both digests:
``tokenizer`` of the library's name, its version and the model file, ``content``
of the text in a form that has the same tokens.  Counting joins the digests of
all texts to the stored counts, encodes one text of each content that is
missing, appends those counts and reads the result from the cache.  Appended
files are added by Spark's commit, so a job that fails leaves the cache as it
was, and repeated rows, as two jobs at a time may write them, are harmless.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.llm.prefilter import split_listed
from thicket.llm.runtime import bounded_batches, lean, materialise, workspace
from thicket.llm.token_files import word_encoder

LIMIT = 2048
_CACHE = "tokenizer string, content binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Hex digest of what decides the tokens of a text: library, its version, and the file."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        data = f.read()
    return hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + data).hexdigest()


@lru_cache(maxsize=8)
def by_words(path: str) -> bool:
    """True if white space only parts words in a tokenizer, whatever its kind and length: its texts can be folded and encoded word by word.

    It must fold white space itself, drop it when it splits, and mark word ends.
    """
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    folding, cut = found["normalizer"] or {}, found["pre_tokenizer"] or {}
    steps, cuts = folding.get("normalizers", [folding]), cut.get("pretokenizers", [cut])
    folds = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " " for s in steps)
    drops = any(c.get("type") == "Split" and c.get("behavior") == "Removed" and c.get("invert") and r"[^\s" in c.get("pattern", {}).get("Regex", "") for c in cuts)
    bare = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") or " " in t["content"] for t in found["added_tokens"])
    return folds and drops and bare and found["model"].get("end_of_word_suffix") == "</w>" and not found["truncation"] and not found["padding"]


def content_digest(text: Column, path: str) -> Column:
    """Digest of the text's normal form: ASCII white space folded to one space and trimmed where the tokenizer ignores it, else as it is."""
    return F.unhex(F.sha2(F.trim(F.regexp_replace(text, r"[\t-\r ]+", " ")) if by_words(path) else text, 256))


@lru_cache(maxsize=2)
def _library(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def counts_of(path: str, texts: pa.Array) -> list[int]:
    """Tokens of each text, without begin, end or added special tokens."""
    if by_words(path):
        return [int(n) for _, counts in word_encoder(path).encode(texts) for n in counts]
    count, listed, out, at = _library(path), texts.to_pylist(), [], 0
    while at < len(listed):  # about 1 MB of text at a time
        end, size = at, 0
        while end < len(listed) and (end == at or size + len(listed[end]) < 1 << 20):
            size += len(listed[end])
            end += 1
        out += count(listed[at:end])
        at = end
    return out


def _encode(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts_of(path, batch.column(1)), pa.int64())], ["content", "n_tokens"])

    return lean(run)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored_counts(spark: SparkSession, cache: str, path: str) -> DataFrame:
    """content and n_tokens of a tokenizer in the cache, each content once; empty where there is no cache."""
    found = spark.read.schema(_CACHE).parquet(cache) if _exists(spark, cache) else spark.createDataFrame([], _CACHE)
    return found.filter(F.col("tokenizer") == tokenizer_version(path)).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def compact(spark: SparkSession, cache: str, target: str, files: int = 0) -> None:
    """Writes the cache's rows to target, each once, in order of content; files is their number (0: as the shuffle gives)."""
    rows = spark.read.schema(_CACHE).parquet(cache).groupBy("tokenizer", "content").agg(F.max("n_tokens").alias("n_tokens"))
    rows = rows.repartitionByRange(*([files] if files else []), "tokenizer", "content").sortWithinPartitions("tokenizer", "content")
    rows.write.partitionBy("tokenizer").parquet(target)


def add_missing(rows: DataFrame, keyed: DataFrame, path: str, cache: str) -> int:
    """Encodes one of rows(key, content, text) of each content of keyed(key, content) that the cache lacks, and appends its count; gives the number of them.

    key is content with the row's id.  Only the smaller part of the texts can
    move: either those to be encoded or those not to be are told apart by a
    map of fixed size, and the rest is read where it lies.
    """
    spark = rows.sparkSession
    missing = materialise(keyed.groupBy("content").agg(F.min("key").alias("key")).join(stored_counts(spark, cache, path), "content", "left_anti"), "missing")
    n = missing.count()
    if not n:
        return 0
    if 2 * n <= keyed.count():
        maybe, _ = split_listed(rows, missing.select("key"), "key")
        chosen = maybe.join(missing.select("key"), "key", "left_semi")
    else:
        spared = materialise(keyed.select("key").join(missing.select("key"), "key", "left_anti").distinct(), "spared")
        maybe, chosen = split_listed(rows, spared, "key")
        chosen = chosen.unionByName(maybe.join(spared, "key", "left_anti").select(*rows.columns))
    coded = chosen.select("content", "text").mapInArrow(_encode(path), "content binary, n_tokens long")
    once = coded.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    once.select(F.lit(tokenizer_version(path)).alias("tokenizer"), "content", "n_tokens").write.mode("append").partitionBy("tokenizer").parquet(cache)
    return n


def token_counts(docs: DataFrame, path: str, cache: str = "", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every row, through the cache.

    path is a tokenizers file (.json) or a sentencepiece model (.model); the
    counts are the library's, special strings in texts as it handles them by
    default, without truncation or padding.  cache is a folder that all
    executors reach, made if absent; without one a folder below the shared one
    lasts until the driver ends.

    Null texts count as empty; a null doc_id stays null; each row gives a row.
    Equal contents are encoded once (again only where rows repeat id and text)
    whatever their number; the join that hands their count to a frequent
    content's rows is one that adaptive execution can split.  Texts of any
    length are read whole; other columns are ignored; an empty table gives an
    empty result and adds nothing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    cache = cache or workspace(spark, "counts")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("content", content_digest(F.col("text"), path))
    rows = rows.withColumn("key", F.concat("content", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    keyed = materialise(rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content", "key"), "contents")
    add_missing(rows.select("key", "content", "text"), keyed.select("key", "content"), path, cache)
    found = keyed.join(stored_counts(spark, cache, path), "content")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
