"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, tokens.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last keep the columns of documents.

Rows with a null doc_id pass every stage, as they cannot be told apart; null
and empty texts are sampled like others, are no near duplicates, hold no item
and have no ids.  Rows that repeat a doc_id are kept or dropped together.
Columns of any other name go through unchanged; an empty table, and empty
labels or benchmark, give what follows from them (nothing is rejected for
quality, nothing is contaminated).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.llm.decontaminate import remove_contaminated
from thicket.llm.neardup import near_duplicates
from thicket.llm.pii import masked
from thicket.llm.prefilter import split_listed
from thicket.llm.quality import keep_quality
from thicket.llm.runtime import materialise
from thicket.llm.sentencepiece_codec import encode_decode


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling rejects go."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the document of the least doc_id stays."""
    gone = materialise(near_duplicates(docs, shingle=5, percent=80).filter(~F.col("kept")).select("doc_id"), "gone")
    maybe, never = split_listed(docs, gone)
    return maybe.join(gone.hint("merge"), "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(never)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def surrogate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get surrogates."""
    return masked(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, in place of its text."""
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii_surrogates", surrogate_stage),
    ("sentencepiece", token_stage),
]

#: The resampling, the detectors and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
