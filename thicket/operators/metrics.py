"""Ranking metrics per query and their means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_occurrences(hits: DataFrame, keys: list[str], order: str = "rank") -> DataFrame:
    """The first row of each key, in order; what is left keeps its rank."""
    first = Window.partitionBy(*keys).orderBy(order)
    return hits.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def per_query(hits: DataFrame, qrels: DataFrame, k: int, dedup: bool = True) -> DataFrame:
    """precision, recall, hit, mrr, normalised_precision and n_relevant of every judged query at k.

    hits is (query_id, rank, doc_id), qrels (query_id, doc_id).  Without dedup
    repeated documents count again, so recall can exceed 1.  A query without
    hits scores 0.
    """
    truth = qrels.select("query_id", "doc_id").distinct()
    if dedup:
        hits = first_occurrences(hits, ["query_id", "doc_id"])
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")))
    top = hits.filter(F.col("rank") <= k)
    found = top.join(truth, ["query_id", "doc_id"]).groupBy("query_id").agg(F.count("*").alias("hits"), F.min("rank").alias("first"))
    shown = top.groupBy("query_id").agg(F.count("*").alias("shown"))
    sized = truth.groupBy("query_id").agg(F.count("*").alias("relevant"))
    n = F.coalesce("hits", F.lit(0))
    rows = sized.join(found, "query_id", "left").join(shown, "query_id", "left")
    return rows.select(
        "query_id",
        F.when(F.coalesce("shown", F.lit(0)) > 0, n / F.least(F.col("shown"), F.lit(k))).otherwise(0.0).alias("precision"),
        (n / F.col("relevant")).alias("recall"),
        (n > 0).cast("int").alias("hit"),
        F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("mrr"),
        (n / F.least(F.col("relevant"), F.lit(k))).alias("normalised_precision"),
        n.cast("long").alias("n_relevant"),
    )


def means(metrics: DataFrame) -> DataFrame:
    """One row of means, half-even to 4 digits (2 for the count), and the number of queries."""
    four = [F.bround(F.avg(c), 4).alias(f"mean_{c}") for c in ("precision", "recall", "hit", "mrr", "normalised_precision")]
    return metrics.agg(*four, F.bround(F.avg("n_relevant"), 2).alias("mean_n_relevant"), F.count("*").alias("n_queries"))


def relevance_buckets(qrels: DataFrame) -> DataFrame:
    """Queries by the number of their relevant documents: 3-5, 6-10, 11-50, >50."""
    n = qrels.groupBy("query_id").agg(F.count_distinct("doc_id").alias("n"))
    bucket = F.when(F.col("n") <= 5, "3-5").when(F.col("n") <= 10, "6-10").when(F.col("n") <= 50, "11-50").otherwise(">50")
    return n.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n_queries"))


def score_stats(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count("score").alias("n"), F.max("score").alias("max_score"), F.min("score").alias("min_score"), F.round(F.avg("score"), 6).alias("mean_score"))


def score_histogram(hits: DataFrame, bins: int = 20) -> DataFrame:
    """(bin, n) over equal widths between least and largest score; the largest falls into the last bin."""
    ends = hits.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(width > 0, F.least(F.floor((F.col("score") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    return hits.crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def run_rows(logs: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Metric rows of evaluation logs(path, metrics map): run name and method from the path, missing metrics 0.

    order keeps only these runs and numbers them by their place in it.
    """
    name = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    method = F.when(F.contains(F.lower("path"), F.lit("bm25")), "bm25").when(F.contains(F.lower("path"), F.lit("hybrid")), "hybrid").otherwise("faiss")
    names = ("normalised_precision", "recall", "hit", "mrr")
    place = F.array_position(F.array(*map(F.lit, order)), F.col("run_name")) if order else F.lit(0).cast("long")
    rows = logs.select(name.alias("run_name"), method.alias("method"), *[F.coalesce(F.try_element_at("metrics", F.lit(n)), F.lit(0.0)).alias(n) for n in names]).withColumn("place", place)
    return rows.filter("place > 0") if order else rows
