"""Rank fusion, fallback and coverage over sparse and dense hits (query_id, rank, doc_id, score)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thicket.functions.vectors import inner_product
from thicket.operators.sparse import ranked


def rank_scores(hits: DataFrame, n: int, doc_rank: str = "worst") -> DataFrame:
    """(query_id, doc_id, linear): (n - rank) / n with rank from 0 and n hits asked for, however many were found.

    Where a document has several hits, 'worst' takes its last one and 'best' its first.
    """
    pick = {"worst": F.max, "best": F.min}[doc_rank]("rank")
    return hits.groupBy("query_id", "doc_id").agg(((F.lit(n) - pick + 1) / F.lit(n)).alias("linear"))


def late_fusion(sparse: DataFrame, dense: DataFrame, n_sparse: int, n_dense: int, alpha: float = 0.5, k: int = 10, doc_rank: str = "worst") -> DataFrame:
    """(query_id, rank, doc_id, score): alpha * sparse + (1 - alpha) * dense rank score, an absent one is 0."""
    a, b = rank_scores(sparse, n_sparse, doc_rank).withColumnRenamed("linear", "_s"), rank_scores(dense, n_dense, doc_rank).withColumnRenamed("linear", "_d")
    both = a.join(b, ["query_id", "doc_id"], "full_outer")
    fused = alpha * F.coalesce("_s", F.lit(0.0)) + (1 - alpha) * F.coalesce("_d", F.lit(0.0))
    return ranked(both.select("query_id", "doc_id", F.round(fused, 6).alias("score")), k).select("query_id", "rank", "doc_id", "score")


def candidates(sparse: DataFrame, dense: DataFrame) -> DataFrame:
    """(query_id, doc_id): the documents that either side found."""
    return sparse.select("query_id", "doc_id").unionByName(dense.select("query_id", "doc_id")).distinct()


def balanced_fusion(sparse_scores: DataFrame, dense_scores: DataFrame, alpha: float = 0.5, k: int = 10) -> DataFrame:
    """Fusion of candidates that are scored on both sides: each side ranks all of them, then the rank scores are mixed.

    Both tables are (query_id, doc_id, score) over the same candidates; one
    that a side cannot score comes last there.
    """
    both = sparse_scores.withColumnRenamed("score", "_s").join(dense_scores.withColumnRenamed("score", "_d"), ["query_id", "doc_id"], "full_outer")
    order = lambda c: Window.partitionBy("query_id").orderBy(F.desc_nulls_last(c), "doc_id")
    n = F.count("*").over(Window.partitionBy("query_id"))
    linear = lambda c: (n - F.row_number().over(order(c)) + 1) / n
    fused = both.select("query_id", "doc_id", F.round(alpha * linear("_s") + (1 - alpha) * linear("_d"), 6).alias("score"))
    return ranked(fused, k).select("query_id", "rank", "doc_id", "score")


def uncovered(sparse: DataFrame, dense: DataFrame) -> DataFrame:
    """Sparse hits of documents that the dense hits lack."""
    return sparse.join(dense.select("query_id", "doc_id").distinct(), ["query_id", "doc_id"], "left_anti")


def late_fallback(dense: DataFrame, sparse: DataFrame, chunks: DataFrame, queries: DataFrame, n_docs: int = 10, per_doc: int = 2) -> DataFrame:
    """Dense hits, then of the first n_docs uncovered sparse documents the per_doc best chunks, in sparse order.

    dense is (query_id, rank, chunk_id, doc_id, score), chunks (chunk_id,
    doc_id, vector), queries (query_id, vector); only chunks of the documents
    that are added are scored.  rank runs over the whole list, source tells the
    part.
    """
    extra = uncovered(sparse, dense).withColumn("_order", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).filter(F.col("_order") <= n_docs)
    mine = extra.select("query_id", "doc_id", "_order").join(chunks, "doc_id").join(queries.select("query_id", F.col("vector").alias("_q")), "query_id")
    scored = mine.withColumn("score", F.round(inner_product(F.col("vector"), F.col("_q")), 6))
    best = Window.partitionBy("query_id", "doc_id").orderBy(F.desc("score"), "chunk_id")
    scored = scored.withColumn("_in", F.row_number().over(best)).filter(F.col("_in") <= per_doc)
    first = dense.select("query_id", "chunk_id", "doc_id", "score", F.lit("dense").alias("source"), F.lit(0).alias("_part"), F.col("rank").alias("_order"), F.lit(0).alias("_in"))
    then = scored.select("query_id", "chunk_id", "doc_id", "score", F.lit("fallback").alias("source"), F.lit(1).alias("_part"), "_order", "_in")
    whole = Window.partitionBy("query_id").orderBy("_part", "_order", "_in")
    return first.unionByName(then).withColumn("rank", F.row_number().over(whole)).select("query_id", "rank", "chunk_id", "doc_id", "score", "source")


def uncovered_chunks(sparse: DataFrame, dense: DataFrame, chunks: DataFrame) -> DataFrame:
    """(query_id, doc_id, n_chunks): the chunks that each uncovered sparse document has; 0 without any."""
    owned = chunks.groupBy("doc_id").agg(F.count("*").alias("_n"))
    return uncovered(sparse, dense).join(owned, "doc_id", "left").select("query_id", "doc_id", F.coalesce("_n", F.lit(0)).alias("n_chunks"))


def coverage(sparse: DataFrame, dense: DataFrame) -> DataFrame:
    """(query_id, n_sparse, n_uncovered) of each query with sparse hits."""
    n = sparse.groupBy("query_id").agg(F.count("*").alias("n_sparse"))
    m = uncovered(sparse, dense).groupBy("query_id").agg(F.count("*").alias("_m"))
    return n.join(m, "query_id", "left").select("query_id", "n_sparse", F.coalesce("_m", F.lit(0)).alias("n_uncovered"))
