"""Exact vector retrieval by inner product."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.functions.vectors import inner_product, normalised
from thicket.operators.sparse import ranked
from thicket.session import stored

#: Query vectors that are broadcast at a time.
SENT_QUERIES = 20_000


def _search(sent: Broadcast, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = sent.value
        for batch in batches:
            vectors = batch.column(1)
            if not batch.num_rows:
                continue
            rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(ids), 512):
                scores = np.round(matrix[lo : lo + 512] @ rows.T, 6)
                # Of a batch only what can be among a query's k best goes on; ties are all kept.
                bound = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k] if 0 < k < batch.num_rows else np.full((len(scores), 1), -np.inf)
                q, d = np.nonzero(scores >= bound)
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo : lo + 512][q]), pa.array(docs[d]), pa.array(scores[q, d])], ["query_id", "doc_id", "score"])

    return run


def _inside(sent: Broadcast, k: int) -> Callable:
    """The scores of chunks for the queries that want their document; of a task only what can be among a query's k best goes on, ties included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, wanted, query = sent.value  # query[i] wants document wanted[i], by document
        reached = np.full(len(ids), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            chunk, parent = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            order = np.argsort(parent, kind="stable")
            owners, starts = np.unique(parent[order], return_index=True)
            lo, hi = np.searchsorted(wanted, owners), np.searchsorted(wanted, owners, side="right")
            for i in np.flatnonzero(hi > lo):
                at = order[starts[i] : starts[i + 1] if i + 1 < len(starts) else None]
                for a in range(lo[i], hi[i], 512):
                    q = query[a : min(a + 512, hi[i])]
                    scores = np.round(matrix[q] @ rows[at].T, 6)
                    if 0 < k <= len(at):
                        reached[q] = np.maximum(reached[q], -np.partition(-scores, k - 1, axis=1)[:, k - 1])
                    x, y = np.nonzero(scores >= reached[q][:, None])
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[q[x]]), pa.array(np.full(len(x), owners[i])), pa.array(chunk[at[y]]), pa.array(scores[x, y])], ["query_id", "parent", "doc_id", "score"])

    return run


def _sent_blocks(asked: DataFrame) -> Iterator[pa.Table]:
    """The rows of asked(query_id, ...) by up to about SENT_QUERIES; more are written once and dealt by hash."""
    first = asked.limit(SENT_QUERIES + 1).toArrow()
    if len(first) <= SENT_QUERIES:
        yield first
        return
    asked = stored(asked, "queries")
    n = -(-2 * asked.count() // SENT_QUERIES)  # half full, so that no block is much over
    for i in range(n):
        block = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i).toArrow()
        if len(block):
            yield block


def inside_scores(wanted: DataFrame, chunks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, parent, doc_id, score): the chunks(doc_id, parent, vector) of the documents wanted(query_id, parent), without what is in no query's k best.

    Queries and what they want are broadcast as by all_scores, so chunks stay
    where they are however many a document has; rows with a null are left out.
    """
    spark = chunks.sparkSession
    rows = chunks.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("parent").cast("long").alias("parent"), "vector").dropna()
    lists = wanted.groupBy("query_id").agg(F.collect_list(F.col("parent").cast("long")).alias("parents"))
    asked = stored(queries.select(F.col("query_id").cast("long").alias("query_id"), "vector").dropna().join(lists, "query_id"), "wanted")

    def part(block: pa.Table) -> DataFrame:
        parents = block["parents"].combine_chunks()
        document = parents.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        query = np.repeat(np.arange(len(block)), pc.list_value_length(parents).to_numpy(zero_copy_only=False))
        order = np.argsort(document, kind="stable")
        sent = spark.sparkContext.broadcast((block["query_id"].to_numpy(), np.array(block["vector"].to_pylist(), np.float64), document[order], query[order]))
        return rows.mapInArrow(_inside(sent, k), "query_id long, parent long, doc_id long, score double")

    return reduce(DataFrame.unionByName, (part(block) for block in _sent_blocks(asked)))


def all_scores(vectors: DataFrame, queries: DataFrame, k: int = 0) -> DataFrame:
    """(query_id, doc_id, score) of vectors(doc_id, vector) for queries(query_id, vector); k > 0 leaves out what is in no query's k best.

    Query vectors are broadcast, and each batch of vectors is one product with
    them.  More than SENT_QUERIES are written once, dealt into blocks by hash,
    and broadcast a block at a time, with a product and a scan for each; the
    products outweigh the scans.  Rows with a null are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("doc_id").cast("long").alias("doc_id"), "vector").dropna()
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), "vector").dropna()

    def part(block: pa.Table) -> DataFrame:
        sent = spark.sparkContext.broadcast((block["query_id"].to_numpy(), np.array(block["vector"].to_pylist(), np.float64)))
        return rows.mapInArrow(_search(sent, k), "query_id long, doc_id long, score double")

    return reduce(DataFrame.unionByName, (part(block) for block in _sent_blocks(asked)))


def pair_scores(vectors: DataFrame, queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of the given pairs(query_id, doc_id) only."""
    joined = pairs.join(vectors.select("doc_id", "vector"), "doc_id").join(queries.select("query_id", F.col("vector").alias("_q")), "query_id")
    return joined.select("query_id", "doc_id", F.round(inner_product(F.col("vector"), F.col("_q")), 6).alias("score"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, doc_id, score): the k vectors of largest inner product, all if there are fewer."""
    return ranked(all_scores(vectors, queries, k), k).select("query_id", "rank", "doc_id", "score")


def mean_vectors(chunks: DataFrame, group: str, vector: str = "vector") -> DataFrame:
    """(group, vector): element-wise mean of each group's vectors, scaled to length 1.

    Tasks sum the vectors that they hold, so what is shuffled are a few sums a
    group, however large it is.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            if not batch.num_rows:
                continue
            matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            groups, at = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            total = np.zeros((len(groups), matrix.shape[1]))
            np.add.at(total, at, matrix)
            yield pa.RecordBatch.from_arrays([pa.array(groups.astype(np.int64)), pa.array(total.tolist(), pa.list_(pa.float64())), pa.array(np.bincount(at).astype(np.int64))], ["_g", "_v", "_n"])

    kind = chunks.schema[group].dataType.simpleString()
    partial = chunks.select(F.col(group).cast("long").alias("_g"), vector).dropna().mapInArrow(sums, "_g long, _v array<double>, _n long")
    means = partial.select("_g", "_n", F.posexplode("_v").alias("_at", "_x")).groupBy("_g", "_at").agg((F.sum("_x") / F.sum("_n")).alias("_x"))
    listed = means.groupBy("_g").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_x"))), lambda s: s["_x"]).alias("_v"))
    return listed.select(F.col("_g").cast(kind).alias(group), normalised(F.col("_v")).alias("vector"))


def hierarchical(documents: DataFrame, chunks: DataFrame, queries: DataFrame, n_docs: int = 10, k: int = 10, overfetch: int = 0) -> DataFrame:
    """Two stages: the n_docs best documents of a query, then its k best chunks among theirs.

    chunks is (chunk_id, doc_id, vector).  overfetch 0 scores the chunks of
    these documents only; overfetch f takes the first k * documents * f of all
    chunks and filters those, so it can return fewer than k.
    """
    stage1 = top_k(documents, queries, n_docs).select("query_id", F.col("doc_id").alias("parent"))
    owner = chunks.select(F.col("chunk_id").alias("doc_id"), F.col("doc_id").alias("parent"))
    if overfetch:
        pool = stage1.groupBy("query_id").agg((F.count("*") * k * overfetch).alias("pool"))
        flat = chunks.select(F.col("chunk_id").alias("doc_id"), "vector")
        hits = top_k(flat, queries, k * n_docs * overfetch).join(pool, "query_id").filter("rank <= pool").drop("rank", "pool")
        inside = hits.join(owner, "doc_id").join(stage1, ["query_id", "parent"], "left_semi")
    else:
        inside = inside_scores(stage1, chunks.select(F.col("chunk_id").alias("doc_id"), F.col("doc_id").alias("parent"), "vector"), queries, k)
    return ranked(inside, k).select("query_id", "rank", F.col("doc_id").alias("chunk_id"), F.col("parent").alias("doc_id"), "score")


def save_index(chunks: DataFrame, documents: DataFrame | None, path: str, seen: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """chunks(chunk_id, doc_id, text, vector) by range of document, and documents(doc_id, text, vector), as Parquet.

    Without documents the index has one stage.  seen is applied to the chunks
    as they are written: ranges are found by reading chunks once before.
    """
    seen(chunks.repartitionByRange("doc_id").sortWithinPartitions("doc_id")).write.mode("overwrite").parquet(f"{path}/chunks")
    if documents is not None:
        documents.write.mode("overwrite").parquet(f"{path}/documents")


def load_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of a saved index of one or two stages; a missing one raises."""
    return spark.read.parquet(f"{path}/chunks")


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(chunks, documents) of a saved index; a missing one raises."""
    return spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/documents")


def index_statistics(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """One row: n_documents, n_chunks, n_texts (chunks with text), dimension."""
    a = chunks.agg(F.count("*").alias("n_chunks"), F.count(F.nullif("text", F.lit(""))).alias("n_texts"), F.max(F.size("vector")).alias("dimension"))
    return a.join(documents.agg(F.count("*").alias("n_documents"))).select("n_documents", "n_chunks", "n_texts", "dimension")


def look_up(table: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of an index table for the given ids(key): texts, metadata and vectors by id."""
    return table.join(ids.select(key).distinct(), key, "left_semi")


def hashed_embedder(dimension: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A deterministic stand-in for an embedding model: signed feature hashing of words, length 1."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension), np.float32)
        for i, text in enumerate(texts):
            for w in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % dimension] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    return embed


def embed_texts(df: DataFrame, key: str, text: str, make_model: Callable[[], Callable[[list[str]], np.ndarray]] = hashed_embedder, batch: int = 64) -> DataFrame:
    """(key, vector): texts through a model that each task makes once; batches of 64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for b in batches:
            texts = b.column(1).fill_null("").to_pylist()
            made = [v for i in range(0, len(texts), batch) for v in model(texts[i : i + batch])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.tolist() for v in made], pa.list_(pa.float32()))], [key, "vector"])

    return df.select(key, text).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, vector array<float>")
