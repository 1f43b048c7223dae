"""BM25 retrieval: an inverted index as three tables, scored for all queries at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thicket.functions.text import words
from thicket.session import small_batches, stored

MODELS = ("okapi", "l", "plus")
#: Query terms that are sent to the tasks, a checked number; more are scored by joins.
SENT_TERMS = 1_000_000
#: Pairs of a document and a query that a task scores at a time.
MATCHES = 250_000


def token_rows(df: DataFrame, key: str, text: str, tokens=None) -> DataFrame:
    """(key, term) with repeats; tokens maps the text column to a token array, lower-cased words by default."""
    array = tokens(F.col(text)) if tokens else words(F.lower(F.col(text)))
    return df.select(key, F.explode(array).alias("term"))


@dataclass
class Index:
    """postings(doc_id, term, tf, dl), terms(term, df) and one row of stats(n_docs, avgdl, n_terms, sum_idf).

    Every document counts in stats, also one without a token.
    """

    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    docs: DataFrame
    occurrences: DataFrame | None = None
    tokens: DataFrame | None = None

    def of_terms(self, terms: DataFrame) -> DataFrame:
        """Postings of the given terms; of an index that is not stored only these terms' words are counted."""
        if self.occurrences is None:
            return self.postings.join(terms, "term", "left_semi")
        return self.occurrences.join(terms, "term", "left_semi").groupBy("doc_id", "dl", "term").agg(F.count("*").alias("tf"))

    def save(self, path: str, settings: dict | None = None) -> None:
        """Parquet tables; postings are clustered by term, so a query reads few files' row groups.  settings and the documents' words are kept beside them."""
        spark = self.terms.sparkSession
        spark.createDataFrame([(k, str(v)) for k, v in sorted((settings or {}).items())], "name string, value string").write.mode("overwrite").parquet(f"{path}/settings")
        self.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
        for name in ("terms", "stats", "docs", *(("tokens",) if self.tokens is not None else ())):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Index:
        try:
            tokens = spark.read.parquet(f"{path}/tokens")
        except AnalysisException:  # of an index that has postings only
            tokens = None
        return Index(*(spark.read.parquet(f"{path}/{name}") for name in ("postings", "terms", "stats", "docs")), tokens=tokens)

    @staticmethod
    def settings(spark: SparkSession, path: str) -> dict[str, str]:
        """What save() was given; empty for an index without settings."""
        return {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/settings").collect()}  # one row a setting


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", tokens=None, keep: bool = False) -> Index:
    """The index of docs, whose ids are distinct; every step is one partially aggregated shuffle.

    keep writes terms and stats to the shared folder, for an index that is asked more than once.
    """
    named = docs.withColumnRenamed(key, "doc_id") if key != "doc_id" else docs
    array = tokens(F.col(text)) if tokens else words(F.lower(F.col(text)))
    sized = named.select("doc_id", array.alias("_tokens")).select("doc_id", "_tokens", F.size("_tokens").alias("dl"))
    occurrences = sized.select("doc_id", "dl", F.explode("_tokens").alias("term"))
    postings = occurrences.groupBy("doc_id", "dl", "term").agg(F.count("*").alias("tf"))
    # A document's distinct words are found in its row, so only (term, count) is shuffled.
    terms = sized.select(F.explode(F.array_distinct("_tokens")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    terms = stored(terms, "terms") if keep else terms
    lengths = sized.select("doc_id", "dl")
    totals = lengths.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
    raw = F.log(F.col("n_docs") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    stats = totals.join(terms.crossJoin(F.broadcast(totals.select("n_docs"))).agg(F.count("*").alias("n_terms"), F.sum(raw).alias("sum_idf")))
    stats = stored(stats, "stats") if keep else stats
    return Index(postings, terms, stats, lengths, occurrences, sized.select("doc_id", "_tokens"))


def idf(model: str, epsilon: float = 0.25) -> Column:
    n, df = F.col("n_docs"), F.col("df")
    if model == "l":
        return F.log(n + 1.0) - F.log(df + 0.5)
    if model == "plus":
        return F.log(n + 1.0) - F.log(df.cast("double"))
    raw = F.log(n - df + 0.5) - F.log(df + 0.5)
    return F.when(raw < 0, epsilon * F.col("sum_idf") / F.col("n_terms")).otherwise(raw)


def scores(index: Index, queries: DataFrame, model: str = "okapi", k1: float = 1.5, b: float = 0.75, delta: float | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, score) of every document with a query term, or of pairs(query_id, doc_id) only; queries is (query_id, term) with repeats.

    Repeated query terms add.  For the L and Plus models, which credit absent
    terms too, the score holds the query's base; base_scores() has the rest.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; one of {MODELS}")
    wanted = queries.groupBy("query_id", "term").agg(F.count("*").alias("times"))
    weighted = wanted.join(index.terms, "term").crossJoin(F.broadcast(index.stats)).select("query_id", "term", "times", idf(model).alias("idf"), "avgdl")
    postings = index.of_terms(wanted.select("term").distinct())
    hits = postings.join(weighted, "term") if pairs is None else postings.join(pairs.select("query_id", "doc_id").distinct().join(weighted, "query_id"), ["doc_id", "term"])
    part, base = _parts(model, k1, b, delta)
    matched = hits.select("query_id", "doc_id", (F.col("times") * F.col("idf") * (part - base)).alias("s")).groupBy("query_id", "doc_id").agg(F.sum("s").alias("s"))
    if model == "okapi":
        return matched.select("query_id", "doc_id", F.round("s", 6).alias("score"))
    return matched.join(base_scores(index, queries, model, k1, b, delta), "query_id", "left").select("query_id", "doc_id", F.round(F.col("s") + F.coalesce("base", F.lit(0.0)), 6).alias("score"))


def _parts(model: str, k1: float, b: float, delta: float | None) -> tuple[Column, Column]:
    """(factor of a matching term, factor of an absent one)."""
    tf, norm = F.col("tf"), 1 - b + b * F.col("dl") / F.col("avgdl")
    if model == "okapi":
        return tf * (k1 + 1) / (tf + k1 * norm), F.lit(0.0)
    if model == "l":
        d = 0.5 if delta is None else delta
        c = tf / norm
        return (k1 + 1) * (c + d) / (k1 + c + d), F.lit((k1 + 1) * d / (k1 + d))
    d = 1.0 if delta is None else delta
    return d + tf * (k1 + 1) / (k1 * norm + tf), F.lit(d)


def base_scores(index: Index, queries: DataFrame, model: str, k1: float = 1.5, b: float = 0.75, delta: float | None = None) -> DataFrame:
    """(query_id, base): the score of a document that has none of the query's terms."""
    if model == "okapi":
        return queries.select("query_id").distinct().withColumn("base", F.lit(0.0))
    d = (0.5 if model == "l" else 1.0) if delta is None else delta
    absent = (k1 + 1) * d / (k1 + d) if model == "l" else d
    wanted = queries.groupBy("query_id", "term").agg(F.count("*").alias("times")).join(index.terms, "term").crossJoin(F.broadcast(index.stats))
    return wanted.groupBy("query_id").agg(F.sum(F.col("times") * idf(model) * absent).alias("base"))


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query, rank from 1; equal scores by ascending doc_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(index: Index, queries: DataFrame, k: int = 10, model: str = "okapi", **parameters) -> DataFrame:
    """(query_id, rank, doc_id, score): k documents for each query, those without a query term last.

    A query without a token has no row.  Up to SENT_TERMS query terms are
    broadcast, and each task keeps the k best of the documents that match a
    query; beyond that, and for an index without its documents' words, scores
    come from joins.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; one of {MODELS}")
    if index.tokens is not None:
        wanted = queries.groupBy("query_id", "term").agg(F.count("*").alias("times"))
        weighted = wanted.join(index.terms, "term", "left").crossJoin(F.broadcast(index.stats)).select("query_id", "term", F.coalesce(F.col("times") * idf(model), F.lit(0.0)).alias("weight"), "avgdl")
        sent = weighted.limit(SENT_TERMS + 1).toArrow()
        if len(sent) <= SENT_TERMS:
            least = [r.doc_id for r in index.docs.select(F.col("doc_id").cast("long").alias("doc_id")).orderBy("doc_id").limit(2 * k).collect()]
            matched, base = _sent_scores(index.tokens, sent, k, model, least, **parameters)
            return filled(matched, base, index.docs.sparkSession.createDataFrame([(i,) for i in least], "doc_id long"), queries, k, few=True)
    return filled(scores(index, queries, model, **parameters), base_scores(index, queries, model, **parameters), index.docs, queries, k)


def filled(matched: DataFrame, base: DataFrame, docs: DataFrame, queries: DataFrame, k: int, few: bool = False) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best of matched(query_id, doc_id, score), then documents that do not match, which score the query's base.

    Where few rows match, they are shuffled whole and made once, not twice.
    """
    least = docs.select("doc_id").orderBy("doc_id").limit(2 * k)
    asked = base.select("query_id", F.round("base", 6).alias("score"))
    every = queries.select("query_id").distinct().join(asked, "query_id", "left").select("query_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    if few:
        either = matched.select("query_id", "doc_id", "score", F.lit(False).alias("_fill")).unionByName(every.crossJoin(F.broadcast(least)).select("query_id", "doc_id", "score", F.lit(True).alias("_fill")))
        return ranked(either.groupBy("query_id", "doc_id").agg(F.min_by("score", "_fill").alias("score")), k).select("query_id", "rank", "doc_id", "score")
    best = ranked(matched, k).drop("rank")
    near = matched.join(F.broadcast(least), "doc_id").select("query_id", "doc_id")
    # The fill takes the least 2k doc_ids into account: k of them at most are matched already.
    fill = every.crossJoin(F.broadcast(least)).join(near, ["query_id", "doc_id"], "left_anti").select("query_id", "doc_id", "score")
    return ranked(best.unionByName(fill), k).select("query_id", "rank", "doc_id", "score")


def _best(query: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int, always: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query (equal scores by ascending document) and the rows of the documents in always."""
    order = np.lexsort((doc, -score, query))
    query, doc, score = query[order], doc[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    keep = (place < k) | np.isin(doc, always)
    return query[keep], doc[keep], score[keep]


def _sent_scores(tokens: DataFrame, sent: pa.Table, k: int, model: str, always: list[int], k1: float = 1.5, b: float = 0.75, delta: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(matched: query_id, doc_id, score; base: query_id, base) for terms(query_id, term, weight, avgdl).

    Of the documents that match a query each task gives the k best, and those
    in always.  A task holds the matches of MATCHES (document, query) pairs or
    of one document, whichever is more, and of what it keeps.
    """
    d = (0.5 if model == "l" else 1.0) if delta is None else delta
    absent = {"okapi": 0.0, "l": (k1 + 1) * d / (k1 + d), "plus": d}[model]
    asked = np.array(sorted(set(sent["query_id"].to_pylist())), np.int64)
    vocabulary = pc.unique(sent["term"])
    term = pc.index_in(sent["term"], vocabulary).to_numpy()
    query = np.searchsorted(asked, sent["query_id"].to_numpy())
    weight = sent["weight"].to_numpy()
    average = sent["avgdl"][0].as_py() if len(sent) else 1.0
    base = np.bincount(query, weight, minlength=len(asked)) * absent
    known = weight != 0  # terms that no document has
    order = np.flatnonzero(known)[np.argsort(term[known], kind="stable")]
    starts = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
    spark = tokens.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((vocabulary, starts, query[order], weight[order], base))
    keep = np.array(always, np.int64)

    def part(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
        if model == "okapi":
            return tf * (k1 + 1) / (tf + k1 * norm)
        if model == "l":
            return (k1 + 1) * (tf / norm + d) / (k1 + tf / norm + d)
        return d + tf * (k1 + 1) / (k1 * norm + tf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, starts, query, weight, base = shared.value
        many = starts[1:] - starts[:-1]
        held: list[tuple] = []
        waiting = 0
        reached = np.full(len(base), -np.inf)  # the k-th best score of each query so far
        for batch in batches:
            words = batch.column("_tokens")
            length = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            at = pc.index_in(words.flatten(), vocabulary)
            found = at.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), length)[found]
            if not len(row):
                continue
            pair, tf = np.unique(row * len(vocabulary) + at.drop_null().to_numpy(), return_counts=True)
            row, word = np.divmod(pair, len(vocabulary))
            gain = part(tf.astype(np.float64), 1 - b + b * length[row] / average) - absent
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            total = np.cumsum(many[word])
            lo = 0
            while lo < len(row):  # whole documents, of which the words meet MATCHES queries in all
                end = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + MATCHES, side="right"))
                hi = max(int(np.searchsorted(row, row[min(end, len(row) - 1)])), int(np.searchsorted(row, row[lo], side="right"))) if end < len(row) else len(row)
                n = many[word[lo:hi]]
                each = np.repeat(np.arange(lo, hi), n)
                entry = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[word[lo:hi]], n)
                key, back = np.unique(query[entry] * batch.num_rows + row[each], return_inverse=True)
                asked_, doc = np.divmod(key, batch.num_rows)
                scores = np.round(base[asked_] + np.bincount(back, weight[entry] * gain[each], minlength=len(key)), 6)
                doc = ids[doc]
                can = np.flatnonzero((scores >= reached[asked_]) | np.isin(doc, keep))
                held.append(_best(asked_[can], doc[can], scores[can], k, keep))
                found_, _, scores = held[-1]
                nth = np.searchsorted(found_, np.arange(len(base))) + k - 1
                full = np.flatnonzero((k > 0) & (nth < len(found_)))
                full = full[found_[nth[full]] == full]
                reached[full] = np.maximum(reached[full], scores[nth[full]])
                waiting += len(found_)
                if waiting > max(MATCHES, 2 * len(held[0][0])):
                    held = [_best(*(np.concatenate(x) for x in zip(*held)), k, keep)]
                    waiting = len(held[0][0])
                lo = hi
        if held:
            asked_, doc, scores = _best(*(np.concatenate(x) for x in zip(*held)), k, keep)
            for lo in range(0, len(doc), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(asked[asked_[lo : lo + 10_000]]), pa.array(doc[lo : lo + 10_000].astype(np.int64)), pa.array(scores[lo : lo + 10_000])], ["query_id", "doc_id", "score"])

    matched = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "_tokens").mapInArrow(run, "query_id long, doc_id long, score double")
    return matched, spark.createDataFrame(list(zip(asked.tolist(), base.tolist())), "query_id long, base double")


def pair_scores(index: Index, queries: DataFrame, pairs: DataFrame, model: str = "okapi", **parameters) -> DataFrame:
    """(query_id, doc_id, score) of the given pairs(query_id, doc_id) only; pairs without a common term score their base."""
    # Pairs whose query has no term need no postings.
    asked = pairs.join(queries.select("query_id").distinct(), "query_id", "left_semi")
    few = Index(index.postings.join(asked.select("doc_id").distinct(), "doc_id", "left_semi"), index.terms, index.stats, index.docs)
    found = scores(few, queries, model, pairs=pairs, **parameters)
    base = base_scores(index, queries, model, **parameters).select("query_id", F.round("base", 6).alias("_base"))
    return pairs.join(found, ["query_id", "doc_id"], "left").join(base, "query_id", "left").select("query_id", "doc_id", F.coalesce("score", "_base", F.lit(0.0)).alias("score"))


def above(hits: DataFrame, threshold: float = 8.0) -> DataFrame:
    """Hits at or over the threshold."""
    return hits.filter(F.col("score") >= threshold)
