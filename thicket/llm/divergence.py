"""Audit of sources: how far the term shares of each source lie from its language's and from the other sources'.

Shards are hash partitions by language and term.  Tasks count the terms of
their texts with DuckDB and send one row for each (language, source, term);
each shard adds its rows up, keeps the terms of at least ``LEAST`` documents
and, once the totals of all groups are known, computes its part of every sum
over terms in vectorised SQL.  Spark merges the shards' sums and ranks them.

A sum over all kept terms of a pair of sources needs no row for a term that
neither has, and one row for terms of equal counts: with z the share of a term
that does not occur and m the number of terms with shares (p, q),

    sum f = sum over both  m (f(p, q) - f(p, z) - f(z, q) + f(z, z))
          + sum over first m (f(p, z) - f(z, z)) + sum over second m (f(z, q) - f(z, z)) + terms f(z, z)

All of it is integer arithmetic: shares are at most 1e9 + 1, their squared
distance fits 64 bits, products with counts are taken with 128.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thicket.llm import tokens
from thicket.llm.runtime import bounded_batches, lean, materialise

#: Documents that a kept term is in at least, ranks of terms given back, scale of shares.
LEAST, RANKS, SCALE = 3, 200, 1_000_000_000
#: Bytes of text behind a shard, rows that a task counts before it sends them, pairs of sources that a shard sums at a time.
SHARD_BYTES, HELD_ROWS, PAIRS = 32 << 20, 2_000_000, 250_000
#: Letters: A-Z folded to lower case, a-z and every byte of another script as they are; all else parts terms.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[97:123], LETTERS[65:91], LETTERS[128:] = np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)

_COUNTED = "lang string, source string, term string, n long, docs long"
_KEPT = "lang string, source string, term string, n long, head int"
_PARTS = "lang string, source string, part string, item string, value long"
_SPLIT = "SELECT d, lang, source, term, count(*) AS k FROM (SELECT d, lang, source, unnest(string_split(text, ' ')) AS term FROM texts) WHERE term <> '' GROUP BY ALL"
_SUMMED = "SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs)::BIGINT AS docs FROM counts GROUP BY ALL"


def _connect():
    """One thread a task; nothing is spilt to the machine's own folders."""
    import duckdb

    return duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "temp_directory": "", "preserve_insertion_order": False})


def _batches(con, sql: str) -> Iterator[pa.RecordBatch]:
    for batch in con.sql(sql).to_arrow_reader(50_000):
        if batch.num_rows:
            yield batch


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a task's texts."""
    con = _connect()
    con.execute("CREATE TABLE counts (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, docs BIGINT)")
    con.execute("CREATE TABLE pieces (d BIGINT, lang VARCHAR, source VARCHAR, term VARCHAR, k BIGINT)")
    for batch in batches:
        lang, source = batch.column(0), batch.column(1)
        for lo, hi, data, firsts, _ in tokens.text_runs(batch.column(2), tokens.PIECE):
            long = hi - lo == 1 and len(data) > 2 * tokens.PIECE
            for piece in tokens.cut(data, tokens.PIECE) if long else [data]:
                offsets = np.array([0, len(piece)], np.int32) if long else np.append(firsts, len(piece)).astype(np.int32)
                folded = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(offsets), pa.py_buffer(LETTERS[piece]))
                texts = pa.table({"d": np.arange(lo, hi), "lang": lang.slice(lo, hi - lo), "source": source.slice(lo, hi - lo), "text": folded})
                con.register("texts", texts)
                con.execute(f"INSERT INTO pieces {_SPLIT}" if long else f"INSERT INTO counts SELECT lang, source, term, sum(k), count(*) FROM ({_SPLIT}) GROUP BY ALL")
                con.unregister("texts")
            if long:  # one document in pieces
                con.execute("INSERT INTO counts SELECT lang, source, term, sum(k), 1 FROM pieces GROUP BY ALL; DELETE FROM pieces")
        if con.execute("SELECT count(*) FROM counts").fetchall()[0][0] >= HELD_ROWS:
            yield from _batches(con, _SUMMED)
            con.execute("TRUNCATE counts")
    yield from _batches(con, _SUMMED)
    con.close()


def _keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's terms of at least LEAST documents of their language; head marks one row of each term."""
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    con = _connect()

    def rows() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    con.register("counts", pa.RecordBatchReader.from_batches(first.schema, rows()))
    con.execute(f"CREATE TABLE summed AS {_SUMMED}")
    con.unregister("counts")
    term = "OVER (PARTITION BY lang, term)"
    yield from _batches(con, f"SELECT lang, source, term, n, (source = min(source) {term})::INT AS head FROM summed QUALIFY sum(docs) {term} >= {LEAST}")
    con.close()


_SHARES = f"""
CREATE MACRO share(n, total, v) AS (1 + {SCALE}::HUGEINT * (n + 1) // (total + v))::BIGINT;
CREATE MACRO far(p, q) AS (p - q) * (p - q) // q;
CREATE TABLE g AS SELECT lang, source, total, v, CASE WHEN v > 0 THEN share(0, total, v) END AS z, sum(total) OVER (PARTITION BY lang) AS every, row_number() OVER (PARTITION BY lang ORDER BY source) AS place FROM groups;
CREATE TABLE c AS SELECT lang, source, term, share(n, total, v) AS p, share(sum(n) OVER (PARTITION BY lang, term), every, v) AS q FROM counts JOIN g USING (lang, source);
CREATE TABLE own AS SELECT lang, source, p, count(*) AS m FROM c GROUP BY ALL;
CREATE TABLE terms AS SELECT lang, count(DISTINCT term) AS m FROM c GROUP BY ALL;
"""
_TERMS = f"SELECT lang, source, 'term' AS part, term AS item, far(p, q)::BIGINT AS value FROM c WHERE p > q QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY far(p, q) DESC, term) <= {RANKS}"
#: For the sources of place lo to hi: the four parts of the sum, by pairs.
_PAIRS = """
WITH a AS (SELECT * FROM g WHERE place BETWEEN {lo} AND {hi}),
pair AS (SELECT a.lang, a.source, b.source AS item, a.z, b.z AS y FROM a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source),
x AS (SELECT c.* FROM c JOIN a USING (lang, source)),
shared AS (SELECT x.lang, x.source, c.source AS item, x.p, c.p AS q, count(*)::HUGEINT AS m FROM x JOIN c ON x.lang = c.lang AND x.term = c.term AND x.source <> c.source GROUP BY ALL)
SELECT lang, source, 'pair' AS part, item, sum(value)::BIGINT AS value FROM (
SELECT lang, source, item, m * (far(p, q) - far(p, y) - far(z, q) + far(z, y)) AS value FROM shared JOIN pair USING (lang, source, item)
UNION ALL SELECT lang, source, item, m::HUGEINT * (far(p, y) - far(z, y)) FROM pair JOIN own USING (lang, source)
UNION ALL SELECT pair.lang, pair.source, item, m::HUGEINT * (far(z, p) - far(z, y)) FROM pair JOIN own ON own.lang = pair.lang AND own.source = pair.item
UNION ALL SELECT lang, source, item, CASE WHEN m > 0 THEN m::HUGEINT * far(z, y) ELSE 0 END FROM pair LEFT JOIN terms USING (lang)) GROUP BY ALL
"""


def _parts(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """A shard's terms of the highest values, and its share of the sums of all pairs."""
    con = _connect()
    con.register("counts", counts)
    con.register("groups", groups)
    con.execute(_SHARES)
    found = [con.sql(_TERMS).to_arrow_table()]
    most = con.execute("SELECT coalesce(max(place), 0) FROM g").fetchall()[0][0]
    step = max(1, PAIRS // max(1, most))
    found += [con.sql(_PAIRS.format(lo=lo, hi=lo + step - 1)).to_arrow_table() for lo in range(1, most + 1, step)]
    con.close()
    schema = pa.schema([(name, pa.int64() if name == "value" else pa.string()) for name in ("lang", "source", "part", "item", "value")])
    return pa.concat_tables([t.select(schema.names).cast(schema) for t in found])


def _sums(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value): of every shard its best terms and its share of each pair's sum.

    Each shard gives a row for a pair, so shards follow the bytes of text alone,
    whatever the number of partitions.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(filled("lang"), filled("source"), filled("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    counted = rows.mapInArrow(lean(_count), _COUNTED)
    terms = counted.repartition(tasks, "lang", "term").mapInArrow(lean(_keep), _KEPT)
    kept = materialise(terms.withColumn("shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int")), "terms")
    groups = rows.select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.sum("head").alias("v"))
    groups = materialise(groups.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v")), "groups")
    home = groups.select("lang", F.pmod(F.hash("lang"), F.lit(shards)).cast("int").alias("shard"))
    sent = kept.select("lang", "shard").unionByName(home).distinct().join(groups, "lang").select(*(F.col(c).alias(c) for c in ("shard", "lang", "source", "total", "v")))
    return kept.select("shard", "lang", "source", "term", "n").groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(_parts, _PARTS)


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: one row for each ranked item of a group.

    Terms are runs of letters, A-Z folded; each language keeps those of at
    least LEAST of its documents.  With SCALE, a group's share of a kept term
    is p = 1 + floor(SCALE (n + 1) / (N + V)); far = floor((p - q)^2 / q).
    `pair` ranks the other sources of the language by the sum of far over all
    kept terms (0 where nothing is kept), `term` the group's own terms whose
    share exceeds the language's, the first RANKS of them.

    Null text, lang and source count as empty strings.  Every row is a
    document, repeated rows too; a group whose texts hold no term has pairs
    and no terms.  Equal values are ranked by item, in UTF-8 order.  Texts of
    any length are read whole, in pieces.  Other columns are ignored; an empty
    table gives an empty result.

    One common term has a row for each task and source at most, which its shard
    adds up as they arrive; a frequent source is spread over all shards.
    """
    merged = _sums(docs).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.expr(f"part = 'pair' OR rank <= {RANKS}"))
