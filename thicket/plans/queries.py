"""The queries of the retrieval operators over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thicket.functions import bpe, fuzzy, language, text
from thicket.functions.stem import stem_terms, stem_tokens
from thicket.operators import context, dense, documents, fusion, metrics, mining, sparse, stopwords
from thicket.operators.keyword_store import KeywordStore
from thicket.plans import ingest
from thicket.session import scratch, stored
from thicket.sources import readers, samples, writers
from thicket.streaming import changes, feed

#: Every hundredth vector is a query; vectors of a document, one after the other.
QUERY_STEP, CHUNKS_A_DOCUMENT = 100, 4
STOPWORDS = ("the", "de", "la", "and")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyword_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, term): all words of every benchmark item."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.explode(text.words(F.lower("text"))).alias("term"))


def index(spark: SparkSession, sf_dir: str) -> sparse.Index:
    return sparse.build_index(table(spark, sf_dir, "documents"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"), F.col("label").cast("long").alias("label"))


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked(vectors(spark, sf_dir)).select("query_id", "vector")


def _asked(rows: DataFrame) -> DataFrame:
    """The vectors that are queries, numbered from 0 as the benchmark items are."""
    return rows.filter(F.col("doc_id") % QUERY_STEP == 0).withColumn("query_id", F.expr(f"doc_id div {QUERY_STEP}"))


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, doc_id): documents that hold the whole text of an item.

    A document that holds a passage has all of the words that are between
    spaces in it, so the longest of these is the join key; the passage is then
    looked for in the documents of the key.  Passages without such a word, if
    any, are looked for in every document.
    """
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("passage"))
    inner = F.split("passage", " ")
    inner = F.slice(inner, 2, F.greatest(F.size(inner) - 2, F.lit(0)))
    longest = F.array_max(F.transform(F.filter(inner, lambda w: w != ""), lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))["word"]
    items = items.withColumn("word", longest)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = docs.select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("word"))
    pairs = words.join(items.filter("word IS NOT NULL"), "word").select("query_id", "doc_id", "passage")
    keyed = docs.join(pairs, "doc_id").filter(F.contains("text", F.col("passage"))).select("query_id", "doc_id")
    rest = [(r.query_id, r.passage) for r in items.filter("word IS NULL AND passage IS NOT NULL").select("query_id", "passage").collect()]  # items of two words at most
    if not rest:
        return keyed
    each = F.explode(F.array(*[F.struct(F.lit(q).cast("long").alias("query_id"), F.lit(p).alias("passage")) for q, p in rest]))
    return keyed.unionByName(docs.withColumn("_i", each).filter(F.contains("text", F.col("_i.passage"))).select("_i.query_id", "doc_id"))


def sparse_hits(spark: SparkSession, sf_dir: str, k: int = 50) -> DataFrame:
    return sparse.top_k(index(spark, sf_dir), keyword_queries(spark, sf_dir), k)


def dense_hits(spark: SparkSession, sf_dir: str, k: int = 50) -> DataFrame:
    return dense.top_k(vectors(spark, sf_dir), vector_queries(spark, sf_dir), k)


# --- text

def text_normalize(spark, sf_dir):
    tokens = text.Normaliser(stopwords=STOPWORDS).tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(tokens).alias("pos", "term"))


def token_df_tf(spark, sf_dir):
    return stopwords.array_statistics(table(spark, sf_dir, "documents").select(text.words(F.lower("text")).alias("tokens")))


def accents_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.fold_accents(F.col("text")).alias("folded"))


def dict_translate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.translate_words(F.col("text"), F.col("lang")).alias("translated"))


def language_route(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(text.language_code(F.concat(F.lit("__label__"), F.col("lang"))).alias("language")).agg(F.count("*").alias("n"))


def language_detect(spark, sf_dir):
    """Every document's language, learned from those whose id has an even CRC-32."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1)
    model = stored(language.fit(docs.filter(~F.col("held_out"))), "language")
    return language.predict(docs, model, ("doc_id", "lang", "held_out"))


def corpus_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.corpus_words(F.col("text"))).alias("pos", "term"))


def stopwords_generated(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return stopwords.generate(sparse.token_rows(docs, "doc_id", "text"), docs.count(), ("él", "más"))


def stemmed_terms(spark, sf_dir):
    return stem_terms(sparse.token_rows(table(spark, sf_dir, "documents").filter("lang = 'es'"), "doc_id", "text")).groupBy("term").agg(F.count("*").alias("tf"))


def spanish_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.spanish_date(F.unix_millis(F.col("ts").cast("timestamp"))).alias("fecha"))


def snippets(spark, sf_dir):
    asked = keyword_queries(spark, sf_dir).groupBy("query_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    best = sparse_hits(spark, sf_dir, 3).join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").join(asked, "query_id")
    return best.select("query_id", "rank", "doc_id", text.snippet(F.col("text"), F.col("terms")).alias("snippet"))


# --- keyword retrieval

def bm25_okapi_topk(spark, sf_dir):
    return sparse_hits(spark, sf_dir, 10)


def bm25_l_topk(spark, sf_dir):
    return sparse.top_k(index(spark, sf_dir), keyword_queries(spark, sf_dir), 10, "l")


def bm25_plus_topk(spark, sf_dir):
    return sparse.top_k(index(spark, sf_dir), keyword_queries(spark, sf_dir), 10, "plus")


def changed_store(spark, sf_dir):
    """A keyword index of all documents, made by changes: some are added late, some replaced, and some that do not exist deleted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = KeywordStore(spark, scratch(spark, "keywords"))
    late, stale = F.col("doc_id") % 10 == 0, F.col("doc_id") % 10 == 1
    store.apply(docs.filter(~late).withColumn("text", F.when(stale, F.reverse("text")).otherwise(F.col("text"))).unionByName(docs.filter(stale).withColumn("doc_id", -1 - F.col("doc_id"))))
    store.apply(docs.filter(late | stale).withColumn("deleted", F.lit(False)).unionByName(docs.filter(stale).select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(True).alias("deleted"))))
    return store


def bm25_incremental_topk(spark, sf_dir):
    """Hits of an index after changes, all of its documents read."""
    return sparse.top_k(changed_store(spark, sf_dir).index(), keyword_queries(spark, sf_dir), 10)


def bm25_pruned_topk(spark, sf_dir):
    """Hits of a compacted index, found by score bounds."""
    store = changed_store(spark, sf_dir)
    store.compact()
    return store.top_k(keyword_queries(spark, sf_dir), 10)[0]


def bm25_threshold(spark, sf_dir):
    return sparse.above(sparse_hits(spark, sf_dir), 8.0)


def _normalised(spark, sf_dir, tokens):
    """Hits where documents and queries go through the same normaliser, documents once: the index reads their stored tokens."""
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.explode(tokens(F.col("text"))).alias("term"))
    docs = stored(table(spark, sf_dir, "documents").select("doc_id", tokens(F.col("text")).alias("tokens")), "tokens")
    return sparse.top_k(sparse.build_index(docs, text="tokens", tokens=lambda c: c, keep=True), asked, 10)


def bm25_normalised_topk(spark, sf_dir):
    return _normalised(spark, sf_dir, text.Normaliser(stopwords=STOPWORDS).tokens)


def bm25_stemmed_topk(spark, sf_dir):
    return _normalised(spark, sf_dir, lambda c: stem_tokens(text.Normaliser(stopwords=STOPWORDS).tokens(c)))


def bm25_stored_topk(spark, sf_dir):
    """The index is written with its settings, read again and asked."""
    path = scratch(spark, "bm25")
    index(spark, sf_dir).save(path, {"model": "plus", "k1": 1.5, "b": 0.75})
    return sparse.top_k(sparse.Index.load(spark, path), keyword_queries(spark, sf_dir), 10, sparse.Index.settings(spark, path)["model"])


# --- vectors

def dense_topk(spark, sf_dir):
    return dense_hits(spark, sf_dir, 10)


def dense_doc_topk(spark, sf_dir):
    return dense.top_k(_labels(spark, sf_dir), vector_queries(spark, sf_dir), 3)


def _labels(spark, sf_dir):
    return dense.mean_vectors(vectors(spark, sf_dir), "label").withColumnRenamed("label", "doc_id")


def _chunks(spark, sf_dir):
    return vectors(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), F.col("label").alias("doc_id"), "vector")


def _grouped_chunks(spark, sf_dir):
    """(chunk_id, doc_id, vector): four vectors, one after the other, are the chunks of a document."""
    return vectors(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), F.expr(f"doc_id div {CHUNKS_A_DOCUMENT}").alias("doc_id"), "vector")


def _grouped_documents(spark, sf_dir):
    return dense.mean_vectors(_grouped_chunks(spark, sf_dir), "doc_id")


def grouped_hits(spark, sf_dir, k=50):
    """Two-stage hits over the grouped chunks: the ten best documents, then their k best chunks."""
    return dense.hierarchical(_grouped_documents(spark, sf_dir), _grouped_chunks(spark, sf_dir), vector_queries(spark, sf_dir), 10, k)


def hierarchical_exact(spark, sf_dir):
    return dense.hierarchical(_labels(spark, sf_dir), _chunks(spark, sf_dir), vector_queries(spark, sf_dir), 3, 10)


def hierarchical_overfetch(spark, sf_dir):
    return dense.hierarchical(_labels(spark, sf_dir), _chunks(spark, sf_dir), vector_queries(spark, sf_dir), 3, 10, overfetch=3)


def group_mean_embedding(spark, sf_dir):
    return dense.mean_vectors(vectors(spark, sf_dir), "label").select("label", F.posexplode("vector").alias("pos", "x")).select("label", "pos", F.round("x", 6).alias("value"))


def _saved_vectors(spark, sf_dir):
    path = scratch(spark, "vectors")
    chunks = _grouped_chunks(spark, sf_dir).withColumn("text", F.when(F.col("chunk_id") % 3 > 0, F.concat(F.lit("chunk "), F.col("chunk_id").cast("string"))).otherwise(""))
    dense.save_index(chunks, _grouped_documents(spark, sf_dir).withColumn("text", F.concat(F.lit("document "), F.col("doc_id").cast("string"))), path)
    return dense.load_index(spark, path)


def vector_index_statistics(spark, sf_dir):
    return dense.index_statistics(*_saved_vectors(spark, sf_dir))


def vector_look_up(spark, sf_dir):
    """Chunks by id from a stored index, with the text of their document and the first number of their vector."""
    chunks, documents_ = _saved_vectors(spark, sf_dir)
    found = dense.look_up(chunks, "chunk_id", spark.range(5, 60, 7).withColumnRenamed("id", "chunk_id"))
    return found.join(documents_.select("doc_id", F.col("text").alias("document")), "doc_id").select("chunk_id", "doc_id", "text", "document", F.round(F.element_at("vector", 1).cast("double"), 6).alias("x"))


# --- fusion, context

def late_fusion_worst(spark, sf_dir):
    return fusion.late_fusion(sparse_hits(spark, sf_dir), grouped_hits(spark, sf_dir), 50, 50)


def late_fusion_best(spark, sf_dir):
    return fusion.late_fusion(sparse_hits(spark, sf_dir), grouped_hits(spark, sf_dir), 50, 50, alpha=0.2, doc_rank="best")


def late_fusion_balanced(spark, sf_dir):
    """Candidates of either side, each scored on both sides."""
    built, asked = sparse.build_index(table(spark, sf_dir, "documents"), keep=True), keyword_queries(spark, sf_dir)
    found = stored(fusion.candidates(sparse.top_k(built, asked, 50), grouped_hits(spark, sf_dir)), "candidates")
    return fusion.balanced_fusion(sparse.pair_scores(built, asked, found), dense.pair_scores(_grouped_documents(spark, sf_dir), vector_queries(spark, sf_dir), found))


def _dense_chunks(spark, sf_dir, k):
    return dense_hits(spark, sf_dir, k).withColumnRenamed("doc_id", "chunk_id").withColumn("doc_id", F.expr(f"chunk_id div {CHUNKS_A_DOCUMENT}"))


def late_fallback(spark, sf_dir):
    return fusion.late_fallback(_dense_chunks(spark, sf_dir, 20), sparse_hits(spark, sf_dir), _grouped_chunks(spark, sf_dir), vector_queries(spark, sf_dir))


def uncovered_chunks(spark, sf_dir):
    return fusion.uncovered_chunks(sparse_hits(spark, sf_dir), _dense_chunks(spark, sf_dir, 50), _grouped_chunks(spark, sf_dir))


def fallback_coverage(spark, sf_dir):
    return fusion.coverage(sparse_hits(spark, sf_dir), _dense_chunks(spark, sf_dir, 50))


def context_pack(spark, sf_dir):
    hits = sparse_hits(spark, sf_dir, 10).join(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content")), "doc_id")
    return context.pack(hits).select("query_id", "rank", "doc_id", "n_tokens", "running_tokens")


def rag_answers(spark, sf_dir):
    hits = sparse_hits(spark, sf_dir, 10).join(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content")), "doc_id")
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return context.answers(asked, context.contexts(context.pack(hits))).select("query_id", "generated_answer", F.array_join("doc_ids", ",").alias("doc_ids"), "context_length", "error")


# --- evaluation

def eval_bm25(spark, sf_dir):
    return metrics.means(metrics.per_query(sparse_hits(spark, sf_dir, 10), qrels(spark, sf_dir), 10))


def _label_hits(spark, sf_dir):
    """Hits whose document is the label, so labels repeat, and each query's own label as relevant."""
    owners = vectors(spark, sf_dir).select("doc_id", "label")
    hits = dense_hits(spark, sf_dir).join(owners, "doc_id").select("query_id", "rank", F.col("label").alias("doc_id"))
    return hits, _asked(owners).select("query_id", F.col("label").alias("doc_id"))


def eval_dense_dup(spark, sf_dir):
    return metrics.means(metrics.per_query(*_label_hits(spark, sf_dir), 10, dedup=False))


def eval_dense_dedup(spark, sf_dir):
    return metrics.means(metrics.per_query(*_label_hits(spark, sf_dir), 10, dedup=True))


def relevance_buckets(spark, sf_dir):
    return metrics.relevance_buckets(qrels(spark, sf_dir))


def score_histogram(spark, sf_dir):
    return metrics.score_histogram(sparse_hits(spark, sf_dir))


def score_stats(spark, sf_dir):
    return metrics.score_stats(sparse_hits(spark, sf_dir))


# --- mining

def _attributes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    quality = F.when(F.col("quality").isNotNull(), F.array(F.concat(F.lit("q"), F.col("quality").cast("string"))))
    toxic = F.when(F.col("toxic").isNotNull(), F.array(F.concat(F.lit("t"), F.col("toxic").cast("string"))))
    return docs.select("doc_id", F.array("lang").alias("species"), F.create_map("lang", quality).alias("indications"), F.array("source").alias("routes"), toxic.alias("categories"))


def grouping_miner(spark, sf_dir):
    return mining.mine_groupings(_attributes(spark, sf_dir))


def criteria_filter(spark, sf_dir):
    rows = [(0, "en", None, None, None), (1, "en", "q1", None, "t0"), (2, None, None, "src0", None), (3, "fr", "", "src3", "t1")]
    wanted = spark.createDataFrame(rows, "query_id int, especie string, indicacion string, via string, categoria_antibiotico string")
    return mining.matching(_attributes(spark, sf_dir), wanted).select("query_id", "doc_id")


def inverted_grouping(spark, sf_dir):
    """Documents by every class of their labels, a nested path over an array."""
    rows = _attributes(spark, sf_dir).select("doc_id", F.struct(F.transform("categories", lambda c: F.struct(c.alias("nombre"))).alias("clases")).alias("meta"))
    return mining.invert(rows, "meta.clases.nombre", "doc_id")


# --- documents

_SPECIES = "named_struct('nombre', {0}, 'nombre_normalizado', {1})"
_BRAND = _SPECIES.format("p_brand", "lower(p_brand)")
_NONE = "CAST(NULL AS STRUCT<nombre: STRING, nombre_normalizado: STRING>)"
_ITEM = "named_struct('nombre', {0}, 'especie', {1})"
_AGAINST = "named_struct('nombre', {0}, 'especie', {1}, 'es_especie', {2}, 'nombre_normalizado', CAST({3} AS STRING))"
_REACTION = "named_struct('nombre', {0}, 'especie', {1}, 'frecuencia', named_struct('nombre', CAST({2} AS STRING)))"
_WAIT = "named_struct('especie', {0}, 'tejido', named_struct('nombre', {1}), 'cantidad', {2}, 'unidadTiempo', named_struct('nombre', {3}))"
#: Metadata of catalogue records made from parts: every kind of list is empty for some and has each of its shapes for others.
_METADATA = {
    "especies": f"CASE p_partkey % 3 WHEN 0 THEN array() WHEN 1 THEN array({_BRAND}) ELSE array({_BRAND}, {_SPECIES.format(chr(39) + 'Perros' + chr(39), chr(39) + 'Perro' + chr(39))}) END",
    "principiosActivos": "CASE p_partkey % 4 WHEN 0 THEN array() WHEN 3 THEN array(named_struct('nombre', p_type, 'cantidad', '5', 'unidad', 'mg'), named_struct('nombre', p_name, 'cantidad', '', 'unidad', '')) ELSE array(named_struct('nombre', p_type, 'cantidad', '5', 'unidad', 'mg')) END",
    "viasAdministracion": "CASE p_partkey % 5 WHEN 0 THEN array() WHEN 4 THEN array(named_struct('nombre', 'oral'), named_struct('nombre', '')) ELSE array(named_struct('nombre', 'oral')) END",
    "indicaciones": f"CASE WHEN p_partkey % 6 = 0 THEN array() WHEN p_partkey % 2 = 1 THEN array({_ITEM.format('p_type', _BRAND)}, {_ITEM.format('p_name', _BRAND)}) ELSE array({_ITEM.format('p_type', _BRAND)}, {_ITEM.format('p_name', _NONE)}, {_ITEM.format(chr(39) + 'otra' + chr(39), _BRAND)}) END",
    "contraindicaciones": f"CASE p_partkey % 4 WHEN 0 THEN array() WHEN 1 THEN array({_AGAINST.format('p_name', _NONE, 'false', 'NULL')}) WHEN 2 THEN array({_AGAINST.format('p_type', _BRAND, 'false', 'NULL')}, {_AGAINST.format('p_name', _NONE, 'false', 'NULL')}) ELSE array({_AGAINST.format(chr(39) + 'Gatos' + chr(39), _NONE, 'true', chr(39) + 'Gato' + chr(39))}, {_AGAINST.format('p_name', _BRAND, 'false', 'NULL')}) END",
    "reaccionesAdversas": f"CASE p_partkey % 3 WHEN 0 THEN array() WHEN 1 THEN array({_REACTION.format('p_type', _NONE, chr(39) + 'Rara' + chr(39))}) ELSE array({_REACTION.format('p_name', _BRAND, 'NULL')}, {_REACTION.format('p_type', _NONE, 'NULL')}) END",
    "interacciones": f"CASE p_partkey % 3 WHEN 0 THEN array({_ITEM.format('p_name', _NONE)}) WHEN 1 THEN array({_ITEM.format('p_type', _BRAND)}, {_ITEM.format(chr(39) + 'x' + chr(39), _BRAND)}) ELSE array() END",
    "tiemposEspera": f"CASE p_partkey % 3 WHEN 1 THEN array({_WAIT.format(_BRAND, chr(39) + 'Carne' + chr(39), chr(39) + '5' + chr(39), chr(39) + 'días' + chr(39))}, {_WAIT.format(_SPECIES.format(chr(39) + 'Vacas' + chr(39), chr(39) + 'vaca' + chr(39)), chr(39) + 'Leche' + chr(39), chr(39) + '2' + chr(39), chr(39) + 'horas' + chr(39))}) ELSE array() END",
    "tiempoEsperaTexto": "CASE WHEN p_partkey % 3 = 0 THEN '7 días' END",
    "presentaciones": "CASE WHEN p_partkey % 2 = 0 THEN array(named_struct('nombre', 'caja'), named_struct('nombre', 'bote')) ELSE array() END",
}
_FIELDS = {
    "nregistro": "CAST(p_partkey AS STRING)", "nombre": "p_name", "labtitular": "CASE WHEN p_partkey % 3 > 0 THEN concat('Lab ', p_brand) END",
    "primeraAutorizacion": "CASE p_partkey % 4 WHEN 0 THEN -1L WHEN 1 THEN NULL ELSE 900000000000L + p_partkey * 40000000000L % 700000000000L END",
    "atcs": "CASE WHEN p_partkey % 2 = 0 THEN array(named_struct('codigo', concat('Q', p_partkey % 7), 'nombre', p_type, 'nivel', 1), named_struct('codigo', concat('QA', p_partkey % 7), 'nombre', p_brand, 'nivel', 2)) END",
    "pactivos": "CASE WHEN p_partkey % 5 > 0 THEN concat(p_type, ' base') END", "excip": "CASE WHEN p_partkey % 2 = 0 THEN 'agua' END",
    "forma": "CASE WHEN p_partkey % 6 <> 5 THEN named_struct('nombre', 'polvo') END", "dispensacion": "CASE WHEN p_partkey % 2 = 0 THEN named_struct('nombre', 'receta') END",
    "administracion": "CASE WHEN p_partkey % 3 = 0 THEN named_struct('nombre', 'uso externo') END", "is_antibiotic": "CASE p_partkey % 7 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END",
    "antibiotico": "CASE WHEN p_partkey % 7 = 0 THEN array(named_struct('categoria', 'B', 'familia', p_brand, 'principio', p_type)) ELSE array() END",
}


def _master(spark, sf_dir):
    """Parts in the shape of catalogue records; every seventeenth has no metadata."""
    parts = table(spark, sf_dir, "part")
    meta = ", ".join(f"'{k}', {v}" for k, v in _METADATA.items())
    metadata = parts.filter("p_partkey % 17 > 0").select(F.expr("CAST(p_partkey AS STRING)").alias("nregistro"), F.expr(f"named_struct({meta})").alias("metadata"))
    return documents.with_metadata(parts.select(*[F.expr(v).alias(k) for k, v in _FIELDS.items()]), metadata)


def _parsed(spark, sf_dir):
    """Parsed documents of most records, with two sections each, and a few that the catalogue lacks."""
    parts = table(spark, sf_dir, "part")
    sub = "named_struct('seccion_id', '3.1', 'titulo', 'Especies de destino', 'contenido', p_brand)"
    none = "CAST(array() AS ARRAY<STRUCT<seccion_id: STRING, titulo: STRING, contenido: STRING>>)"
    sections = F.expr(f"array(named_struct('seccion_id', '1', 'titulo', 'NOMBRE', 'contenido', p_name, 'subsecciones', {none}), named_struct('seccion_id', '3', 'titulo', 'DATOS', 'contenido', '', 'subsecciones', array({sub})))")
    rows = parts.filter("p_partkey % 13 > 0").select(F.expr("CAST(p_partkey AS STRING)").alias("document_id"), F.expr("concat('texto ', p_type)").alias("especies_destino"), sections.alias("secciones"))
    lost = parts.filter("p_partkey < 5").select(F.expr("concat('EU-2-24-', p_partkey)").alias("document_id"), F.lit("").alias("especies_destino"), sections.alias("secciones"))
    return rows.unionByName(lost)


def _records(spark, sf_dir):
    return documents.assemble(_parsed(spark, sf_dir), _master(spark, sf_dir), "https://example.org/")


def nested_reshape(spark, sf_dir):
    rows = documents.reshape_for_model(_master(spark, sf_dir))
    return rows.select("nregistro", "antibiotico", F.explode("indicaciones").alias("especie", "nombres")).select("nregistro", "antibiotico", "especie", F.array_join("nombres", "|").alias("nombres"))


def document_assembly(spark, sf_dir):
    rows = _records(spark, sf_dir)
    sizes = [F.size(c).alias(f"n_{c}") for c in ("codigos_atc", "especies_registro", "indicaciones", "contraindicaciones", "reacciones_adversas", "interacciones", "tiempo_espera", "presentaciones", "secciones")]
    return rows.select("document_id", "nombre_medicamento", "url", "laboratorio_titular", "fecha_primera_autorizacion", "principios_activos", "excipientes", "forma_farmaceutica", "condiciones_dispensacion", "condiciones_administracion", "es_antibiotico", "tiempo_espera_texto", *sizes)


def unmatched_documents(spark, sf_dir):
    """Documents without a master record, and the registrations among them by kind."""
    _, lost = documents.quarantined(_parsed(spark, sf_dir), _master(spark, sf_dir))
    european, others = documents.split_registrations(lost, "document_id")
    return european.withColumn("kind", F.lit("eu")).unionByName(others.withColumn("kind", F.lit("other")))


def catalogue_names(spark, sf_dir):
    return documents.record_names(_master(spark, sf_dir).withColumn("nombre", F.when(F.col("nregistro").cast("long") % 11 > 0, F.col("nombre")).otherwise(" ")))


def catalogue_keys(spark, sf_dir):
    return documents.record_keys(_master(spark, sf_dir))


def parser_run(spark, sf_dir):
    """Headed texts as files named after registrations, some empty, some European with an appendix, some unknown to the catalogue."""
    text = F.when(F.col("document_id") % 9 == 0, F.lit(" ")).when(F.col("document_id") % 5 == 0, F.concat("text", F.lit("\n**10. FECHA**\nx\n-----\n**9. AFTER**\ny"))).otherwise(F.col("text"))
    number = F.col("document_id").cast("string")
    name = F.when(F.col("document_id") % 5 == 0, F.concat(F.lit("EU-2-24-"), number)).when(F.col("document_id") % 7 == 0, F.concat(F.lit("FT_X"), number)).otherwise(F.concat(F.lit("FT_"), number, F.lit("_ESP")))
    files = _markdown(spark, sf_dir).select(name.alias("name"), text.alias("content"))
    master = _master(spark, sf_dir)
    known = F.when(F.col("nregistro").cast("long") % 5 == 0, F.concat(F.lit("EU/2/24/"), "nregistro")).otherwise(F.concat("nregistro", F.lit(" ESP")))
    done, lost = documents.parse_documents(files, master.withColumn("nregistro", known), "https://example.org/", strict=True)
    rows = done.select("document_id", F.array_join(F.transform("secciones", lambda s: s["seccion_id"]), ",").alias("detail"))
    return rows.withColumn("kept", F.lit(True)).unionByName(lost.select("document_id", F.col("reason").alias("detail")).withColumn("kept", F.lit(False)))


def last_section_trim(spark, sf_dir):
    tail = F.when(F.col("doc_id") % 2 == 0, F.lit("\n**10. FECHA**\nx-----\nrest-----")).otherwise(F.lit("\n10.5 no-----"))
    return table(spark, sf_dir, "documents").select("doc_id", documents.trim_after_last_section(F.concat("text", tail)).alias("text"))


def single_stage_search(spark, sf_dir):
    """An index of chunks alone, stored, loaded and searched."""
    path = scratch(spark, "single")
    dense.save_index(_grouped_chunks(spark, sf_dir), None, path)
    return dense.top_k(dense.load_chunks(spark, path).select(F.col("chunk_id").alias("doc_id"), "vector"), vector_queries(spark, sf_dir), 5)


def stopword_refresh(spark, sf_dir):
    """One run too early to make new words, and one whose files have changed."""
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    held = spark.createDataFrame([("kept",)], "term string")
    same, no = stopwords.refresh(files, stopwords.content_hashes(files), held, 1)
    new, yes = stopwords.refresh(files, stopwords.content_hashes(files.filter("path <> '0'")), held, 1, ("él",))
    return same.select("term", F.lit(no).alias("made")).unionByName(new.select("term", F.lit(yes).alias("made")))


def regenerate_decisions(spark, sf_dir):
    """Whether to make stopwords anew for several shares of changed files and ages."""
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    old = stopwords.content_hashes(files)
    every = F.explode(F.array(*[F.struct(F.lit(n).alias("every"), F.lit(age).cast("double").alias("age")) for n, age in ((1, 1.0), (2, 1.0), (3, 1.0), (3, 16.0), (3, None))]))
    content = F.when(F.col("path").cast("long") % F.col("s.every") == 0, F.upper("content")).otherwise(F.col("content"))
    new = files.select("path", "content", every.alias("s")).select(F.col("s.every").alias("every"), F.col("s.age").alias("age"), "path", content.alias("content"))
    hashed = stopwords.content_hashes(new.select(F.struct("every", "age", "path").alias("path"), "content")).select("path.*", "sha256")
    compared = stopwords.changes(old.select("path", "sha256", every.alias("s")).select(F.struct("s.every", "s.age", "path").alias("path"), "sha256"), hashed.select(F.struct("every", "age", "path").alias("path"), "sha256"))
    return stopwords.decisions(compared.select("path.every", "path.age", "status"), ["every", "age"], "age").select("every", "age", "again")


def group_questions(spark, sf_dir):
    return context.group_questions(record_contexts(spark, sf_dir))


def record_chunks(spark, sf_dir):
    return documents.section_chunks(_records(spark, sf_dir)).withColumn("path", F.array_join("path", " > "))


def essential_fallback(spark, sf_dir):
    rows = _records(spark, sf_dir)
    texts = documents.essential_text(rows).filter("try_cast(document_id AS LONG) % 2 = 0").withColumn("essential", F.concat(F.lit("text of "), F.col("document_id")))
    return documents.with_essential_text(rows, texts)


def antibiotic_details(spark, sf_dir):
    """Flagged records with the details that a ';' file has for their codes; of a repeated code the first line."""
    codes = table(spark, sf_dir, "supplier").select(F.expr("concat('C', s_suppkey % 40)").alias("COD_PACTIV"), F.expr("concat('cat', s_suppkey)").alias("Categoría"), F.expr("concat('fam', s_nationkey)").alias("Familia"), F.col("s_name").alias("Principio activo"))
    path = scratch(spark, "codes")
    writers.write_csv(codes.coalesce(1).sortWithinPartitions("Principio activo"), path, sep=";")
    records = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("nregistro"), F.expr("p_partkey % 3 = 0").alias("is_antibiotic"), F.expr("array(concat('C', p_partkey % 50), concat('C', p_size))").alias("principios"))
    rows = documents.antibiotic_details(records, readers.lookup_csv(spark, path, "COD_PACTIV"))
    return rows.select("nregistro", "is_antibiotic", F.array_join(F.transform("antibiotico", lambda a: F.concat_ws("/", a["categoria"], a["familia"], a["principio"])), ",").alias("antibiotico"))


def nested_names(spark, sf_dir):
    """Contraindications whose species, or whose own name where it is a species, are normalised by a small dictionary."""
    entries = spark.createDataFrame([(0, "gatos", "Gato"), (1, "perros", "Perro"), (2, "machinery", "Machine")], "position long, entry string, category string")
    against = "array(named_struct('nombre', 'Gatos ', 'especie', CAST(NULL AS STRUCT<nombre: STRING>)), named_struct('nombre', 'fiebre', 'especie', named_struct('nombre', c_mktsegment)), named_struct('nombre', CAST(NULL AS STRING), 'especie', CAST(NULL AS STRUCT<nombre: STRING>)), named_struct('nombre', c_mktsegment, 'especie', CAST(NULL AS STRUCT<nombre: STRING>)))"
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr(against).alias("items"))
    asked = rows.select(F.explode("items").alias("x")).select(F.coalesce("x.especie.nombre", F.trim("x.nombre")).alias("name"))
    done = documents.normalise_nested(rows, "items", fuzzy.name_map(asked, entries), own=True)
    return done.select("c_custkey", F.posexplode("items").alias("at", "x")).select("c_custkey", "at", "x.nombre", F.col("x.especie.nombre_normalizado").alias("especie"), "x.es_especie", "x.nombre_normalizado")


def record_contexts(spark, sf_dir):
    """Labelled blocks of records for a language model, ten at most of each brand."""
    rows = documents.reshape_for_model(_master(spark, sf_dir))
    groups = mining.invert(table(spark, sf_dir, "part"), "p_brand", "p_partkey").select("value", "id")
    return context.group_contexts(context.record_blocks(rows.filter("especies IS NOT NULL")), groups)


def _markdown(spark, sf_dir):
    """Documents with headings: each of the first lines becomes a section, a plain and a bold subsection in turn."""
    lines = F.split(F.regexp_replace("text", r"\*", ""), "\n")
    head = F.transform(lines, lambda x, i: F.concat(F.when(i % 3 == 0, F.concat(F.lit("**"), (F.floor(i / 3) % 12 + 1).cast("string"), F.lit(". TITULO:**\n"))).when(i % 3 == 1, F.concat(F.lit("**"), (F.floor(i / 3) % 12 + 1).cast("string"), F.lit(".1** Especies de destino\n"))).otherwise(F.concat((F.floor(i / 3) % 12 + 1).cast("string"), F.lit(".2 Otra\n"))), x))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.array_join(head, "\n").alias("text"))


def heading_parse(spark, sf_dir):
    return documents.headings(_markdown(spark, sf_dir), strict=True)


def section_parse(spark, sf_dir):
    return documents.section_rows(_markdown(spark, sf_dir), strict=True)


def species_lookup(spark, sf_dir):
    docs = _markdown(spark, sf_dir)
    return documents.target_species(documents.section_rows(docs, strict=True), docs)


def chunk_flatten(spark, sf_dir):
    docs = _markdown(spark, sf_dir)
    trees = documents.section_trees(docs, strict=True).withColumn("nombre_medicamento", F.concat(F.lit("doc "), F.col("document_id").cast("string")))
    return documents.section_chunks(trees).withColumn("path", F.array_join("path", " > "))


def essential_text(spark, sf_dir):
    return documents.essential_text(_records(spark, sf_dir))


def complete_text(spark, sf_dir):
    return documents.complete_text(_records(spark, sf_dir))


def id_codecs(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("EU-2-24-"), F.col("o_orderkey").cast("string"), F.lit("-001-x")).alias("file"))
    return rows.select("o_orderkey", text.registration_from_file(F.col("file")).alias("registration"), text.file_from_registration(text.registration_from_file(F.col("file"))).alias("back"), text.path_leaf(F.concat(F.lit("/a/b/"), F.col("file"), F.lit(".md"))).alias("leaf"), text.canonical_doc_id(F.concat(F.lit("FT_"), F.col("o_orderkey").cast("string"), F.lit("_ESP"))).alias("doc"))


def path_parts(spark, sf_dir):
    name = F.when(F.col("o_orderkey") % 2 == 0, F.lit("C:\\data\\")).otherwise("/data/")
    path = F.concat(name, F.lit("f"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, ".tar.gz").otherwise("/"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.path_leaf(path).alias("leaf"), text.path_stem(path).alias("stem"), text.path_extension(path).alias("extension"))


def text_tools(spark, sf_dir):
    line = text.complete_line(F.col("text"), F.lit(30))
    return table(spark, sf_dir, "documents").select("doc_id", text.ascii_letters(F.col("text")).alias("letters"), text.clean(F.col("text"), ".,;", ("the", "de")).alias("clean"), line.alias("line"), text.all_equal(F.split("text", " ")).alias("equal"))


def link_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", readers.first_link(F.col("html"), "th", "https://example.org").alias("link"))


# --- files

def _files(spark, sf_dir, extension="md"):
    path = scratch(spark, "files")
    writers.write_documents(table(spark, sf_dir, "nation").select(F.col("n_name"), F.expr("concat('# ', n_name, '\n', repeat('é', n_nationkey))").alias("content")), "n_name", "content", path, extension)
    return path


def text_folder_scan(spark, sf_dir):
    return readers.text_folder(spark, _files(spark, sf_dir)).select("name", "content")


def folder_profile(spark, sf_dir):
    return readers.folder_profile(spark, _files(spark, sf_dir)).select("files", F.round(F.col("mb") * 1000).cast("long").alias("kb"))


def file_digests(spark, sf_dir):
    return writers.file_digests(spark, _files(spark, sf_dir))


def convert_files(spark, sf_dir):
    """Binary files through a converter; the stand-in fails on the shortest."""
    return readers.convert_files(spark, _files(spark, sf_dir, "pdf"), _convert).select("name", "text", "error")


def _convert(content: bytes) -> str:
    if len(content) < 12:
        raise ValueError("empty")
    return content.decode().replace("# ", "## ")


def json_lines_scan(spark, sf_dir):
    """Written twice, the second time by appending."""
    path, rows = scratch(spark, "lines"), table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.array("c_mktsegment", F.lit("ñ")).alias("tags"))
    writers.write_json(rows.filter("c_custkey % 2 = 0"), path)
    writers.write_json(rows.filter("c_custkey % 2 <> 0"), path, "append")
    return readers.json_lines(spark, path, "c_custkey long, c_name string, tags array<string>").select("c_custkey", "c_name", F.array_join("tags", "+").alias("tags"))


def json_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", readers.json_value(F.col("props"), "k long")["k"].alias("k"))


def catalogue_merge(spark, sf_dir):
    """Pages of records as JSON files; of a repeated registration the record of the last page stays."""
    rows = table(spark, sf_dir, "orders").select(F.expr("CAST(o_custkey AS STRING)").alias("nregistro"), F.expr("CAST(o_orderkey AS STRING)").alias("nombre"), F.expr("o_orderkey % 20").alias("page"))
    once = rows.groupBy("page", "nregistro").agg(F.max("nombre").alias("nombre"))
    pages = once.groupBy("page").agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("nregistro", "nombre"))).alias("resultados"))).alias("text"))
    path = scratch(spark, "pages")
    writers.write_documents(pages.select(F.concat(F.lit("master_page"), F.col("page").cast("string")).alias("name"), "text"), "name", "text", path, "json")
    return readers.catalogue(spark, path, "resultados array<struct<nregistro:string,nombre:string>>").select("nregistro", "nombre")


def text_lines(spark, sf_dir):
    """Sorted lines, written, read, and dealt to full batches of seven."""
    path = scratch(spark, "text")
    writers.write_lines(table(spark, sf_dir, "customer").select("c_name"), "c_name", path)
    return readers.batch_numbers(readers.line_rows(spark, path), 7, "value")


def paged_scan(spark, sf_dir):
    """A paged service over the supplier table: the first page tells how many rows there are."""
    try:
        spark.dataSource.register(readers.PagedSource)
    except Exception:  # registered before
        pass
    return spark.read.format("paged").schema("s_suppkey long, s_name string").option("fetcher", "thicket.sources.samples:page_of").option("path", f"{sf_dir}/supplier.parquet").option("columns", "s_suppkey,s_name").option("pagesize", 7).load()


def key_look_up(spark, sf_dir):
    """One call a key of a service that knows the even ones."""
    return readers.look_up(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("nregistro")), "nregistro", samples.record_of)


def interstitial_links(spark, sf_dir):
    """The first matching link of a page, followed."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "html")
    return readers.follow_interstitial(pages, "th", "https://example.org", samples.content_of).select("id", "link", F.col("content").cast("string").alias("content"))


def mapping_round_trip(spark, sf_dir):
    """A dictionary with one entry added, saved as a JSON object and loaded again."""
    path = scratch(spark, "mapping")
    entries = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("position"), F.lower("n_name").alias("entry"), F.expr("concat('r', n_regionkey)").alias("category"))
    fuzzy.save_mapping(fuzzy.add_mapping(fuzzy.add_mapping(entries, " NATION_3 ", "changed"), "New Land", "new"), path)
    return fuzzy.load_mapping(spark, path)


def run_metrics(spark, sf_dir):
    """Rows of evaluation logs in a given order; other runs are left out."""
    logs = table(spark, sf_dir, "region").select(F.expr("concat('logs/', CASE r_regionkey WHEN 0 THEN 'bm25/bm25_k50' WHEN 1 THEN 'faiss_k50' WHEN 2 THEN 'Hybrid/late_fusion' WHEN 3 THEN 'unlisted' ELSE 'faiss/bm25like' END, '.json')").alias("path"), F.expr("map('recall', r_regionkey / 10, 'mrr', 0.5D)").alias("metrics"))
    return metrics.run_rows(logs, ("late_fusion", "bm25_k50", "faiss_k50", "bm25like"))


def ingest_run(spark, sf_dir):
    """End to end: records, documents, chunks and vectors, with one step skipped and its result left as it was."""
    return ingest.run(spark, _parsed(spark, sf_dir), _master(spark, sf_dir), scratch(spark, "ingest"), skip=("answers",)).select("at", "step", "rows", "skipped", "rows_read")


def bpe_counts(spark, sf_dir):
    """Tokens of every document by a byte-pair rank file, whose path is public."""
    import public_tokenizers

    return bpe.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


# --- incremental

def change_feed_filter(spark, sf_dir):
    feed = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("nregistro"), F.array("event_type").alias("cambio"))
    return changes.changed_ids(feed, "purchase")


def sha256_diff(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    files = lambda c, keep: stopwords.content_hashes(docs.filter(keep).select(F.col("doc_id").cast("string").alias("path"), c.alias("content")))
    old, new = files(F.col("text"), F.col("doc_id") % 7 != 0), files(F.when(F.col("doc_id") % 5 == 0, F.upper("text")).otherwise(F.col("text")), F.col("doc_id") % 11 != 0)
    return stopwords.changes(old, new)


def latest_wins_merge(spark, sf_dir):
    return documents.latest(table(spark, sf_dir, "events"), "user_id", F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type", "value")


def change_feed_stream(spark, sf_dir):
    """The last event of every user, from a feed that is read in two runs, while it grows, and in a third that repeats the second."""
    schema = "position long, user_id long, event_type string, value double, ts timestamp"
    folder, target, state = (scratch(spark, name) for name in ("feed", "upserted", "stream"))
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("position"), "user_id", "event_type", "value", F.col("ts").cast("timestamp"))
    half = events.agg(F.percentile_approx("position", 0.5)).first()[0]
    run = lambda: changes.upsert_stream(feed.stream(spark, schema, path=folder), target, "user_id", ("ts", "position"), state).awaitTermination()
    for part in (events.filter(F.col("position") <= half), events.filter(F.col("position") > half)):
        feed.append_changes(part, folder)
        run()
    changes.forget_last_commit(spark, state)
    run()
    return changes.snapshot(spark, target, schema, changes.last_epoch(spark, target)).select("user_id", F.col("position").alias("event_id"), "event_type", "value")


def event_windows(spark, sf_dir):
    return changes.windowed_counts(table(spark, sf_dir, "events"))


def species_fuzzy(spark, sf_dir):
    """Part names with a letter lost, every other one with two strange ones, against a dictionary that lacks some of the names."""
    parts = table(spark, sf_dir, "part")
    lost = F.expr("concat(substring(p_name, 1, cast(p_partkey % length(p_name) as int)), substring(p_name, cast(p_partkey % length(p_name) as int) + 2))")
    names = parts.select(F.when(F.col("p_partkey") % 2 == 0, lost).otherwise(F.concat(lost, F.lit("qz"))).alias("name"))
    entries = parts.filter("length(p_name) % 4 <> 0").select(F.col("p_partkey").alias("position"), F.lower(F.trim("p_name")).alias("entry"), F.col("p_type").alias("category"))
    return fuzzy.closest_matches(names, entries)


def species_groups(spark, sf_dir):
    return fuzzy.group_ids(table(spark, sf_dir, "documents"), "source", "doc_id")


def unmapped_report(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"))
    entries = spark.createDataFrame([(0, "building", "b"), (1, "machinerie", "m")], "position long, entry string, category string")
    return fuzzy.unmapped_names(names, entries)


def dedup_ordered(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return stopwords.order_preserving_distinct(rows, "role", "turn", ("conv_id",)).select("conv_id", "turn", "role")


def seeded_sample(spark, sf_dir):
    return stopwords.seeded_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100)


def chat_turns(spark, sf_dir):
    """Question-answer pairs: each user turn with the assistant turn that follows it."""
    window = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.lead("role").over(window).alias("_r"), F.lead("turn").over(window).alias("answer_turn"))
    return rows.filter("role = 'user' AND _r = 'assistant'").select("conv_id", "turn", "answer_turn")


NAMES = """text_normalize token_df_tf accents_fold dict_translate language_route language_detect corpus_tokens stopwords_generated stemmed_terms spanish_dates snippets
bm25_okapi_topk bm25_l_topk bm25_plus_topk bm25_threshold dense_topk dense_doc_topk hierarchical_exact hierarchical_overfetch group_mean_embedding
late_fusion_worst late_fusion_best late_fusion_balanced late_fallback fallback_coverage context_pack rag_answers eval_bm25 eval_dense_dup eval_dense_dedup
relevance_buckets score_histogram score_stats grouping_miner criteria_filter inverted_grouping nested_reshape heading_parse section_parse species_lookup
chunk_flatten essential_text complete_text id_codecs link_extract change_feed_filter sha256_diff latest_wins_merge change_feed_stream event_windows species_fuzzy species_groups
unmapped_report dedup_ordered seeded_sample chat_turns
bm25_normalised_topk bm25_stemmed_topk bm25_stored_topk bm25_incremental_topk bm25_pruned_topk vector_index_statistics vector_look_up uncovered_chunks document_assembly unmatched_documents catalogue_names
record_chunks essential_fallback antibiotic_details nested_names record_contexts path_parts text_tools text_folder_scan folder_profile file_digests convert_files
json_lines_scan json_values catalogue_merge text_lines paged_scan key_look_up interstitial_links mapping_round_trip run_metrics ingest_run bpe_counts catalogue_keys parser_run last_section_trim single_stage_search stopword_refresh regenerate_decisions group_questions""".split()


def queries() -> dict:
    return {name: globals()[name] for name in NAMES}
