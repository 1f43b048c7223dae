"""Retrieval operators: every query with SQL against DuckDB, and golden values."""

import json
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import thicket.catalog as catalog
from thicket.functions import fuzzy, text
from thicket.functions import stem as stems
from thicket.functions.stem import stem, stem_once
from thicket.operators import context, dense, documents, fusion, metrics, mining, sparse, stopwords
from thicket.sources import readers, writers
from thicket.streaming import changes

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cells(frame):
    frame = frame[sorted(frame.columns)]
    show = lambda x: "" if x is None or x != x else f"{x:.5f}" if isinstance(x, float) else str(x)
    return sorted(tuple(show(x) for x in row) for row in frame.astype(object).itertuples(index=False)), list(frame.columns)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, spark, sf_dir, duck):
    got = catalog.queries()[name](spark, sf_dir).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql:
        assert cells(got) == cells(duck.execute(sql).df())
    else:
        assert len(got) and list(got.columns)


def test_entry_imports():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_bm25_models_by_hand(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "b c"), (3, "")], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "a"), (0, "a")], "query_id long, term string")
    index = sparse.build_index(docs)
    got = {r.doc_id: r.score for r in sparse.top_k(index, asked, 3).collect()}
    idf = math.log(3 - 1 + 0.5) - math.log(1.5)
    assert got[1] == round(2 * idf * 2 * 2.5 / (2 + 1.5 * (0.25 + 0.75 * 3 / (5 / 3))), 6) and got[2] == got[3] == 0
    with pytest.raises(ValueError):
        sparse.scores(index, asked, "other")
    plus = {r.doc_id: r.score for r in sparse.top_k(index, asked, 3, "plus").collect()}
    assert plus[2] == plus[3] == round(2 * math.log(4), 6) < plus[1]
    assert sparse.top_k(index, asked.limit(0), 3).count() == 0


def test_index_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x y"), (2, "y z")], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "y"), (0, "z")], "query_id long, term string")
    index = sparse.build_index(docs)
    index.save(str(tmp_path / "i"))
    assert sparse.top_k(sparse.Index.load(spark, str(tmp_path / "i")), asked, 2).collect() == sparse.top_k(index, asked, 2).collect()
    assert sparse.Index.settings(spark, str(tmp_path / "i")) == {}


@pytest.mark.parametrize("model", sparse.MODELS)
def test_sent_terms_and_joins_agree(spark, sf_dir, monkeypatch, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    asked = spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("item_id AS query_id", "explode(split(lower(text), ' ')) AS term")
    index = sparse.build_index(docs)
    sent = sparse.top_k(index, asked, 5, model).orderBy("query_id", "rank").collect()
    pairs = sparse.pair_scores(index, asked, spark.createDataFrame(sent).select("query_id", "doc_id"), model).collect()
    assert {(r.query_id, r.doc_id, r.score) for r in pairs} == {(r.query_id, r.doc_id, r.score) for r in sent}
    monkeypatch.setattr(sparse, "SENT_TERMS", 3)
    assert sparse.top_k(index, asked, 5, model).orderBy("query_id", "rank").collect() == sent


def test_normalised_and_stemmed_retrieval(spark, sf_dir):
    """Brute force over stemmed words of documents and queries."""
    from thicket.plans.queries import STOPWORDS, queries

    read = lambda t: {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(*(("doc_id", "text") if t == "documents" else ("item_id", "text"))).collect()}
    words = lambda t: [s for s in map(stem, (w for w in re.findall(r"\w+", text.fold(t.lower())) if w not in STOPWORDS)) if s.strip()]
    docs = {i: words(t) for i, t in read("documents").items()}
    df, n, avg = Counter(w for d in docs.values() for w in set(d)), len(docs), sum(map(len, docs.values())) / len(docs)
    raw = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    idf = {w: x if x >= 0 else 0.25 * sum(raw.values()) / len(raw) for w, x in raw.items()}
    got = {(r.query_id, r.rank): (r.doc_id, r.score) for r in queries()["bm25_stemmed_topk"](spark, sf_dir).collect()}
    counts = {i: Counter(d) for i, d in docs.items()}
    for q, t in list(read("benchmark").items())[:5]:
        scores = {i: round(sum(idf[w] * c[w] * 2.5 / (c[w] + 1.5 * (0.25 + 0.75 * len(docs[i]) / avg)) for w in words(t) if w in c), 6) for i, c in counts.items()}
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:10]
        assert all(got[q, k][0] == i and abs(got[q, k][1] - x) < 1e-5 for k, (i, x) in enumerate(best, 1))


def test_documents_are_normalised_and_scored_once(spark, sf_dir):
    """The costly steps read a document once, whatever the index and the ranking use of it."""
    from pyspark.sql.types import ArrayType, StringType

    from thicket.plans import queries as plans

    items = {r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()}
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf(ArrayType(StringType()))
    def tokens(c: pd.Series) -> pd.Series:
        seen.add(sum(t not in items for t in c))
        return c.map(lambda t: re.findall(r"\w+", (t or "").lower()))

    hits = plans._normalised(spark, sf_dir, tokens)
    got = hits.orderBy("query_id", "rank").collect()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    assert seen.value == sum(r.text not in items for r in texts) > 0
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert got == sparse.top_k(plans.index(spark, sf_dir), plans.keyword_queries(spark, sf_dir), 10).orderBy("query_id", "rank").collect()


def test_stems_of_token_arrays(spark):
    """Nulls, blank words, slices and repeats as word by word; endings as by a search of the whole lists."""
    rows = [["gatos", " ", "gatos"], None, [], ["perros", "\t", "CASAS", "x9"], [" "]]
    for arrays in (pa.array(rows, pa.list_(pa.string())), pa.array(rows, pa.list_(pa.string())).slice(1, 3), pa.array([], pa.list_(pa.string()))):
        out = stems.stem_lists(arrays)
        out.validate(full=True)
        assert out.to_pylist() == [None if r is None else [s for s in map(stem, r) if s.strip()] for r in arrays.to_pylist()]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t array<string>")
    assert [r.s for r in frame.select("i", stems.stem_tokens("t").alias("s")).orderBy("i").collect()] == stems.stem_lists(pa.array(rows, pa.list_(pa.string()))).to_pylist()
    for ends in (stems.PRONOUNS, stems.SUFFIXES, stems.Y_VERBS, stems.ALL_VERBS):
        every = sorted((e for group in ends.values() for e in group), key=len, reverse=True)
        for word in (*every, *("cant" + e for e in every), *("á" + e + "x" for e in every), ""):
            for least in (0, 2, 5):
                assert stems._ending(word, ends, least) == next((e for e in every if word.endswith(e) and len(word) - len(e) >= least), "")


def test_dense_and_fusion(spark, monkeypatch):
    vectors = spark.createDataFrame([(i, [math.cos(i), math.sin(i)]) for i in range(20)], "doc_id long, vector array<float>")
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, vector array<float>")
    best = [r.doc_id for r in dense.top_k(vectors, asked, 3).collect()]
    assert best == sorted(range(20), key=lambda i: (-round(math.cos(i), 6), i))[:3]
    hits = lambda ids: spark.createDataFrame([(0, k, i, 1.0) for k, i in enumerate(ids, 1)], "query_id long, rank int, doc_id long, score double")
    fused = [(r.doc_id, r.score) for r in fusion.late_fusion(hits([1, 2]), hits([2, 3, 2]), 2, 3).collect()]
    assert fused == [(1, 0.5), (2, round(0.25 + 0.5 / 3, 6)), (3, round(1 / 3, 6))]
    short = [(r.doc_id, r.score) for r in fusion.late_fusion(hits([1]), hits([2]), 4, 5).collect()]
    assert short == [(1, 0.5), (2, 0.5)] and [r.linear for r in fusion.rank_scores(hits([7, 8]), 10).orderBy("doc_id").collect()] == [1.0, 0.9]
    many = spark.createDataFrame([(q, [math.cos(q), math.sin(q)]) for q in range(7)], "query_id long, vector array<float>")
    whole = dense.top_k(vectors, many, 2).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(dense, "SENT_QUERIES", 3)
    assert dense.top_k(vectors, many, 2).orderBy("query_id", "rank").collect() == whole
    assert {r.n_uncovered for r in fusion.coverage(hits([1, 2]), hits([2])).collect()} == {1}
    made = dense.embed_texts(spark.createDataFrame([(1, "a b"), (2, None)], "id long, t string"), "id", "t").collect()
    assert abs(sum(x * x for x in made[0].vector) - 1) < 1e-6 and not any(made[1].vector)


def test_metrics(spark):
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "x"), (1, 3, "a"), (2, 1, "x")], "query_id long, rank int, doc_id string")
    truth = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "query_id long, doc_id string")
    once = {r.query_id: r for r in metrics.per_query(hits, truth, 10).collect()}
    twice = {r.query_id: r for r in metrics.per_query(hits, truth, 10, dedup=False).collect()}
    assert (once[1].recall, once[1].mrr, once[1].precision, once[2].hit, once[3].precision) == (0.5, 1.0, 0.5, 0, 0.0)
    assert twice[1].recall == 1.0 and twice[1].n_relevant == 2
    assert metrics.means(metrics.per_query(hits, truth, 10)).first().n_queries == 3


def test_context_budget(spark):
    hits = spark.createDataFrame([(1, k, k, "w " * n) for k, n in ((1, 3), (2, 4), (3, 1))], "query_id long, rank int, doc_id long, content string")
    assert [r.rank for r in context.pack(hits, 7).collect()] == [1, 2]
    assert context.pack(hits, 2).count() == 0
    asked = spark.createDataFrame([(1, "q"), (9, None)], "query_id long, question string")
    answered = {r.query_id: r for r in context.answers(asked, context.contexts(context.pack(hits, 7)), lambda q, c: 1 / len(c) and c[:1]).collect()}
    assert answered[1].generated_answer == "w" and "ZeroDivisionError" in answered[9].error


def test_text(spark):
    row = spark.range(1).select(
        text.fold_accents(F.lit("Ñandú col·lecció Straße ç")).alias("a"), text.spanish_date(F.lit(1590012000000)).alias("d"), text.spanish_date(F.lit(-1)).alias("n"), text.registration_from_file(F.lit("EU-2-24-310-001-003")).alias("r"),
        text.path_leaf(F.lit("C:\\a\\b.txt")).alias("p"), text.path_stem(F.lit("/x/b.tar.gz")).alias("s"), text.canonical_doc_id(F.lit("FT_14_ESP")).alias("i"), text.all_equal(F.array(F.lit(1), F.lit(1))).alias("e"),
        text.clean(F.lit("The, dog."), ",.", ("the",)).alias("c"), text.snippet(F.lit("One. Find the dog here. End."), F.array(F.lit("dog"))).alias("h"), text.snippet(F.lit("abc"), F.array(F.lit("zzz"))).alias("v"),
    ).first()
    assert tuple(row) == ("Ñandu colleccio Strasse ç", "21 de mayo de 2020", "", "EU/2/24/310-001-003", "b.txt", "b.tar", "14 ESP", True, "dog", "Found 1 of 1 query tokens:\n\nTOKEN 'dog':\n...Find the [DOG] here....\n", "No matches for query tokens. Content:\nabc")
    assert all(stem(stem(w)) == stem(w) for w in "infecciones bacterianas perros tratamiento administración".split())
    # Published examples of the Spanish stemmer.
    golden = """cheque chequ; cheques chequ; chicas chic; chicos chic; chicharrones chicharron; toreado tor; toreados tor; torear tor; toreros torer; tormentas torment; tornillos tornill; torpeza torpez; torrenciales torrencial; torres torr; tórax torax; chica chic; torneos torne; tornado torn"""
    for pair in golden.split("; "):
        word, want = pair.split()
        assert stem_once(word) == want and stem(word) == stem(want), word
    kept = spark.range(1).select(text.Normaliser(stopwords=("más", "el"), preserve=("él",)).tokens(F.lit("El perro más él")).alias("t")).first().t
    assert kept == ["el", "perro", "el"]


def test_species_fuzzy_uses_the_whole_dictionary(spark, sf_dir):
    from thicket.plans.queries import queries

    rows = spark.read.parquet(f"{sf_dir}/part.parquet").orderBy("p_partkey").collect()
    entries = [(r.p_name.strip().lower(), r.p_type) for r in rows if len(r.p_name) % 4]
    lost = lambda r, i: r.p_name[:i] + r.p_name[i + 1 :]
    names = {(lost(r, r.p_partkey % len(r.p_name)) + ("qz" if r.p_partkey % 2 else "")).strip().lower() for r in rows}
    best = lambda name: max(((fuzzy.ratio(name, e), -k) for k, (e, _) in enumerate(entries) if abs(len(e) - len(name)) <= 5), default=(0, 0))
    want = {(name, *entries[-k], ratio) for name in names for ratio, k in [best(name)] if ratio >= fuzzy.THRESHOLD}
    assert {tuple(r) for r in queries()["species_fuzzy"](spark, sf_dir).collect()} == want and 0 < len(want) < len(names)


def test_closest_matches_of_known_and_other_names(spark):
    entries = spark.createDataFrame([(3, "caballo", "b"), (1, "caballos", "a"), (2, "caballo", "c")], "position long, entry string, category string")
    names = spark.createDataFrame([("Caballo",), ("caballoss",), ("rana",), (None,)], "name string")
    got = {(r.name, r.entry, r.category) for r in fuzzy.closest_matches(names, entries).collect()}
    assert got == {("caballo", "caballo", "c"), ("caballoss", "caballos", "a")}


def test_fuzzy(spark):
    assert fuzzy.ratio("gato", "pato") == 0.75 and fuzzy.ratio("", "") == 1.0
    entries = spark.createDataFrame([(0, "perros", "Perro"), (1, "gatos", "Gato"), (2, "perror", "X")], "position long, entry string, category string")
    names = spark.createDataFrame([(" Perro ",), ("gatos",), ("llama",), (None,)], "name string")
    got = {r.name: r.out for r in fuzzy.normalise_names(names, "name", entries, "out").collect()}
    assert got == {" Perro ": "Perro", "gatos": "Gato", "llama": "llama", None: None}
    assert {r.name: r.closest for r in fuzzy.unmapped_names(names, entries).collect()} == {"perro": "Perro", "llama": "None"}
    new = spark.createDataFrame([("llama", " Camelid "), ("gatos", "Felid"), ("x", " ")], "name string, suggestion string")
    assert {r.entry: r.category for r in fuzzy.import_mappings(entries, new).collect()} == {"perros": "Perro", "gatos": "Felid", "perror": "X", "llama": "Camelid"}
    ids = spark.createDataFrame([("a", "10 ESP"), ("a", "9 ESP"), ("a", "EU/2"), ("a", "9 ESP")], "c string, i string")
    assert [r.i for r in fuzzy.group_ids(ids, "c", "i").orderBy("number", "i").collect()] == ["9 ESP", "10 ESP", "EU/2"]


def test_close_matches_equal_all_pairs(spark):
    """The segments lose no match: against every entry, over random words of all lengths."""
    import random

    r = random.Random(9)
    entries = list(dict.fromkeys("".join(r.choice("abc") for _ in range(r.randint(1, 14))) for _ in range(150)))
    names = []
    for e in entries:
        w = list(e)
        for _ in range(r.randint(0, 3)):
            w.insert(r.randint(0, len(w)), r.choice("abcd")) if r.random() < 0.5 or not w else w.pop(r.randrange(len(w)))
        names.append("".join(w))
    want = {}
    for name in set(names):
        best = max(((fuzzy.ratio(name, e), -k) for k, e in enumerate(entries) if abs(len(e) - len(name)) <= 5), default=(0, 0))
        if best[0] >= 0.85:
            want[name] = entries[-best[1]]
    table = spark.createDataFrame([(k, e, e) for k, e in enumerate(entries)], "position long, entry string, category string")
    assert {x.name: x.entry for x in fuzzy.closest_matches(spark.createDataFrame([(n,) for n in names], "name string"), table).collect()} == want


def test_sections(spark):
    md = "**1. NAME:**\nbody 1\n**3.** CLINICAL\nintro\n3.1 Especies de destino\nPerros.\n**3.2** Other\n2.5 ml per animal\n10.-  **DATE**\nx\n**4.1 Orphan**\ny"
    docs = spark.createDataFrame([("d", md), ("e", None)], "document_id string, text string")
    rows = {r.id: r for r in documents.section_rows(docs, strict=True).collect()}
    assert rows["1"].title == "NAME" and rows["1"].content == "body 1" and rows["3"].content == "intro"
    assert rows["3.1"].content == "Perros." and rows["3.2"].content == "2.5 ml per animal" and rows["4"].title == "SECCIÓN 4" and rows["4.1"].content == "y"
    assert "2.5" in {r.id for r in documents.section_rows(docs).collect()}
    assert {r.document_id: r.especies_destino for r in documents.target_species(documents.section_rows(docs, strict=True), docs).collect()} == {"d": "Perros", "e": ""}
    trees = documents.section_trees(docs, strict=True).first()
    assert [s.seccion_id for s in trees.secciones] == ["1", "3", "4", "10"] and [u.seccion_id for u in trees.secciones[1].subsecciones] == ["3.1", "3.2"]
    assert spark.range(1).select(documents.trim_after_last_section(F.lit("a\n**10. D**\nx\n-----\nz"))).first()[0] == "a\n**10. D**\nx\n"


def test_nested_names(spark):
    rows = spark.createDataFrame([("d", [("i", ("dogs",)), (None, ("cats",)), ("j", None)])], "id string, a array<struct<nombre:string,especie:struct<nombre:string>>>")
    names = spark.createDataFrame([("dogs", "Dog", True), ("j", "J", True)], "raw string, normalised string, known boolean")
    got = documents.normalise_nested(rows, "a", names).first().a
    assert [(x.nombre, x.especie.nombre_normalizado if x.especie else None) for x in got] == [("i", "Dog"), (None, "cats"), ("j", None)]
    own = documents.normalise_nested(rows, "a", names, own=True).first().a
    assert [(x.es_especie, x.nombre_normalizado) for x in own] == [(False, None), (False, None), (True, "J")]


def test_antibiotics(spark):
    master = spark.createDataFrame([("1", True, ["b", "a", "z"]), ("2", False, ["a"]), ("3", None, None)], "nregistro string, is_antibiotic boolean, principios array<string>")
    lookup = spark.createDataFrame([("a", "A", "F", "P", 0), ("a", "no", "", "", 1), ("b", "B", "F", "Q", 2)], "COD_PACTIV string, `Categoría` string, Familia string, `Principio activo` string, position long")
    got = {r.nregistro: [x.categoria for x in r.antibiotico] for r in documents.antibiotic_details(master, lookup).collect()}
    assert got == {"1": ["B", "A"], "2": [], "3": []}


def test_groupings(spark):
    docs = spark.createDataFrame([(k, ["dog"], {"dog": ["x", "y"]}, None, ["A", "A"]) for k in range(3)], "id long, species array<string>, indications map<string,array<string>>, routes array<string>, categories array<string>")
    got = mining.mine_groupings(docs, 3).collect()
    assert {(r.especie, r.indicacion, r.via, r.categoria_antibiotico, r.num_docs) for r in got} == {("dog", "x", None, "A", 3), ("dog", "y", None, "A", 3)}


def test_sources_and_sinks(spark, tmp_path):
    assert readers.page_sizes(7, 3) == [3, 3, 1] and readers.page_sizes(0, 3) == [] and list(readers.minibatches([1, 2, 3], 2)) == [[1, 2]]
    (tmp_path / "m").mkdir()
    (tmp_path / "m/master_page1.json").write_text('{"totalFilas": 2, "resultados": [{"nregistro": "1", "nombre": "old"}, {"nregistro": "2", "nombre": "b"}]}')
    (tmp_path / "m/master_page2.json").write_text('{"resultados": [{"nregistro": "1", "nombre": "new"}]}')
    assert {r.nregistro: r.nombre for r in readers.catalogue(spark, str(tmp_path / "m")).collect()} == {"1": "new", "2": "b"}
    (tmp_path / "l.csv").write_text("K;V\n1;first\n1;second\n2;x\n")
    assert {r.K: r.V for r in readers.lookup_csv(spark, str(tmp_path / "l.csv"), "K").collect()} == {"1": "first", "2": "x"}
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.b.md").write_text("one\ntwo")
    assert [(r.name, r.content) for r in readers.text_folder(spark, str(tmp_path / "t")).collect()] == [("a.b", "one\ntwo")]
    assert readers.folder_profile(spark, str(tmp_path / "t")).first().files == 1
    converted = readers.convert_files(spark, str(tmp_path / "t"), lambda b: b.decode().upper(), "*.md").first()
    assert (converted.name, converted.text, converted.error) == ("a.b", "ONE\nTWO", None)
    calls = []
    def busy():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return 1

    assert readers.with_retries(busy, sleep=lambda s: None) == 1 and len(calls) == 3
    with pytest.raises(ZeroDivisionError):  # no service is busy: not tried again
        readers.with_retries(lambda: calls.append(1) or 1 / 0, sleep=lambda s: None)
    assert len(calls) == 4
    (tmp_path / "o.json").write_text('{"a": 1}')
    assert [r.a for source in (str(tmp_path / "o.json"), '{"a": 2}', '[{"a": 3}, {"a": 4}]') for r in readers.json_source(spark, source, "a int").collect()] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        readers.json_source(spark, "absent file", "a int")
    with pytest.raises(Exception):
        dense.load_index(spark, str(tmp_path / "absent"))
    (tmp_path / "state").write_text("{damaged")
    assert readers.state(spark, str(tmp_path / "state"), "last_execution string", {"last_execution": None}) == {"last_execution": None}
    found = readers.look_up(spark.createDataFrame([("1",), ("1",), (None,)], "k string"), "k", lambda k: '{"v": %s}' % k)
    assert [(r.k, r.json) for r in found.collect()] == [("1", '{"v": 1}')]
    page = spark.createDataFrame([('<a class="x" href="/q"><a href="/veterinary/es/documents/download/1">', 1)], "html string, i int")
    assert page.select(readers.first_link(F.col("html"), "/documents/download/", "https://h")).first()[0] == "https://h/veterinary/es/documents/download/1"
    writers.write_lines(spark.createDataFrame([("b",), ("a",), (None,)], "v string"), "v", str(tmp_path / "lines"))
    assert "".join(sorted(p.read_text() for p in (tmp_path / "lines").glob("part*"))).split() == ["a", "b"]
    assert not writers.write_csv(spark.createDataFrame([], "a int"), str(tmp_path / "none"))
    made = writers.report(spark.createDataFrame([(1,)], "mean int"), spark.range(9), "R")
    assert "- mean: 1" in made["md"] and len(json.loads(made["json"])["samples"]) == 5
    assert readers.state(spark, str(tmp_path / "absent"), "last_execution string", {"last_execution": None, "n": 0}) == {"last_execution": None, "n": 0}


def test_paged_source_asks_for_the_rest(spark):
    spark.dataSource.register(readers.PagedSource)
    df = spark.read.format("paged").schema("page int, k int").option("pagesize", "2").option("fetcher", "tests.paged:fetch").load()
    assert sorted(tuple(r) for r in df.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1), (3, 0)]


def test_stopword_cut_equals_sorting(spark):
    import random

    r = random.Random(2)
    rows = [("".join(r.choice("abcé") for _ in range(r.randint(1, 6))), round(r.choice([0.1, 0.1, 0.1, 0.2, r.random()]), 12)) for _ in range(500)]
    scored = spark.createDataFrame(list(dict(rows).items()), "term string, score double")
    ordered = sorted((s, t) for t, s in dict(rows).items())
    for n in (1, 7, 60, 200, len(ordered) - 1):
        assert stopwords._cut(scored, n) == ordered[n - 1]
    assert stopwords._cut(scored, len(ordered)) == (None, None)


def test_token_counter(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["Hello world's  12 dogs", "", None, "año\n\n  ñ 🙂"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(context.bpe_counter(public_tokenizers.path("byte_bpe_50k.tiktoken"))(F.col("t"))).collect()]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert got == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_incremental(spark, tmp_path):
    feed = spark.createDataFrame([("1", ["ft", "x"]), (" ", ["ft"]), ("2", ["p"]), ("1", ["ft"])], "nregistro string, cambio array<string>")
    assert [r.nregistro for r in changes.changed_ids(feed).collect()] == ["1"]
    state, full = changes.next_state({"last_execution": "a", "consecutive_empty_responses": 29}, 0, "b")
    assert full and state == {"last_execution": "b", "consecutive_empty_responses": 0}
    asked = []
    found, state, full = changes.poll(spark, lambda since: asked.append(since) or [{"nregistro": "7", "cambio": ["ft"]}, {"nregistro": "8"}], {"last_execution": "a", "consecutive_empty_responses": 3}, "b")
    assert [r.nregistro for r in found.collect()] == ["7"] and asked == ["a"] and not full and state == {"last_execution": "b", "consecutive_empty_responses": 0}
    assert changes.poll(spark, lambda since: [], {"last_execution": None}, "b")[2]
    files = lambda rows: stopwords.content_hashes(spark.createDataFrame(rows, "path string, content string"))
    diff = stopwords.changes(files([("a", "1"), ("b", "1")]), files([("a", "2"), ("b", "1")]))
    assert stopwords.must_regenerate(diff, 1) and not stopwords.must_regenerate(diff.filter("status = 'same'"), 1) and stopwords.must_regenerate(diff, None)
    for n, rows in enumerate(['{"k": 1, "v": 1}\n{"k": 2, "v": 1}', '{"k": 1, "v": 2}']):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{n}.json").write_text(rows)
        changes.stream_upsert(spark, str(tmp_path / "in"), "k int, v int", str(tmp_path / "out"), "k", "v", str(tmp_path / "cp")).awaitTermination()
    assert sorted(tuple(r) for r in changes.snapshot(spark, str(tmp_path / "out"), "k int, v int", 1).collect()) == [(1, 2), (2, 1)]
    assert len(list((tmp_path / "out/data/epoch=1").glob("bucket=*"))) == 1


def test_repeated_entries_are_compared_once(spark):
    entries = spark.createDataFrame([(i, "caballo", f"c{i}") for i in range(40, 0, -1)] + [(9, "rana", "r")], "position long, entry string, category string")
    assert {tuple(r) for r in fuzzy._first_entries(entries).collect()} == {("caballo", 1, "c1"), ("rana", 9, "r")}
    got = fuzzy.closest_matches(spark.createDataFrame([("caballos",), ("caballo",)], "name string"), entries).collect()
    assert {(r.name, r.entry, r.category) for r in got} == {("caballos", "caballo", "c1"), ("caballo", "caballo", "c1")}


def test_pages_share_partitions_and_reads(spark, tmp_path):
    from thicket.sources import samples

    path = str(tmp_path / "rows")
    spark.range(5000).repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(path)
    options = {"path": path, "columns": "id", "pagesize": "7"}
    samples._rows.cache_clear()
    pages = [samples.page_of(i, 7, options) for i in range(1, 716)]
    assert sorted(r[0] for p in pages for r in p["resultados"]) == list(range(5000)) and {p["totalFilas"] for p in pages} == {5000}
    assert samples._rows.cache_info().misses == 3
    parts = readers._PagedReader({**options, "fetcher": "thicket.sources.samples:page_of"}).partitions()
    assert len(parts) == 12 and sum(len(p.value) for p in parts) == 715


def test_stored_and_changed_indexes_are_asked_in_the_rows_of_documents(spark, tmp_path, monkeypatch):
    """No pair of a query and a posting is shuffled, and the rows are those of joins."""
    from dataclasses import replace

    from thicket.operators.keyword_store import KeywordStore

    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 13}" for j in range(1, 9))) for i in range(60)] + [(60, "")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "w3"), (1, "w5"), (2, "w0"), (2, "w0"), (3, "none")], "query_id long, term string")
    sparse.build_index(docs).save(str(tmp_path / "index"))
    store = KeywordStore(spark, str(tmp_path / "store"))
    store.apply(docs.withColumn("text", F.lit("w3 w3")).filter("doc_id < 9"))
    store.apply(docs)
    for index in (sparse.Index.load(spark, str(tmp_path / "index")), store.index()):
        for model in sparse.MODELS:
            want = {tuple(r) for r in sparse.top_k(replace(index, tokens=None), asked, 5, model).collect()}
            with monkeypatch.context() as m:
                m.setattr(sparse, "scores", None)
                assert {tuple(r) for r in sparse.top_k(index, asked, 5, model).collect()} == want
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_chunks_are_scored_where_they_lie(spark, monkeypatch):
    """Many chunks of few documents: no join moves them, and the hits are those of all pairs; queries go in several blocks."""
    monkeypatch.setattr(dense, "SENT_QUERIES", 2)
    make = np.random.default_rng(5)
    docs, chunks, asked = make.normal(size=(3, 4)), make.integers(-2, 3, size=(90, 4)).astype(float), make.normal(size=(5, 4))
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    hits = dense.hierarchical(
        table([(d, docs[d].tolist()) for d in range(3)], "doc_id long, vector array<double>"),
        table([(c, c % 3, chunks[c].tolist()) for c in range(90)], "chunk_id long, doc_id long, vector array<double>"),
        table([(q, asked[q].tolist()) for q in range(5)], "query_id long, vector array<double>"), 2, 7)
    assert "Join" not in hits._jdf.queryExecution().optimizedPlan().toString()
    want = []
    for q in range(5):
        best = sorted(range(3), key=lambda d: (-round(float(docs[d] @ asked[q]), 6), d))[:2]
        inside = sorted((-round(float(chunks[c] @ asked[q]), 6), c) for c in range(90) if c % 3 in best)[:7]
        want += [(q, i + 1, c, c % 3) for i, (_, c) in enumerate(inside)]
    assert sorted(map(tuple, hits.select("query_id", "rank", "chunk_id", "doc_id").collect())) == sorted(want)


def test_pair_scores_make_no_other_pairs(spark):
    """Forty queries that match all of 400 documents, one pair asked for each: 16,000 sums before, the documents' words now."""
    stages = lambda: spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    records = lambda: sum(stages().apply(i).shuffleWriteRecords() for i in range(stages().size()))
    docs = spark.createDataFrame([(i, f"a b c d{i % 7}") for i in range(400)], "doc_id long, text string")
    asked = spark.createDataFrame([(q, t) for q in range(40) for t in ("a", "b", "c", f"d{q % 7}")], "query_id long, term string")
    pairs = spark.createDataFrame([(q, 10 * q) for q in range(40)] + [(99, 3)], "query_id long, doc_id long")
    built = sparse.build_index(docs)
    before = records()
    got = {(r.query_id, r.doc_id): r.score for r in sparse.pair_scores(built, asked, pairs).collect()}
    assert records() - before < 8_000
    every = {(r.query_id, r.doc_id): r.score for r in sparse.scores(built, asked).collect()}
    assert got == {(q, 10 * q): every[q, 10 * q] for q in range(40)} | {(99, 3): 0.0}
