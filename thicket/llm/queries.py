"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.llm.decontaminate import contained_items
from thicket.llm.divergence import divergence
from thicket.llm.fingerprint import edited_fingerprints
from thicket.llm.language_model import score_documents
from thicket.llm.manifest import tampered_by_id, verified_rows
from thicket.llm.neardup import near_duplicates
from thicket.llm.pii import pseudonymise
from thicket.llm.quality import quality_sample
from thicket.llm.sentencepiece_codec import encode_decode
from thicket.llm.token_counts import token_counts
from thicket.llm.token_files import token_file_digest
from thicket.llm.warc import archive_round_trip
from thicket.llm.wrappers import main_texts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_sample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(_table(spark, sf_dir, "pages"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_rows(_table(spark, sf_dir, "documents"), tampered_by_id())


# The same results as SQL, where it can express them.
_FOLD = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def _shingles(table: str, key: str, n: int) -> str:
    """(key, shingle) of a table's texts: the distinct n-word shingles, or the whole sequence of fewer words."""
    words = _WORDS.format(_FOLD.format("text"))
    return f"SELECT DISTINCT {key}, CASE WHEN len(w) < {n} THEN w ELSE w[i : i + {n - 1}] END AS s FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {n - 2}, 2))) AS i FROM (SELECT {key}, {words} AS w FROM {table}) WHERE len(w) > 0)"


_OP3 = f"""WITH it AS ({_shingles('benchmark', 'item_id', 5)}), dc AS ({_shingles('documents', 'doc_id', 5)}), n AS (SELECT item_id, count(*) AS item_shingles FROM it GROUP BY 1), h AS (SELECT doc_id, item_id, count(*) AS shared_shingles FROM it JOIN dc USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, item_shingles, shared_shingles, shared_shingles / item_shingles AS containment FROM h JOIN n USING (item_id) WHERE shared_shingles / item_shingles >= 0.8"""
_BASE32 = "array_to_string(list_transform(range(32), lambda j: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substring(h, (5 * (j // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (j % 4))::INT) & 31)::INT + 1, 1)), '')"
_OP5 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), g AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM g"""
_OP6 = f"""WITH RECURSIVE sh AS ({_shingles('documents', 'doc_id', 2)}), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1), pr AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2), lk AS (SELECT a, b FROM pr JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
re AS (SELECT DISTINCT a AS doc_id, a AS other FROM lk UNION SELECT re.doc_id, b FROM re JOIN lk ON re.other = lk.a), co AS (SELECT doc_id, min(other) AS c FROM re GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN co USING (doc_id)"""


# The pages of the tables have one article each, of headlines and paragraphs, and every block outside it is template.
_PLAIN = "regexp_replace(replace(x, '<br>', ' '), '<[^>]+>', '', 'g')"
_DECODED = f"replace(replace(replace(replace(replace({_PLAIN}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&')"
_BLOCK = rf"trim(regexp_replace({_DECODED}, '\s+', ' ', 'g'))"
_OP7 = rf"SELECT page_id, url, text, length(text) AS n_chars FROM (SELECT page_id, url, array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>'), lambda x: {_BLOCK}), lambda x: x <> ''), chr(10)) AS text FROM pages)"


_OP11 = r"""WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d), kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT d) >= 3),
n AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL), s AS (SELECT DISTINCT lang, source FROM d), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
dense AS (SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total, v FROM s JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (total + v) AS p FROM dense),
l AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 1) // (total + v) AS q FROM (SELECT lang, term, n, v, sum(n) OVER (PARTITION BY lang) AS total FROM (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM dense GROUP BY ALL))),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
UNION ALL SELECT p.lang, source, 'term', term, ((p.p - q) * (p.p - q) // q)::BIGINT FROM p JOIN l USING (lang, term) WHERE n > 0 AND p.p > q)
SELECT lang, source, part, item, value, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u) WHERE part = 'pair' OR rank <= 200"""
_LEAF = "sha256(concat(" + ", ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}) END" for c in ("doc_id", "source", "lang", "{0}", "text")) + "))"
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda j: (ascii(c)::BIGINT >> j::INT) & 1)))), lambda s, b: xor(s >> 1, 3988292384 * (xor(s, b) & 1))), 4294967295)"


def _levels(name: str, leaves: str) -> str:
    """name(tree, lvl, i, h, w): all nodes of the trees, w nodes a level."""
    return f"""{name} AS (SELECT tree, 0 AS lvl, i, h, count(*) OVER (PARTITION BY tree) AS w FROM ({leaves}) UNION ALL SELECT tree, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (w + 1) // 2 FROM {name} WHERE w > 1 GROUP BY tree, lvl, i // 2, w)"""


_OP13 = f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF.format("n_chars")} AS leaf, CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_LEAF.format("(n_chars + 1)")} END AS shown FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d), {_levels('a', 'SELECT tree, i, leaf AS h FROM l')}, r AS (SELECT tree, h FROM a WHERE w = 1),
t AS (SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM r), {_levels('b', "SELECT '' AS tree, i, h FROM t")},
wa AS (SELECT doc_id, leaf, tree, 0 AS lvl, i, coalesce(shown, leaf) AS f, '' AS proof, (SELECT max(lvl) FROM a WHERE a.tree = l.tree) AS top FROM l UNION ALL SELECT wa.doc_id, wa.leaf, wa.tree, wa.lvl + 1, wa.i // 2, sha256(CASE WHEN s.h IS NULL THEN f WHEN wa.i % 2 = 0 THEN f || s.h ELSE s.h || f END), proof || coalesce(s.h, ''), top FROM wa LEFT JOIN a AS s ON s.tree = wa.tree AND s.lvl = wa.lvl AND s.i = xor(wa.i, 1) WHERE wa.lvl < top),
wb AS (SELECT doc_id, leaf, t.h AS subroot, 0 AS lvl, t.i, f, proof FROM wa JOIN t ON t.name = wa.tree WHERE wa.lvl = top UNION ALL SELECT wb.doc_id, wb.leaf, subroot, wb.lvl + 1, wb.i // 2, sha256(CASE WHEN s.h IS NULL THEN f WHEN wb.i % 2 = 0 THEN f || s.h ELSE s.h || f END), proof || coalesce(s.h, '') FROM wb LEFT JOIN b AS s ON s.lvl = wb.lvl AND s.i = xor(wb.i, 1) WHERE wb.lvl < (SELECT max(lvl) FROM b))
SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b.h AS verified FROM wb JOIN b ON b.w = 1 WHERE wb.lvl = b.lvl"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op3_benchmark_decontamination": _OP3, "op5_warc_round_trip": _OP5, "op6_near_duplicates": _OP6, "op7_html_main_text": _OP7, "op11_source_divergence": _OP11, "op13_merkle_manifest": _OP13}
