"""The same results as SQL over the same tables."""

from __future__ import annotations

from thicket.functions.language import BUCKETS, FIRST, SCALE, SECOND
from thicket.functions.text import ACCENTED, DICTIONARY, FOLDED, MONTHS
from thicket.operators.documents import PLAIN_SUBSECTION, SECTION_PATTERNS, SUBSECTION_PATTERNS, UNIT

_W = r"[\p{L}\p{N}_]+"
_ALL = rf"regexp_extract_all(lower(text), '{_W}')"
_FOLD = f"translate(replace(regexp_replace(regexp_replace({{}}, 'l·l|ŀl', 'll', 'g'), 'L·L|ĿL', 'LL', 'g'), 'ß', 'ss'), '{ACCENTED}', '{FOLDED}')"
_TOK = f"tok AS (SELECT doc_id, unnest({_ALL}) AS term FROM documents)"
_TERM = "post AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY 1, 2), dfs AS (SELECT term, count(*) AS df FROM post GROUP BY 1)"
_BASE = f"""{_TOK}, {_TERM}, dl AS (SELECT doc_id, len({_ALL}) AS dl FROM documents), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
mi AS (SELECT sum(ln(n - df + 0.5) - ln(df + 0.5)) / count(*) AS mean_idf FROM dfs, st),
qt AS (SELECT item_id AS query_id, unnest({_ALL}) AS term FROM benchmark), q AS (SELECT query_id, term, count(*) AS m FROM qt GROUP BY 1, 2)"""
_IDF = {"okapi": "CASE WHEN ln(n - df + 0.5) - ln(df + 0.5) < 0 THEN 0.25 * mean_idf ELSE ln(n - df + 0.5) - ln(df + 0.5) END", "l": "ln(n + 1) - ln(df + 0.5)", "plus": "ln(n + 1) - ln(df)"}
_NORM = "(0.25 + 0.75 * dl / avgdl)"
_PART = {"okapi": f"tf * 2.5 / (tf + 1.5 * {_NORM})", "l": f"2.5 * (tf / {_NORM} + 0.5) / (1.5 + tf / {_NORM} + 0.5)", "plus": f"1.0 + tf * 2.5 / (1.5 * {_NORM} + tf)"}
_ABSENT = {"okapi": "0.0", "l": "2.5 * 0.5 / 2.0", "plus": "1.0"}


def _bm25(model: str, k: int) -> str:
    """CTEs that end in sparse(query_id, rank, doc_id, score)."""
    return f"""{_BASE}, w AS (SELECT query_id, q.term, m, {_IDF[model]} AS idf FROM q JOIN dfs USING (term), st, mi),
b AS (SELECT query_id, sum(m * idf * {_ABSENT[model]}) AS base FROM w GROUP BY 1),
s AS (SELECT query_id, p.doc_id, sum(m * idf * ({_PART[model]} - {_ABSENT[model]})) AS s FROM w JOIN post p USING (term) JOIN dl ON p.doc_id = dl.doc_id, st GROUP BY 1, 2),
f AS (SELECT a.query_id, d.doc_id, round(coalesce(s.s, 0) + coalesce(b.base, 0), 6) AS score FROM (SELECT DISTINCT query_id FROM q) a CROSS JOIN (SELECT doc_id FROM dl) d LEFT JOIN s ON s.query_id = a.query_id AND s.doc_id = d.doc_id LEFT JOIN b ON b.query_id = a.query_id),
sparse AS (SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM f) WHERE rank <= {k})"""


_V = "v AS (SELECT vec_id AS doc_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, label::BIGINT AS label FROM embeddings), vq AS (SELECT doc_id // 100 AS query_id, e AS qe FROM v WHERE doc_id % 100 = 0), sc AS (SELECT query_id, doc_id, label, round(list_inner_product(qe, e), 6) AS score FROM vq, v)"


def _top(source: str, k: int, name: str, doc: str = "doc_id") -> str:
    return f"{name} AS (SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {doc}) AS rank, {doc}, score FROM {source}) WHERE rank <= {k})"


_DENSE = f"{_V}, {_top('sc', 50, 'dense')}"
_MEAN = "mv AS (SELECT label, pos, avg(x) AS x FROM (SELECT label, unnest(e) AS x, unnest(range(len(e))) AS pos FROM v) GROUP BY 1, 2), mn AS (SELECT label, sqrt(sum(x * x)) AS n FROM mv GROUP BY 1), me AS (SELECT label AS doc_id, list(x / n ORDER BY pos) AS e FROM mv JOIN mn USING (label) GROUP BY 1), ds AS (SELECT query_id, me.doc_id, round(list_inner_product(qe, me.e), 6) AS score FROM vq, me)"
_LIN = "(SELECT query_id, doc_id, (50 - {pick}(rank) + 1) / 50 AS l FROM {src} GROUP BY 1, 2)"
# Four vectors, one after the other, are the chunks of a document: gs has document scores, gd the two-stage hits.
_GROUPED = "gm AS (SELECT doc_id // 4 AS g, pos, avg(x) AS x FROM (SELECT doc_id, unnest(e) AS x, unnest(range(len(e))) AS pos FROM v) GROUP BY 1, 2), gn AS (SELECT g, sqrt(sum(x * x)) AS n FROM gm GROUP BY 1), ge AS (SELECT g AS doc_id, list(x / n ORDER BY pos) AS e FROM gm JOIN gn USING (g) GROUP BY 1), gs AS (SELECT query_id, ge.doc_id, round(list_inner_product(qe, ge.e), 6) AS score FROM vq, ge), g1 AS (SELECT query_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS r FROM gs) WHERE r <= 10), gd AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank, chunk_id, doc_id, score FROM (SELECT sc.query_id, sc.doc_id AS chunk_id, sc.doc_id // 4 AS doc_id, sc.score FROM sc JOIN g1 ON sc.query_id = g1.query_id AND sc.doc_id // 4 = g1.doc_id) QUALIFY rank <= 50)"


def _fusion(alpha: float, pick: str) -> str:
    return f"WITH {_bm25('okapi', 50)}, {_V}, {_GROUPED}, fu AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.doc_id, b.doc_id) AS doc_id, round({alpha} * coalesce(a.l, 0) + (1 - {alpha}) * coalesce(b.l, 0), 6) AS score FROM {_LIN.format(pick=pick, src='sparse')} a FULL JOIN {_LIN.format(pick=pick, src='gd')} b ON a.query_id = b.query_id AND a.doc_id = b.doc_id), {_top('fu', 10, 'r')} SELECT query_id, rank, doc_id, score FROM r"


_BALANCED = f"""WITH {_bm25('okapi', 50)}, {_V}, {_GROUPED}, ca AS (SELECT query_id, doc_id FROM sparse UNION SELECT query_id, doc_id FROM gd), bo AS (SELECT ca.query_id, ca.doc_id, f.score AS s, gs.score AS d FROM ca LEFT JOIN f ON f.query_id = ca.query_id AND f.doc_id = ca.doc_id LEFT JOIN gs ON gs.query_id = ca.query_id AND gs.doc_id = ca.doc_id),
li AS (SELECT query_id, doc_id, count(*) OVER w AS n, row_number() OVER (PARTITION BY query_id ORDER BY s DESC NULLS LAST, doc_id) AS a, row_number() OVER (PARTITION BY query_id ORDER BY d DESC NULLS LAST, doc_id) AS b FROM bo WINDOW w AS (PARTITION BY query_id)),
fu AS (SELECT query_id, doc_id, round(0.5 * ((n - a + 1) / n) + 0.5 * ((n - b + 1) / n), 6) AS score FROM li), {_top('fu', 10, 'r')} SELECT query_id, rank, doc_id, score FROM r"""
_CHUNKS50 = f"{_top('sc', 50, 'dc')}, dense AS (SELECT query_id, rank, doc_id AS chunk_id, doc_id // 4 AS doc_id, score FROM dc)"


_QREL = "qr AS (SELECT item_id AS query_id, doc_id FROM documents JOIN benchmark b ON contains(documents.text, b.text))"

# The parity of the CRC-32 of a decimal doc_id, bit by bit; trigrams of the letters of a text, hashed as functions.language does.
_ODD = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda j: (ascii(c)::BIGINT >> j::INT) & 1)))), lambda s, b: xor(s >> 1, 3988292384 * (xor(s, b) & 1))), 4294967295) % 2 = 1"
_FORM = r"trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x60\x7B-\x7F]+', ' ', 'g'))"
_LANGUAGE = f"""WITH d AS (SELECT doc_id, lang, {_ODD} AS held_out, {_FORM} AS t FROM documents), ch AS (SELECT doc_id, unnest(string_split(' ' || t || ' ', '')) AS c, generate_subscripts(string_split(' ' || t || ' ', ''), 1) AS i FROM d WHERE t <> ''),
g AS (SELECT doc_id, (unicode(c) * {FIRST} + unicode(lead(c) OVER w) * {SECOND} + unicode(lead(c, 2) OVER w)) % {BUCKETS} AS b FROM ch WINDOW w AS (PARTITION BY doc_id ORDER BY i) QUALIFY lead(c, 2) OVER w IS NOT NULL), n AS (SELECT doc_id, b, count(*) AS n FROM g GROUP BY ALL),
m AS (SELECT lang, b, sum(n) AS n FROM n JOIN d USING (doc_id) WHERE NOT held_out GROUP BY ALL), l AS (SELECT lang, ln(coalesce(sum(n), 0) + {BUCKETS}.0::DOUBLE) AS total FROM (SELECT DISTINCT lang FROM d WHERE NOT held_out) LEFT JOIN m USING (lang) GROUP BY ALL),
w AS (SELECT lang, b, round((ln(n + 1.0::DOUBLE) - total) * {SCALE})::BIGINT - round(-total * {SCALE})::BIGINT AS more FROM m JOIN l USING (lang)),
z AS (SELECT doc_id, lang, sum(n) AS n_grams, sum(n) * any_value(round(-total * {SCALE})::BIGINT) AS base FROM n, l GROUP BY ALL), k AS (SELECT doc_id, w.lang, sum(n * more) AS more FROM n JOIN w USING (b) GROUP BY ALL),
s AS (SELECT z.doc_id, z.lang, n_grams, base + coalesce(more, 0) AS score, row_number() OVER (PARTITION BY z.doc_id ORDER BY base + coalesce(more, 0) DESC, z.lang) AS r FROM z LEFT JOIN k ON k.doc_id = z.doc_id AND k.lang = z.lang)
SELECT d.doc_id, d.lang, held_out, coalesce(a.lang, 'es') AS predicted, coalesce(a.score - b.score, 0)::BIGINT AS margin, coalesce(a.n_grams, 0)::BIGINT AS n_grams FROM d LEFT JOIN s a ON a.doc_id = d.doc_id AND a.r = 1 LEFT JOIN s b ON b.doc_id = d.doc_id AND b.r = 2"""

# The longest common subsequence bit by bit: a letter's places in the entry as a number, one step a letter of the name.
_PLACES = "list_transform(string_split(name, ''), lambda c: list_sum(list_transform(range(length(entry)), lambda i: CASE WHEN entry[i + 1] = c THEN 1::BIGINT << i::INT ELSE 0 END))::BIGINT)"
_FULL = "((1::BIGINT << length(entry)) - 1)"
_COMMON = f"(length(entry) - bit_count(list_reduce(list_concat([{_FULL}], {_PLACES}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {_FULL})))"
_FUZZY = f"""WITH n AS (SELECT DISTINCT lower(trim(CASE WHEN p_partkey % 2 = 0 THEN x ELSE x || 'qz' END)) AS name FROM (SELECT p_partkey, substring(p_name, 1, p_partkey % length(p_name)) || substring(p_name, p_partkey % length(p_name) + 2) AS x FROM part)),
e AS (SELECT lower(trim(p_name)) AS entry, min(p_partkey) AS position, arg_min(p_type, p_partkey) AS category FROM part WHERE length(p_name) % 4 <> 0 GROUP BY 1), c AS (SELECT name, entry, position, category, 2 * {_COMMON} / (length(name) + length(entry)) AS ratio FROM n JOIN e ON abs(length(name) - length(entry)) <= 5)
SELECT name, entry, category, ratio FROM c WHERE ratio >= 0.85 QUALIFY row_number() OVER (PARTITION BY name ORDER BY ratio DESC, position) = 1"""


def _metrics(hits: str, truth: str, k: int) -> str:
    return f"""top AS (SELECT * FROM {hits} WHERE rank <= {k}), fo AS (SELECT t.query_id, count(*) AS h, min(rank) AS first FROM top t JOIN {truth} x ON t.query_id = x.query_id AND t.doc_id = x.doc_id GROUP BY 1),
sh AS (SELECT query_id, count(*) AS shown FROM top GROUP BY 1), si AS (SELECT query_id, count(*) AS rel FROM {truth} GROUP BY 1),
pq AS (SELECT si.query_id, coalesce(h, 0) / least(coalesce(shown, {k}), {k}) AS p, coalesce(h, 0) / rel AS r, (coalesce(h, 0) > 0)::INT AS hit, coalesce(1 / first, 0) AS mrr, coalesce(h, 0) / least(rel, {k}) AS np, coalesce(h, 0) AS nr FROM si LEFT JOIN fo USING (query_id) LEFT JOIN sh USING (query_id))
SELECT round_even(avg(p), 4) AS mean_precision, round_even(avg(r), 4) AS mean_recall, round_even(avg(hit), 4) AS mean_hit, round_even(avg(mrr), 4) AS mean_mrr, round_even(avg(np), 4) AS mean_normalised_precision, round_even(avg(nr), 2) AS mean_n_relevant, count(*) AS n_queries FROM pq"""


_LABELS = f"{_DENSE}, lh AS (SELECT query_id, rank, label AS doc_id FROM dense JOIN v USING (doc_id)), lt AS (SELECT v.doc_id // 100 AS query_id, label AS doc_id FROM v WHERE v.doc_id % 100 = 0)"
_FIRST = "l1 AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY min(rank)) AS rank FROM lh GROUP BY 1, 2)"
_ATTR = "attr AS (SELECT doc_id, lang, source, 'q' || quality AS q, 't' || toxic AS t FROM documents LEFT JOIN labels USING (doc_id))"
_TRANSLATE = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in DICTIONARY.items()) + "}"
_OVER = "hw AS (SELECT query_id, doc_id, score, label, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rk FROM sc)"
_INSIDE = "{src} x JOIN s1 ON x.query_id = s1.query_id AND x.label = s1.doc_id"

# Records made from parts: r has each part's key and what its record and document say.
_DATE = f"CASE WHEN ms IS NULL OR ms = -1 THEN '' ELSE lpad(day(t)::VARCHAR, 2, '0') || ' de ' || {MONTHS!r}[month(t)] || ' de ' || year(t) END"
_R = f"""r0 AS (SELECT p_partkey AS k, p_partkey::VARCHAR AS id, p_name, p_brand, p_type, lower(p_brand) AS norm, p_partkey % 17 > 0 AS m, CASE p_partkey % 4 WHEN 0 THEN -1 WHEN 1 THEN NULL ELSE 900000000000 + p_partkey * 40000000000 % 700000000000 END AS ms FROM part WHERE p_partkey % 13 > 0),
r1 AS (SELECT *, make_timestamptz(ms * 1000) AT TIME ZONE 'Europe/Madrid' AS t FROM r0), r AS (SELECT *, {_DATE} AS fecha, CASE WHEN k % 3 > 0 THEN 'Lab ' || p_brand ELSE '' END AS lab, CASE WHEN k % 5 > 0 THEN p_type || ' base' ELSE '' END AS base, CASE WHEN k % 2 = 0 THEN 'agua' ELSE '' END AS excip, CASE WHEN k % 6 <> 5 THEN 'polvo' ELSE '' END AS forma, CASE WHEN k % 2 = 0 THEN 'receta' ELSE '' END AS disp, CASE WHEN k % 3 = 0 THEN 'uso externo' ELSE '' END AS adm, CASE WHEN m AND k % 3 > 0 THEN norm || CASE WHEN k % 3 = 2 THEN ', Perro' ELSE '' END ELSE 'texto ' || p_type END AS species FROM r1)"""
_NL = "chr(10)"
_ESSENTIAL = f"""concat_ws({_NL}, 'ID: ' || id, 'Medicamento: ' || p_name, 'Laboratorio: ' || lab, 'Autorización: ' || fecha, 'Especies: ' || CASE WHEN m AND k % 3 = 2 THEN norm || ', Perros (Perro)' ELSE species END,
CASE WHEN k % 2 = 0 THEN 'Códigos ATC: Q' || (k % 7) || ': ' || p_type || ' (Nivel 1); QA' || (k % 7) || ': ' || p_brand || ' (Nivel 2)' END,
CASE WHEN m AND k % 4 > 0 THEN 'Principios activos: ' || p_type || ' (5 mg)' || CASE WHEN k % 4 = 3 THEN '; ' || p_name ELSE '' END WHEN base <> '' THEN 'Principios activos: ' || base END,
CASE WHEN forma <> '' THEN 'Forma farmacéutica: ' || forma END, CASE WHEN m AND k % 5 > 0 THEN 'Vías de administración: oral' END, CASE WHEN k % 7 = 0 THEN 'Antibiótico: Sí' ELSE 'Antibiótico: No' END,
CASE WHEN m AND k % 2 = 1 THEN 'Indicaciones: ' || p_type || ' (' || norm || '); ' || p_name || ' (' || norm || ')' WHEN m AND k % 6 > 0 THEN 'Indicaciones: ' || p_type || ' (' || norm || '); otra (' || norm || '); ' || p_name || ' (General)' END,
CASE WHEN m AND k % 4 = 1 THEN 'Contraindicaciones: ' || p_name WHEN m AND k % 4 = 2 THEN 'Contraindicaciones: ' || p_type || ' (' || norm || '); ' || p_name WHEN m AND k % 4 = 3 THEN 'Contraindicaciones: ' || p_name || ' (' || norm || '). No usar en: Gato' END,
CASE WHEN disp <> '' THEN 'Dispensación: ' || disp END, CASE WHEN adm <> '' THEN 'Administración: ' || adm END)"""
_COMPLETE = f"""concat_ws({_NL}, 'Ficha técnica: ' || p_name, 'Enlace: https://example.org/' || id || '/FT_' || id || '.pdf', 'Laboratorio titular: ' || lab, 'Fecha de primera autorización: ' || fecha, 'Especies de destino: ' || species,
'Códigos ATC:' || {_NL} || CASE WHEN k % 2 = 0 THEN '- Q' || (k % 7) || ': ' || p_type || ' (Nivel 1)' || {_NL} || '- QA' || (k % 7) || ': ' || p_brand || ' (Nivel 2)' ELSE '' END, 'Principios activos: ' || base,
CASE WHEN m AND k % 4 > 0 THEN 'Principios activos detallados:' || {_NL} || '- ' || p_type || ': 5 mg' || CASE WHEN k % 4 = 3 THEN {_NL} || '- ' || p_name || ':  ' ELSE '' END END,
'Excipientes: ' || excip, 'Forma farmacéutica: ' || forma, 'Condiciones de dispensación: ' || disp, 'Condiciones de administración: ' || adm, 'Este medicamento' || CASE WHEN k % 7 = 0 THEN '' ELSE ' no' END || ' es un antibiótico.',
CASE WHEN m AND k % 5 > 0 THEN 'Vías de administración:' || {_NL} || '- oral' || CASE WHEN k % 5 = 4 THEN {_NL} || '- ' ELSE '' END END,
CASE WHEN m AND k % 6 > 0 THEN 'Indicaciones:' || {_NL} || 'Indicaciones para ' || norm || ':' || {_NL} || '- ' || p_type || {_NL} || CASE WHEN k % 2 = 1 THEN '- ' || p_name || {_NL} ELSE '- otra' || {_NL} || 'Indicaciones para :' || {_NL} || '- ' || p_name || {_NL} END END,
CASE WHEN m AND k % 4 > 0 THEN 'Contraindicaciones:' || {_NL} || CASE k % 4 WHEN 1 THEN '- ' || p_name || {_NL} WHEN 2 THEN '- ' || p_name || {_NL} || 'Contraindicaciones para ' || norm || ':' || {_NL} || '- ' || p_type || {_NL} ELSE 'Contraindicaciones para ' || norm || ':' || {_NL} || '- ' || p_name || {_NL} || 'No usar en las siguientes especies:' || {_NL} || '- Gato' || {_NL} END END,
CASE WHEN m AND k % 3 > 0 THEN 'Reacciones adversas:' || {_NL} || CASE k % 3 WHEN 1 THEN '- ' || p_type || ' (Rara)' || {_NL} ELSE '- ' || p_type || {_NL} || 'En ' || norm || ':' || {_NL} || '- ' || p_name || {_NL} END END,
CASE WHEN m AND k % 3 = 0 THEN 'Interacciones:' || {_NL} || '- ' || p_name || {_NL} WHEN m AND k % 3 = 1 THEN 'Interacciones:' || {_NL} || 'En ' || norm || ':' || {_NL} || '- ' || p_type || {_NL} || '- x' || {_NL} END,
CASE WHEN m AND k % 3 = 0 THEN 'Tiempo de espera: 7 días' WHEN m AND k % 3 = 1 THEN 'Tiempo de espera:' || {_NL} || 'En ' || norm || ':' || {_NL} || '- Carne: 5 días' || {_NL} || 'En vaca:' || {_NL} || '- Leche: 2 horas' || {_NL} END,
CASE WHEN m AND k % 2 = 0 THEN 'Presentaciones:' || {_NL} || '- caja' || {_NL} || '- bote' END, '-----')"""
_FALLBACK = f"concat_ws({_NL}, 'ID: ' || id, 'Medicamento: ' || p_name, 'Laboratorio: ' || lab, 'Autorización: ' || fecha, 'Especies: ' || species, 'Principios activos: ' || base)"
_RESHAPED = "ri AS (SELECT p_partkey AS k, p_brand AS especie, p_type AS nombre, 0 AS o FROM part WHERE p_partkey % 17 > 0 AND p_partkey % 6 > 0 UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 2 = 1 THEN p_brand ELSE 'All' END, p_name, 1 FROM part WHERE p_partkey % 17 > 0 AND p_partkey % 6 > 0 UNION ALL SELECT p_partkey, p_brand, 'otra', 2 FROM part WHERE p_partkey % 17 > 0 AND p_partkey % 6 > 0 AND p_partkey % 2 = 0), rs AS (SELECT k, especie, list(nombre ORDER BY o) AS nombres FROM ri GROUP BY 1, 2)"


def _pattern(patterns: tuple[str, ...], group: int, line: str = "line") -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN regexp_matches({line}, '{p}') THEN regexp_extract({line}, '{p}', {group}) END" for p in patterns) + ")"


# Headed documents: md has each document's text with headings, hd their places, sr the sections with what they hold.
_HEAD = "CASE (i - 1) % 3 WHEN 0 THEN '**' || (((i - 1) // 3) % 12 + 1) || '. TITULO:**' WHEN 1 THEN '**' || (((i - 1) // 3) % 12 + 1) || '.1** Especies de destino' ELSE (((i - 1) // 3) % 12 + 1) || '.2 Otra' END"
_MD = f"md AS (SELECT doc_id AS document_id, array_to_string(list_transform(string_split(replace(text, '*', ''), chr(10)), lambda x, i: {_HEAD} || chr(10) || x), chr(10)) AS text FROM documents)"
_PLAIN_TITLE = f"regexp_extract(bare, '{PLAIN_SUBSECTION}', 2)"
_HD = f"""{_MD}, ln AS (SELECT document_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT document_id, string_split(text, chr(10)) AS ls FROM md)), lp AS (SELECT document_id, ls[i] AS line, trim(replace(ls[i], '**', '')) AS bare, coalesce(sum(length(ls[i]) + 1) OVER (PARTITION BY document_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS start FROM ln),
hs AS (SELECT document_id, start, start + length(line) AS "end", {_pattern(SECTION_PATTERNS, 1)} AS section, coalesce({_pattern(SUBSECTION_PATTERNS, 1)}, CASE WHEN regexp_matches(bare, '{PLAIN_SUBSECTION}') AND length(trim({_PLAIN_TITLE})) > 0 AND NOT regexp_matches(lower(trim({_PLAIN_TITLE})), '{UNIT}') THEN regexp_extract(bare, '{PLAIN_SUBSECTION}', 1) END) AS sub, {_pattern(SECTION_PATTERNS, 2)} AS st, coalesce({_pattern(SUBSECTION_PATTERNS, 2)}, {_PLAIN_TITLE}) AS ut FROM lp),
hk AS (SELECT document_id, start, "end", CASE WHEN section IS NOT NULL THEN 'section' ELSE 'subsection' END AS kind, coalesce(section, sub) AS id, trim(regexp_replace(trim(replace(CASE WHEN section IS NOT NULL THEN st ELSE ut END, '**', '')), ':$', '')) AS title FROM hs WHERE coalesce(section, sub) IS NOT NULL),
hd AS (SELECT document_id, kind, id, CASE WHEN kind = 'subsection' THEN split_part(id, '.', 1) END AS parent, title, start, "end" FROM hk WHERE try_cast(split_part(id, '.', 1) AS INT)::VARCHAR = split_part(id, '.', 1) AND split_part(id, '.', 1)::INT BETWEEN 1 AND 10 AND (kind = 'section' OR split_part(id, '.', 2)::INT <= 15))"""
_SR = rf"""{_HD}, nx AS (SELECT *, min(CASE WHEN kind = 'section' THEN start END) OVER (PARTITION BY document_id ORDER BY start ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ns, lead(start) OVER (PARTITION BY document_id, kind, parent ORDER BY start) AS nb, lead(start) OVER (PARTITION BY document_id ORDER BY start) AS na FROM hd),
st AS (SELECT *, CASE WHEN kind = 'section' THEN least(ns, na) ELSE least(nb, ns) END AS stop FROM nx), bd AS (SELECT st.* EXCLUDE (stop), regexp_replace(trim(substring(text, ("end" + 2)::BIGINT, greatest(coalesce(stop, length(text) + 1) - "end" - 1, 0)::BIGINT)), '^\s+|\s+$', '', 'g') AS content FROM st JOIN md USING (document_id)),
la AS (SELECT document_id, kind, id, parent, title, content FROM bd QUALIFY row_number() OVER (PARTITION BY document_id, kind, id ORDER BY start DESC) = 1),
sr AS (SELECT * FROM la UNION ALL SELECT DISTINCT document_id, 'section', parent, NULL, 'SECCIÓN ' || parent, '' FROM la WHERE kind = 'subsection' AND NOT EXISTS (SELECT 1 FROM la s WHERE s.document_id = la.document_id AND s.kind = 'section' AND s.id = la.parent))"""
_WRAP = "'Nombre del Medicamento: doc ' || s.document_id || chr(10) || chr(10) || {head} || chr(10) || {body} || chr(10) || '-----'"
_CHUNK_SQL = f"""SELECT s.document_id || '@' || s.id AS chunk_id, s.document_id, 'section' AS chunk_type, s.title, s.document_id || '@full' AS parent_id, s.title AS path, {_WRAP.format(head="s.id || '. ' || s.title", body='s.content')} AS text FROM sr s WHERE kind = 'section'
UNION ALL SELECT s.document_id || '@' || u.id, s.document_id, 'subsection', u.title, s.document_id || '@' || s.id, s.title || ' > ' || u.title, {_WRAP.format(head="s.id || '. ' || s.title || ' - ' || u.id || ' ' || u.title", body='u.content')} FROM sr s JOIN sr u ON u.document_id = s.document_id AND u.kind = 'subsection' AND u.parent = s.id WHERE s.kind = 'section'"""
_CLEANED = r"trim(regexp_replace(CASE WHEN length({x}) > 50 THEN trim(string_split({x}, '.')[1]) ELSE {x} END, '[.,;:()\[\]]$', ''))"
_SPECIES_SQL = f"""WITH {_SR}, nm AS (SELECT document_id, max(CASE WHEN id = '3.1' THEN content END) AS a, first(content ORDER BY split_part(id, '.', 1)::INT, split_part(id, '.', 2)::INT) AS b FROM sr WHERE kind = 'subsection' AND contains(lower(title), 'especie') AND contains(lower(title), 'destino') GROUP BY 1),
fl AS (SELECT document_id, trim(string_split(coalesce(a, b), chr(10))[1]) AS x FROM md LEFT JOIN nm USING (document_id)) SELECT document_id, coalesce({_CLEANED.format(x='x')}, '') AS especies_destino FROM fl"""
_CORPUS = r"list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?s)```.*?```', ' ', 'g'), '`[^`]*`', ' ', 'g'), 'https?://\S+|www\.\S+', ' ', 'g'), '<[^>]+>', ' ', 'g')), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\p{Nd}+', '', 'g')), '\s+'), lambda x: x <> '')"
_AT = "instr(low, t)"
_LEFT = f"substring(text, greatest({_AT} - 40, 1), {_AT} - greatest({_AT} - 40, 1))"
_RIGHT = f"substring(text, {_AT} + length(t), 40)"
_BEFORE = "coalesce(" + ", ".join(f"CASE WHEN contains({_LEFT}, {c}) THEN string_split({_LEFT}, {c})[-1] END" for c in ("'.'", "'!'", "'?'", "chr(10)")) + f", {_LEFT})"
_AFTER = "coalesce(" + ", ".join(f"CASE WHEN contains({_RIGHT}, {c}) THEN string_split({_RIGHT}, {c})[1] || {c} END" for c in ("'.'", "'!'", "'?'", "chr(10)")) + f", {_RIGHT})"
_PLACE = rf"'TOKEN ' || chr(39) || t || chr(39) || ':' || chr(10) || '...' || regexp_replace({_BEFORE}, '^\s+', '') || '[' || upper(replace(substring(text, {_AT}, length(t)), 'ß', 'ss')) || ']' || regexp_replace({_AFTER}, '\s+$', '') || '...' || chr(10)"
_SNIPPETS = f"""WITH {_bm25('okapi', 3)}, tm AS (SELECT query_id, list_sort(list(DISTINCT term)) AS terms FROM qt GROUP BY 1), hx AS (SELECT query_id, rank, doc_id, text, lower(text) AS low, list_filter(terms, lambda x: length(x) >= 3) AS asked FROM sparse JOIN documents USING (doc_id) JOIN tm USING (query_id)),
ex AS (SELECT query_id, rank, doc_id, t, i, text, low FROM (SELECT *, unnest(asked) AS t, unnest(range(1, len(asked) + 1)) AS i FROM hx) WHERE contains(low, t)), fx AS (SELECT query_id, rank, doc_id, count(*) AS n, string_agg({_PLACE}, chr(10) ORDER BY i) AS body FROM ex GROUP BY 1, 2, 3)
SELECT query_id, rank, doc_id, CASE WHEN n > 0 THEN 'Found ' || n || ' of ' || len(asked) || ' query tokens:' || chr(10) || chr(10) || body WHEN length(text) > 300 THEN 'No matches for query tokens. Preview:' || chr(10) || substring(text, 1, 300) || '...' ELSE 'No matches for query tokens. Content:' || chr(10) || text END AS snippet FROM hx LEFT JOIN fx USING (query_id, rank, doc_id)"""
_PACKED = f"""{_bm25('okapi', 10)}, pk AS (SELECT * FROM (SELECT query_id, rank, s.doc_id, text, sum(len(regexp_extract_all(text, '{_W}'))) OVER (PARTITION BY query_id ORDER BY rank) AS used FROM sparse s JOIN documents USING (doc_id)) WHERE used <= 3500), cx AS (SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context, string_agg(doc_id::VARCHAR, ',' ORDER BY rank) AS doc_ids FROM pk GROUP BY 1)"""
# 2 * longest common subsequence / total length, by rows of the usual table.
_LCS = "list_reduce(list_prepend([0 for _ in range(length(b) + 1)], [[x] for x in range(1, length(a) + 1)]), lambda prev, x: list_reduce(list_prepend([0], [[j] for j in range(1, length(b) + 1)]), lambda row, j: list_append(row, greatest(row[-1], prev[j[1] + 1], CASE WHEN a[x[1]] = b[j[1]] THEN prev[j[1]] + 1 ELSE 0 END))))[-1]"
_FOLDED_DOC = f"list_filter(regexp_extract_all({_FOLD.format('lower(text)')}, '{_W}'), lambda x: x NOT IN ('the', 'de', 'la', 'and'))"
_NORMALISED = _bm25("okapi", 10).replace(_ALL, _FOLDED_DOC)
_FILE = "'# ' || n_name || chr(10) || repeat('é', n_nationkey)"
_PATHS = r"p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'C:\data\' ELSE '/data/' END || 'f' || o_orderkey || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '.tar.gz' ELSE '/' END AS path FROM orders), l AS (SELECT o_orderkey, 'f' || o_orderkey || CASE o_orderkey % 3 WHEN 1 THEN '.tar.gz' ELSE '' END AS leaf FROM p)"
_LINK = r"""list_filter(list_transform(regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), lambda x: trim(x, chr(34) || chr(39))), lambda x: contains(x, 'th'))[1]"""
_MAPPED = "SELECT n_nationkey::BIGINT AS position, lower(n_name) AS entry, CASE WHEN n_name = 'NATION_3' THEN 'changed' ELSE 'r' || n_regionkey END AS category FROM nation UNION ALL SELECT (SELECT max(n_nationkey) + 1 FROM nation), 'new land', 'new'"
_CONTEXT = f"""{_RESHAPED}, pm AS (SELECT p_partkey AS k, p_partkey::VARCHAR AS id, p_name, p_brand, p_type FROM part WHERE p_partkey % 17 > 0), lines AS (SELECT pm.*, CASE WHEN pm.k % 3 = 0 THEN '' WHEN pm.k % 3 = 1 THEN p_brand ELSE p_brand || ', Perros' END AS species, CASE WHEN pm.k % 3 > 0 THEN array_to_string(rs.nombres, ', ') END AS said FROM pm LEFT JOIN rs ON rs.k = pm.k AND rs.especie = pm.p_brand),
bk AS (SELECT id, p_brand, 'Nombre: ' || p_name || {_NL} || 'Especies: ' || species || {_NL} || 'Indicaciones por especie:' || {_NL} || coalesce('  - ' || p_brand || ': ' || said, '  - No especificadas') || {_NL} || 'Antibiótico: ' || CASE WHEN k % 7 = 0 THEN 'Antibióticos:' || {_NL} || '  - Principio activo: ' || p_type || {_NL} || '    Familia: ' || p_brand || {_NL} || '    Categoría: B' ELSE 'Este medicamento no contiene antibióticos.' END || {_NL} || 'Vías: ' || CASE k % 5 WHEN 0 THEN '' WHEN 4 THEN 'oral, ' ELSE 'oral' END AS block FROM lines),
al AS (SELECT p_brand AS value, p_partkey::VARCHAR AS id, count(*) OVER (PARTITION BY p_brand) AS n FROM part), ch AS (SELECT value, id FROM al WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY value ORDER BY sha256(id || ':0'), id) <= 10)
SELECT value, count(*)::INT AS n_blocks, string_agg(block, chr(10) || chr(10) ORDER BY id) AS context FROM ch JOIN bk USING (id) GROUP BY 1"""
_NESTED = """SELECT c_custkey, 0 AS at, 'Gatos ' AS nombre, NULL AS especie, true AS es_especie, 'Gato' AS nombre_normalizado FROM customer UNION ALL SELECT c_custkey, 1, 'fiebre', CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Machine' ELSE c_mktsegment END, false, NULL FROM customer UNION ALL SELECT c_custkey, 2, c_mktsegment, NULL, c_mktsegment = 'MACHINERY', CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Machine' END FROM customer"""

_GENERATED = "ts AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM tok GROUP BY 1), n AS (SELECT count(*) AS n FROM documents), sc AS (SELECT term, round(tf / (SELECT sum(tf) FROM ts) * ln(n / df), 12) AS score FROM ts, n WHERE df > 1), lo AS (SELECT term FROM (SELECT term, row_number() OVER (ORDER BY score, term) AS r FROM sc) WHERE r <= greatest(10, floor(0.2 * (SELECT count(*) FROM sc))) AND length(term) > 1), co AS (SELECT term FROM ts, n WHERE df >= greatest(2, n // 2) AND length(term) > 1)"
_PARSED_MD = "pf AS (SELECT document_id AS k, CASE WHEN document_id % 5 = 0 THEN 'EU/2/24/' || document_id WHEN document_id % 7 = 0 THEN 'X' || document_id ELSE document_id || ' ESP' END AS document_id, CASE WHEN document_id % 9 = 0 THEN ' ' WHEN document_id % 5 = 0 THEN text || chr(10) || '**10. FECHA**' || chr(10) || 'x' || chr(10) ELSE text END AS text FROM md0), md AS (SELECT * FROM pf WHERE trim(text) <> '')"
_PARSED = f"WITH {_MD.replace('md AS', 'md0 AS', 1)}, {_PARSED_MD}, {_SR[len(_MD) + 2:]}, tr AS (SELECT document_id, string_agg(id, ',' ORDER BY id::INT) AS detail FROM sr WHERE kind = 'section' GROUP BY 1) SELECT md.document_id, coalesce(detail, '') AS detail, true AS kept FROM md LEFT JOIN tr USING (document_id) WHERE k % 5 = 0 OR k % 7 > 0 UNION ALL SELECT document_id, 'no content', false FROM pf WHERE trim(text) = '' UNION ALL SELECT document_id, 'no master record', false FROM md WHERE k % 5 > 0 AND k % 7 = 0"

SQL = {
    "text_normalize": f"SELECT doc_id, (i - 1)::INT AS pos, toks[i] AS term FROM (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM (SELECT doc_id, list_filter(regexp_extract_all({_FOLD.format('lower(text)')}, '{_W}'), lambda x: x NOT IN ('the', 'de', 'la', 'and')) AS toks FROM documents))",
    "token_df_tf": f"WITH {_TOK} SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM tok GROUP BY 1",
    "accents_fold": f"SELECT doc_id, {_FOLD.format('text')} AS folded FROM documents",
    "dict_translate": rf"SELECT doc_id, CASE WHEN lang = 'es' THEN text ELSE array_to_string(list_transform(list_filter(regexp_split_to_array(trim(lower(text)), '\s+'), lambda x: x <> ''), lambda w: coalesce(element_at({_TRANSLATE}, w)[1], w)), ' ') END AS translated FROM documents",
    "language_detect": _LANGUAGE,
    "language_route": "SELECT lang AS language, count(*) AS n FROM documents GROUP BY 1",
    "stopwords_generated": f"WITH {_TOK}, {_GENERATED} SELECT DISTINCT {_FOLD.format('term')} AS term FROM (SELECT * FROM lo UNION SELECT * FROM co UNION SELECT 'el' UNION SELECT 'mas')",
    "bm25_okapi_topk": f"WITH {_bm25('okapi', 10)} SELECT query_id, rank, doc_id, score FROM sparse",
    "bm25_incremental_topk": f"WITH {_bm25('okapi', 10)} SELECT query_id, rank, doc_id, score FROM sparse",
    "bm25_pruned_topk": f"WITH {_bm25('okapi', 10)} SELECT query_id, rank, doc_id, score FROM sparse",
    "bm25_l_topk": f"WITH {_bm25('l', 10)} SELECT query_id, rank, doc_id, score FROM sparse",
    "bm25_plus_topk": f"WITH {_bm25('plus', 10)} SELECT query_id, rank, doc_id, score FROM sparse",
    "bm25_threshold": f"WITH {_bm25('okapi', 50)} SELECT query_id, rank, doc_id, score FROM sparse WHERE score >= 8",
    "bm25_normalised_topk": f"WITH {_NORMALISED} SELECT query_id, rank, doc_id, score FROM sparse",
    "bm25_stored_topk": f"WITH {_bm25('plus', 10)} SELECT query_id, rank, doc_id, score FROM sparse",
    "corpus_tokens": f"SELECT doc_id, (i - 1)::INT AS pos, toks[i] AS term FROM (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM (SELECT doc_id, {_CORPUS} AS toks FROM documents))",
    "spanish_dates": f"SELECT event_id, {_DATE} AS fecha FROM (SELECT event_id, epoch_ms(ts) AS ms, make_timestamptz(epoch_ms(ts) * 1000) AT TIME ZONE 'Europe/Madrid' AS t FROM events)",
    "snippets": _SNIPPETS,
    "rag_answers": f"WITH {_PACKED} SELECT item_id AS query_id, coalesce(substring(string_split(context, '. ')[1], 1, 200), '') AS generated_answer, doc_ids, length(context)::INT AS context_length, NULL::VARCHAR AS error FROM benchmark LEFT JOIN cx ON query_id = item_id",
    "late_fusion_worst": _fusion(0.5, "max"),
    "late_fusion_best": _fusion(0.2, "min"),
    "late_fusion_balanced": _BALANCED,
    "late_fallback": f"WITH {_bm25('okapi', 50)}, {_V}, {_top('sc', 20, 'dc')}, dense AS (SELECT query_id, rank, doc_id AS chunk_id, doc_id // 4 AS doc_id, score FROM dc), un AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS o FROM sparse s WHERE NOT EXISTS (SELECT 1 FROM dense d WHERE d.query_id = s.query_id AND d.doc_id = s.doc_id)), ex AS (SELECT un.query_id, sc.doc_id AS chunk_id, un.doc_id, sc.score, o, row_number() OVER (PARTITION BY un.query_id, un.doc_id ORDER BY sc.score DESC, sc.doc_id) AS i FROM un JOIN sc ON sc.query_id = un.query_id AND sc.doc_id // 4 = un.doc_id WHERE o <= 10), al AS (SELECT query_id, chunk_id, doc_id, score, 'dense' AS source, 0 AS p, rank AS o, 0 AS i FROM dense UNION ALL SELECT query_id, chunk_id, doc_id, score, 'fallback', 1, o, i FROM ex WHERE i <= 2) SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY p, o, i) AS rank, chunk_id, doc_id, score, source FROM al",
    "fallback_coverage": f"WITH {_bm25('okapi', 50)}, {_V}, {_CHUNKS50}, de AS (SELECT DISTINCT query_id, doc_id FROM dense) SELECT s.query_id, count(*) AS n_sparse, count(*) FILTER (WHERE d.doc_id IS NULL) AS n_uncovered FROM sparse s LEFT JOIN de d ON d.query_id = s.query_id AND d.doc_id = s.doc_id GROUP BY 1",
    "uncovered_chunks": f"WITH {_bm25('okapi', 50)}, {_V}, {_CHUNKS50} SELECT s.query_id, s.doc_id, (SELECT count(*) FROM v WHERE v.doc_id // 4 = s.doc_id) AS n_chunks FROM sparse s WHERE NOT EXISTS (SELECT 1 FROM dense d WHERE d.query_id = s.query_id AND d.doc_id = s.doc_id)",
    "vector_index_statistics": "SELECT count(DISTINCT vec_id // 4) AS n_documents, count(*) AS n_chunks, count(*) FILTER (WHERE vec_id % 3 > 0) AS n_texts, max(len(embedding))::INT AS dimension FROM embeddings",
    "vector_look_up": "SELECT vec_id AS chunk_id, vec_id // 4 AS doc_id, CASE WHEN vec_id % 3 > 0 THEN 'chunk ' || vec_id ELSE '' END AS text, 'document ' || vec_id // 4 AS document, round(embedding[1]::DOUBLE, 6) AS x FROM embeddings WHERE vec_id BETWEEN 5 AND 59 AND (vec_id - 5) % 7 = 0",
    "inverted_grouping": f"WITH {_ATTR} SELECT * FROM (SELECT t AS value, count(*) OVER (PARTITION BY t) AS n_ids, doc_id::VARCHAR AS id FROM attr WHERE t IS NOT NULL) WHERE n_ids >= 2",
    "nested_reshape": f"""WITH {_RESHAPED} SELECT k::VARCHAR AS nregistro, CASE WHEN k % 7 = 0 THEN '[{{"categoria":"B","familia":"' || p_brand || '","principio":"' || p_type || '"}}]' ELSE 'No' END AS antibiotico, especie, array_to_string(nombres, '|') AS nombres FROM rs JOIN part ON p_partkey = k""",
    "document_assembly": f"WITH {_R} SELECT id AS document_id, p_name AS nombre_medicamento, 'https://example.org/' || id || '/FT_' || id || '.pdf' AS url, lab AS laboratorio_titular, fecha AS fecha_primera_autorizacion, base AS principios_activos, excip AS excipientes, forma AS forma_farmaceutica, disp AS condiciones_dispensacion, adm AS condiciones_administracion, k % 7 = 0 AS es_antibiotico, CASE WHEN m AND k % 3 = 0 THEN '7 días' ELSE '' END AS tiempo_espera_texto, CASE WHEN k % 2 = 0 THEN 2 ELSE 0 END AS n_codigos_atc, CASE WHEN m THEN k % 3 ELSE 0 END::INT AS n_especies_registro, CASE WHEN NOT m OR k % 6 = 0 THEN 0 WHEN k % 2 = 1 THEN 2 ELSE 3 END AS n_indicaciones, CASE WHEN NOT m OR k % 4 = 0 THEN 0 WHEN k % 4 = 1 THEN 1 ELSE 2 END AS n_contraindicaciones, CASE WHEN m THEN k % 3 ELSE 0 END::INT AS n_reacciones_adversas, CASE WHEN NOT m OR k % 3 = 2 THEN 0 WHEN k % 3 = 0 THEN 1 ELSE 2 END AS n_interacciones, CASE WHEN m AND k % 3 = 1 THEN 2 ELSE 0 END AS n_tiempo_espera, CASE WHEN m AND k % 2 = 0 THEN 2 ELSE 0 END AS n_presentaciones, 2 AS n_secciones FROM r",
    "unmatched_documents": "SELECT 'EU-2-24-' || p_partkey AS document_id, 'no master record' AS reason, 'eu' AS kind FROM part WHERE p_partkey < 5",
    "catalogue_names": "SELECT p_partkey::VARCHAR AS nregistro, p_name AS nombre FROM part WHERE p_partkey % 11 > 0",
    "essential_text": f"WITH {_R} SELECT id AS document_id, {_ESSENTIAL} AS essential FROM r",
    "complete_text": f"WITH {_R} SELECT id AS document_id, {_COMPLETE} AS text FROM r",
    "essential_fallback": f"WITH {_R} SELECT id AS document_id, CASE WHEN k % 2 = 0 THEN 'text of ' || id ELSE {_FALLBACK} END AS essential, k % 2 = 1 AS made FROM r",
    "record_chunks": f"WITH {_R} SELECT id || '@1' AS chunk_id, id AS document_id, 'section' AS chunk_type, 'NOMBRE' AS title, id || '@full' AS parent_id, 'NOMBRE' AS path, 'Nombre del Medicamento: ' || p_name || {_NL} || {_NL} || '1. NOMBRE' || {_NL} || p_name || {_NL} || '-----' AS text FROM r UNION ALL SELECT id || '@3', id, 'section', 'DATOS', id || '@full', 'DATOS', 'Nombre del Medicamento: ' || p_name || {_NL} || {_NL} || '3. DATOS' || {_NL} || {_NL} || '-----' FROM r UNION ALL SELECT id || '@3.1', id, 'subsection', 'Especies de destino', id || '@3', 'DATOS > Especies de destino', 'Nombre del Medicamento: ' || p_name || {_NL} || {_NL} || '3. DATOS - 3.1 Especies de destino' || {_NL} || p_brand || {_NL} || '-----' FROM r",
    "antibiotic_details": "WITH c AS (SELECT 'C' || s_suppkey % 40 AS code, 'cat' || s_suppkey || '/fam' || s_nationkey || '/' || s_name AS d FROM supplier QUALIFY row_number() OVER (PARTITION BY s_suppkey % 40 ORDER BY s_name) = 1), x AS (SELECT p_partkey, 0 AS o, 'C' || p_partkey % 50 AS code FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 1, 'C' || p_size FROM part WHERE p_partkey % 3 = 0), f AS (SELECT p_partkey, string_agg(d, ',' ORDER BY o) AS d FROM x JOIN c USING (code) GROUP BY 1) SELECT p.p_partkey::VARCHAR AS nregistro, p.p_partkey % 3 = 0 AS is_antibiotic, coalesce(d, '') AS antibiotico FROM part p LEFT JOIN f USING (p_partkey)",
    "nested_names": _NESTED,
    "record_contexts": f"WITH {_CONTEXT}",
    "heading_parse": f"WITH {_HD} SELECT * FROM hd",
    "section_parse": f"WITH {_SR} SELECT * FROM sr",
    "chunk_flatten": f"WITH {_SR} {_CHUNK_SQL}",
    "species_lookup": _SPECIES_SQL,
    "path_parts": rf"WITH {_PATHS} SELECT o_orderkey, leaf, regexp_replace(leaf, '\.[^.]*$', '') AS stem, regexp_extract(leaf, '\.[^.]*$') AS extension FROM l",
    "text_tools": rf"SELECT doc_id, regexp_replace(translate({_FOLD.format('text')}, 'ñçÑÇ', 'ncNC'), '[^a-zA-Z .,;'']', '', 'g') AS letters, array_to_string(list_filter(regexp_split_to_array(trim(lower(translate(text, '.,;', ''))), '\s+'), lambda x: x NOT IN ('the', 'de', '')), ' ') AS clean, trim(string_split(substring(text, 1, 30), chr(10))[-1] || string_split(substring(text, 31), chr(10))[1]) AS line, len(list_distinct(string_split(text, ' '))) <= 1 AS equal FROM documents",
    "link_extract": f"SELECT page_id, 'https://example.org' || {_LINK} AS link FROM pages",
    "interstitial_links": f"SELECT page_id::VARCHAR AS id, 'https://example.org' || {_LINK} AS link, string_split('https://example.org' || {_LINK}, '/')[-1] AS content FROM pages",
    "text_folder_scan": f"SELECT n_name AS name, {_FILE} AS content FROM nation",
    "folder_profile": f"SELECT count(*) AS files, round(sum(strlen({_FILE})) / 1000)::BIGINT AS kb FROM nation",
    "file_digests": f"SELECT n_name || '.md' AS name, sha256({_FILE}) AS sha256, strlen({_FILE}) AS size FROM nation",
    "convert_files": f"SELECT n_name AS name, CASE WHEN strlen({_FILE}) >= 12 THEN replace({_FILE}, '# ', '## ') END AS text, CASE WHEN strlen({_FILE}) < 12 THEN 'empty' END AS error FROM nation",
    "json_lines_scan": "SELECT c_custkey, c_name, c_mktsegment || '+ñ' AS tags FROM customer",
    "json_values": "SELECT event_id, (props->>'k')::BIGINT AS k FROM events",
    "catalogue_merge": "SELECT nregistro, nombre FROM (SELECT o_custkey::VARCHAR AS nregistro, o_orderkey % 20 AS page, max(o_orderkey::VARCHAR) AS nombre FROM orders GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY nregistro ORDER BY page DESC) = 1",
    "text_lines": "SELECT value, ((r - 1) // 7)::BIGINT AS batch FROM (SELECT c_name AS value, row_number() OVER (ORDER BY c_name) AS r, count(*) OVER () AS n FROM customer) WHERE r <= n // 7 * 7",
    "paged_scan": "SELECT s_suppkey, s_name FROM supplier",
    "key_look_up": """SELECT n_nationkey::VARCHAR AS nregistro, CASE WHEN n_nationkey % 2 = 0 THEN '{"nregistro": "' || n_nationkey || '", "nombre": "record ' || n_nationkey || '"}' END AS json FROM nation""",
    "mapping_round_trip": _MAPPED,
    "run_metrics": "SELECT * FROM (VALUES ('late_fusion', 'hybrid', 0.0, 0.2, 0.0, 0.5, 1), ('bm25_k50', 'bm25', 0.0, 0.0, 0.0, 0.5, 2), ('faiss_k50', 'faiss', 0.0, 0.1, 0.0, 0.5, 3), ('bm25like', 'bm25', 0.0, 0.4, 0.0, 0.5, 4)) t(run_name, method, normalised_precision, recall, hit, mrr, place)",
    "ingest_run": "WITH n AS (SELECT count(*) AS n FROM part WHERE p_partkey % 13 > 0) SELECT * FROM (SELECT 0 AS at, 'records' AS step, n AS rows, false AS skipped, n + (SELECT count(*) FROM part WHERE p_partkey < 5) AS rows_read FROM n UNION ALL SELECT 1, 'essential', n, false, n FROM n UNION ALL SELECT 2, 'chunks', 4 * n, false, n FROM n UNION ALL SELECT 3, 'vectors', 4 * n, false, 5 * n FROM n UNION ALL SELECT 4, 'keywords', 4 * n, false, 4 * n FROM n UNION ALL SELECT 5, 'answers', 0, true, 0 FROM n)",
    "species_fuzzy": _FUZZY,
    "unmapped_report": f"WITH n AS (SELECT DISTINCT lower(trim(c_mktsegment)) AS a FROM customer), e AS (SELECT * FROM (VALUES (0, 'building', 'b'), (1, 'machinerie', 'm')) t(position, b, category)), u AS (SELECT a FROM n WHERE a NOT IN (SELECT b FROM e)), s AS (SELECT a, category, position, 2 * ({_LCS}) / (length(a) + length(b)) AS ratio FROM u, e WHERE abs(length(a) - length(b)) <= 5), m AS (SELECT a, category FROM s WHERE ratio >= 0.85 QUALIFY row_number() OVER (PARTITION BY a ORDER BY ratio DESC, position) = 1) SELECT a AS name, coalesce(category, 'None') AS closest, '' AS suggestion FROM u LEFT JOIN m USING (a)",
    "species_groups": "SELECT DISTINCT source, count(*) OVER (PARTITION BY source) AS n, doc_id AS number, doc_id::VARCHAR AS doc_id FROM (SELECT DISTINCT source, doc_id FROM documents)",
    "catalogue_keys": "SELECT p_partkey::VARCHAR AS nregistro FROM part",
    "parser_run": _PARSED,
    "last_section_trim": "SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '**10. FECHA**' || chr(10) || 'x' ELSE chr(10) || '10.5 no-----' END AS text FROM documents",
    "single_stage_search": f"WITH {_V}, {_top('sc', 5, 'r')} SELECT * FROM r",
    "stopword_refresh": f"WITH tok AS (SELECT doc_id, unnest({_CORPUS}) AS term FROM documents), {_GENERATED} SELECT 'kept' AS term, false AS made UNION ALL SELECT DISTINCT {_FOLD.format('term')}, true FROM (SELECT * FROM lo UNION SELECT * FROM co UNION SELECT 'el')",
    "regenerate_decisions": "WITH c AS (SELECT count(*) FILTER (WHERE doc_id % 2 = 0 AND upper(text) <> text) / count(*) AS two, count(*) FILTER (WHERE doc_id % 3 = 0 AND upper(text) <> text) / count(*) AS three FROM documents) SELECT 1 AS every, 1.0::DOUBLE AS age, true AS again UNION ALL SELECT 2, 1.0, two >= 0.5 FROM c UNION ALL SELECT 3, 1.0, three >= 0.5 FROM c UNION ALL SELECT 3, 16.0, true UNION ALL SELECT 3, NULL, true",
    "group_questions": f"SELECT value, 'Fichas del grupo ' || chr(39) || value || chr(39) || ':' || chr(10) || chr(10) || context || chr(10) || chr(10) || 'Propón una sola pregunta en español cuya respuesta esté en estas fichas.' AS prompt, substring(string_split(context, '. ')[1], 1, 200) AS question, NULL::VARCHAR AS error FROM (WITH {_CONTEXT})",
    "dense_topk": f"WITH {_V}, {_top('sc', 10, 'r')} SELECT * FROM r",
    "dense_doc_topk": f"WITH {_V}, {_MEAN}, {_top('ds', 3, 'r')} SELECT * FROM r",
    "hierarchical_exact": f"WITH {_V}, {_MEAN}, {_top('ds', 3, 's1')}, i AS (SELECT x.query_id, x.doc_id AS chunk_id, label, x.score FROM {_INSIDE.format(src='sc')}) SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank, chunk_id, label AS doc_id, score FROM i) WHERE rank <= 10",
    "hierarchical_overfetch": f"WITH {_V}, {_MEAN}, {_top('ds', 3, 's1')}, {_OVER}, i AS (SELECT x.query_id, x.doc_id AS chunk_id, label, x.score FROM {_INSIDE.format(src='hw')} WHERE rk <= 90) SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank, chunk_id, label AS doc_id, score FROM i) WHERE rank <= 10",
    "group_mean_embedding": f"WITH {_V}, {_MEAN} SELECT label, pos::INT AS pos, round(x / n, 6) AS value FROM mv JOIN mn USING (label)",
    "context_pack": f"WITH {_bm25('okapi', 10)} SELECT * FROM (SELECT query_id, rank, s.doc_id, len(regexp_extract_all(text, '{_W}')) AS n_tokens, sum(len(regexp_extract_all(text, '{_W}'))) OVER (PARTITION BY query_id ORDER BY rank)::BIGINT AS running_tokens FROM sparse s JOIN documents USING (doc_id)) WHERE running_tokens <= 3500",
    "eval_bm25": f"WITH {_bm25('okapi', 10)}, {_QREL}, {_metrics('sparse', 'qr', 10)}",
    "eval_dense_dup": f"WITH {_LABELS}, {_metrics('lh', 'lt', 10)}",
    "eval_dense_dedup": f"WITH {_LABELS}, {_FIRST}, {_metrics('l1', 'lt', 10)}",
    "relevance_buckets": f"WITH {_QREL}, c AS (SELECT query_id, count(DISTINCT doc_id) AS n FROM qr GROUP BY 1) SELECT CASE WHEN n <= 5 THEN '3-5' WHEN n <= 10 THEN '6-10' WHEN n <= 50 THEN '11-50' ELSE '>50' END AS bucket, count(*) AS n_queries FROM c GROUP BY 1",
    "score_histogram": f"WITH {_bm25('okapi', 50)}, e AS (SELECT min(score) AS lo, max(score) AS hi FROM sparse) SELECT least(floor((score - lo) / ((hi - lo) / 20)), 19)::INT AS bin, count(*) AS n FROM sparse, e GROUP BY 1",
    "score_stats": f"WITH {_bm25('okapi', 50)} SELECT count(*) AS n, max(score) AS max_score, min(score) AS min_score, round(avg(score), 6) AS mean_score FROM sparse",
    "grouping_miner": f"WITH {_ATTR} SELECT lang AS especie, q AS indicacion, source AS via, t AS categoria_antibiotico, count(*) AS num_docs, ' para ' || lang || coalesce(' con ' || q, '') || coalesce(' por vía ' || source, '') || coalesce(' antibiótico categoría ' || t, '') AS descripcion FROM attr GROUP BY lang, q, source, t HAVING count(*) >= 3",
    "criteria_filter": f"WITH {_ATTR} SELECT 0 AS query_id, doc_id FROM attr WHERE lang = 'en' UNION ALL SELECT 1, doc_id FROM attr WHERE lang = 'en' AND q = 'q1' AND t = 't0' UNION ALL SELECT 2, doc_id FROM attr WHERE source = 'src0' UNION ALL SELECT 3, doc_id FROM attr WHERE lang = 'fr' AND source = 'src3' AND t = 't1'",
    "id_codecs": "SELECT o_orderkey, 'EU/2/24/' || o_orderkey || '-001-x' AS registration, 'EU-2-24-' || o_orderkey || '-001-x' AS back, 'EU-2-24-' || o_orderkey || '-001-x.md' AS leaf, o_orderkey || ' ESP' AS doc FROM orders",
    "change_feed_filter": "SELECT DISTINCT user_id::VARCHAR AS nregistro FROM events WHERE event_type = 'purchase'",
    "sha256_diff": "WITH o AS (SELECT doc_id::VARCHAR AS path, sha256(text) AS h FROM documents WHERE doc_id % 7 <> 0), n AS (SELECT doc_id::VARCHAR AS path, sha256(CASE WHEN doc_id % 5 = 0 THEN upper(text) ELSE text END) AS h FROM documents WHERE doc_id % 11 <> 0) SELECT coalesce(o.path, n.path) AS path, CASE WHEN o.h IS NULL THEN 'added' WHEN n.h IS NULL THEN 'removed' WHEN o.h <> n.h THEN 'changed' ELSE 'same' END AS status FROM o FULL JOIN n ON o.path = n.path",
    "latest_wins_merge": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "change_feed_stream": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "event_windows": "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "dedup_ordered": "SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations) WHERE r = 1",
    "seeded_sample": "SELECT doc_id FROM documents ORDER BY sha256(doc_id || ':0'), doc_id LIMIT 100",
    "chat_turns": "SELECT conv_id, turn, answer_turn FROM (SELECT conv_id, turn, role, lead(role) OVER w AS r, lead(turn) OVER w AS answer_turn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND r = 'assistant'",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
