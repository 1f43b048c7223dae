"""The source audit against exact counting with Python integers."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from thicket.llm import divergence, tokens

DOCS = "doc_id long, text string, lang string, source string, part string, `n.v` int, value double"


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def expected(rows):
    docs = [(lang or "", source or "", terms(text)) for text, lang, source in rows]
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        seen[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= 3]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        every = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            far = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept) for o in sources - {s}}
            own = {t: (p[s][t] - every[t]) ** 2 // every[t] for t in kept if counts[lang, s][t] and p[s][t] > every[t]}
            for part, found, most in (("pair", far, None), ("term", own, 200)):
                ranked = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)}
    return out


def rows():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeÉßЖ字") for _ in range(r.randint(1, 4))) for _ in range(900)]
    out = []
    for _ in range(260):
        lang = r.choice(["en", "en", "en", "de", None, "", "x"])
        text = "".join(r.choice(words).title() + r.choice([" ", ", ", "\n", "7", "\x00", "_"]) for _ in range(r.randint(0, 60)))
        out.append((text, lang, r.choice(["hot", "hot", "hot", "b", "c", "d", None, ""])))
    out += [out[0]] * 40 + [(None, "en", "b"), ("", "fr", "only"), ("1 2 3", "it", "a"), ("rare words here", "it", "b"), (None, None, None)]
    return out + [("long words in A very long text " * 110_000, "en", "c"), ("x" * 3_000_000, "en", "d")]


def got(spark, data):
    table = spark.createDataFrame([(i, *r, "z", 1, 0.5) for i, r in enumerate(data)], DOCS)
    return divergence.divergence(table).select("lang", "source", "part", "item", "value", "rank").collect()


def test_rows_equal_exact_counting(spark):
    found = got(spark, rows())
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == expected(rows())


def test_no_rows_and_nothing_kept(spark):
    assert got(spark, []) == []
    assert {tuple(r) for r in got(spark, [("a b", "en", "s"), ("a b", "en", "t"), ("c", "de", "s")])} == {("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)}


def test_counts_are_sent_in_parts_and_long_texts_count_once(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ROWS", 50)
    monkeypatch.setattr(tokens, "PIECE", 64)
    data = [(lang or "", source or "", text) for text, lang, source in rows()[:120]] + [("en", "s", "one Two " * 500)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*data[i : i + 30])], ["lang", "source", "text"]) for i in range(0, len(data), 30)]
    n, docs = Counter(), Counter()
    sent = list(divergence._count(batches))
    assert len(sent) > 1
    for r in pa.Table.from_batches(sent).to_pylist():
        n[r["lang"], r["source"], r["term"]] += r["n"]
        docs[r["lang"], r["source"], r["term"]] += r["docs"]
    assert n == Counter((a, b, t) for a, b, text in data for t in terms(text))
    assert docs == Counter((a, b, t) for a, b, text in data for t in set(terms(text)))


def test_pairs_in_blocks_of_sources(monkeypatch):
    counts = pa.table({"shard": pa.array([0] * 60, pa.int32()), "lang": ["en"] * 60, "source": [f"s{i % 9}" for i in range(60)], "term": [f"t{i // 9}" for i in range(60)], "n": [i * i % 17 + 1 for i in range(60)]})
    groups = pa.table({"lang": ["en"] * 10, "source": [f"s{i}" for i in range(10)], "total": [sum(i * i % 17 + 1 for i in range(60) if i % 9 == k) if k < 9 else 0 for k in range(10)], "v": [7] * 10})
    key = [("source", "ascending"), ("item", "ascending")]
    whole = divergence._parts(counts, groups).sort_by(key)
    monkeypatch.setattr(divergence, "PAIRS", 20)
    assert divergence._parts(counts, groups).sort_by(key) == whole and whole.num_rows > 90


def test_rows_of_shards_do_not_follow_the_partitions(spark):
    """Each shard gives a row for a pair of sources, so more partitions make no more of them."""
    rows = [(i, f"wort{i % 7} wort{i % 11} ding", "de", f"s{i % 6}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    before, made = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (2, 16):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            made.append(divergence._sums(docs).filter("part = 'pair'").count())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert made == [30, 30]
