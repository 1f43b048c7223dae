"""Language identification against counting by hand."""

import math
import random
import re
from collections import Counter

import pyarrow as pa

from thicket.functions import language

DOCS = "doc_id long, text string, lang string, label string, `a.b` int, predicted string"


def grams(text):
    form = re.sub(r"[\x00-\x60\x7B-\x7F]+", " ", (text or "").translate({c: c + 32 for c in range(65, 91)})).strip(" ")
    c = [ord(x) for x in f" {form} "] if form else []
    return [(a * language.FIRST + b * language.SECOND + d) % language.BUCKETS for a, b, d in zip(c, c[1:], c[2:])]


def expected(train, texts, default="es"):
    counts = {}
    for text, label in train:
        if label is not None:
            counts.setdefault(label, Counter()).update(grams(text))
    weight = {k: (lambda n, z=math.log(sum(c.values()) + language.BUCKETS): round((math.log(n + 1.0) - z) * 1e6)) for k, c in counts.items()}
    out = []
    for text in texts:
        g = grams(text)
        ranked = sorted(((sum(weight[k](c[b]) for b in g), k) for k, c in counts.items()), key=lambda x: (-x[0], x[1].encode()))
        out.append((ranked[0][1] if g and ranked else default, ranked[0][0] - ranked[1][0] if len(ranked) > 1 else 0, len(g)))
    return out


def rows():
    r = random.Random(2)
    alphabets = {"en": "etaoin shrdlu", "ru": "оеаинт слрвк", "el": "αβγδε ζηθικ", "de": "enirstäöüß adh", "é": "etaoin éè"}
    out = []
    for _ in range(150):
        lang = r.choice(list(alphabets))
        out.append(("".join(r.choice(alphabets[lang] + "  A.7\n") for _ in range(r.randint(0, 300))), r.choice([lang] * 9 + [None])))
    out += [out[3]] * 20 + [("", "none"), (None, "en"), ("  \n", "en"), ("a", "en"), (" A ", "de"), ("字", "zh"), ("\x00é\x7f", None), ("x" * 5000, "en"), ("mixed ΑΒΓ абв " * 120_000, "el")]
    return out


def table(spark, data):
    return spark.createDataFrame([(i, t, x, "z", 1, "p") for i, (t, x) in enumerate(data)], DOCS)


def test_predictions_equal_counting_by_hand(spark):
    docs = table(spark, rows())
    got = language.predict(docs, language.fit(docs)).collect()
    assert len(got) == len(rows())
    want = expected(rows(), [t for t, _ in rows()])
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r.doc_id)] == want


def test_models_of_one_label_and_none(spark):
    docs = table(spark, [("some words", "en"), (None, None)])
    one = language.predict(docs, language.fit(docs), ["doc_id", "a.b", "label"])
    assert one.columns == ["doc_id", "a.b", "label", "predicted", "margin", "n_grams"]
    assert sorted(tuple(r)[3:] for r in one.collect()) == [("en", 0, 10), ("es", 0, 0)]
    none = language.predict(docs, language.fit(table(spark, [("x", None)])), default="de")
    assert sorted(tuple(r)[1:] for r in none.collect()) == [("de", 0, 0), ("de", 0, 10)]
    assert language.predict(table(spark, []), language.fit(docs)).count() == 0


def test_trigrams_do_not_depend_on_neighbours(monkeypatch):
    texts = [t for t, _ in rows()[:170]]
    for piece in (1, 500, 1 << 20):
        monkeypatch.setattr(language, "PIECE", piece)
        found = []
        for *_, raw, ends in language._runs(pa.array(texts, pa.string()).slice(3)):
            buckets, sizes = language._grams(raw, ends)
            at = [0, *sizes.cumsum()]
            found += [buckets[a:b].tolist() for a, b in zip(at, at[1:])]
        assert found == [grams(t) for t in texts[3:]]


def test_held_out_documents_are_recognised(spark, sf_dir):
    from thicket.plans import queries

    held = [r for r in queries.language_detect(spark, sf_dir).collect() if r.held_out]
    assert len(held) > 50 and sum(r.lang == r.predicted for r in held) >= 0.97 * len(held)
