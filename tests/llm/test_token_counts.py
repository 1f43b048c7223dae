"""Token counts against the libraries, and what the cache saves."""

import random
import re

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from thicket.llm import queries, token_counts

WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, content string, key int, `a.b` string, n_tokens int"


def library(path, text):
    if path.endswith(".model"):
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))
    return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)


def rows():
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgÉßЖ字'́ ") for _ in range(r.randint(1, 9))) for _ in range(300)]
    texts = ["".join(r.choice(words) + r.choice([" ", "  ", "\t", "\n\n", ", ", " 12,5% "]) for _ in range(r.randint(0, 80))) for _ in range(60)]
    texts += [texts[3]] * 30 + [texts[4].replace(" ", "\n\t "), "  " + texts[5] + "\r\n"]
    texts += [None, "", " \n", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "don't I'LL", "x" * 20_000, "́ á", " ".join(words) * 60, "\x0b\x0c\x1c\x85  a"]
    out = list(enumerate(texts))
    return out + [(None, "no id"), (None, texts[0]), (5, "another text of id 5"), (7, texts[7]), (7, texts[7])]


def table(spark, data):
    return spark.createDataFrame([(i, t, "c", 1, "z", -1) for i, t in data], DOCS)


@pytest.mark.parametrize("path", [WORDS, BYTES, PIECES])
def test_counts_are_the_librarys(spark, path):
    got = token_counts.token_counts(table(spark, rows()), path, limit=100).collect()
    want = [(i, len((t or "").encode()), n := library(path, t), n > 100) for i, t in rows()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_only_missing_contents_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = table(spark, rows())

    def added(data):
        d = data.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        d = d.withColumn("content", token_counts.content_digest(F.col("text"), WORDS)).withColumn("key", F.concat("content", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
        return token_counts.add_missing(d.select("key", "content", "text"), d.select("key", "content"), WORDS, cache)

    first = added(docs)
    assert first == len({tuple(re.findall(r"[^\t-\r ]+", t or "")) for _, t in rows()})
    stored = spark.read.parquet(cache)
    assert stored.count() == first == stored.select("content").distinct().count()
    assert added(docs) == 0 and spark.read.parquet(cache).count() == first
    more = table(spark, [*rows(), (500, "quite new"), (501, "quite  new"), (502, rows()[3][1] + " ")])
    assert added(more) == 1  # few of many: the other way of finding their texts
    assert spark.read.parquet(cache).count() == first + 1
    got = token_counts.token_counts(more, WORDS, cache).collect()
    assert len(got) == len(rows()) + 3 and all(r.n_tokens == library(WORDS, dict([*rows(), (500, "quite new"), (501, "quite new"), (502, rows()[3][1])])[r.doc_id]) for r in got if r.doc_id and r.doc_id >= 500)
    token_counts.compact(spark, cache, str(tmp_path / "compact"), 2)
    assert spark.read.parquet(str(tmp_path / "compact")).count() == first + 1
    assert token_counts.token_counts(more, WORDS, str(tmp_path / "compact")).exceptAll(spark.createDataFrame(got)).count() == 0


def test_tokenizers_do_not_share_counts(spark, tmp_path):
    cache, docs = str(tmp_path / "cache"), table(spark, [(1, "Some words, don't they?"), (2, "and  two")])
    for path in (WORDS, BYTES, PIECES, WORDS):
        assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path, cache).collect()} == {1: library(path, "Some words, don't they?"), 2: library(path, "and  two")}
    assert spark.read.parquet(cache).count() == 6
    assert len({token_counts.tokenizer_version(p) for p in (WORDS, BYTES, PIECES)}) == 3
    assert [token_counts.by_words(p) for p in (WORDS, BYTES, PIECES)] == [True, False, False]


def test_empty_table(spark, tmp_path):
    assert token_counts.token_counts(table(spark, []), WORDS, str(tmp_path / "c")).count() == 0


def test_query_equals_the_library_on_every_document(spark, sf_dir):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op12_token_counts(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)
