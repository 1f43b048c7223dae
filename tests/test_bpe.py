"""Byte-pair counts against the library."""

import random

import public_tokenizers
import tiktoken

from thicket.functions import bpe
from thicket.plans import queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def test_every_document_has_the_librarys_count(spark, sf_dir):
    encoder = library()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.bpe_counts(spark, sf_dir).collect()}
    assert got == {i: len(encoder.encode_ordinary(t or "")) for i, t in texts.items()}


def test_odd_texts(spark):
    encoder, r = library(), random.Random(6)
    pool = ["a", "the", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\u0085", "'s", "'LL", "don't", "12", "½", "é", "日本語", "🙂", "́", "_", "!!", "<|endoftext|>", "\x00", "\x1c", "Ж", "ﬁ", "ǅ"]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 25))) for _ in range(400)] + [None, "", "x" * 20_000, "ab" * 5_000, "é" * 3_000, " " * 999, "a \n b"]
    rows = [(i if i % 9 else None, t, "z") for i, t in enumerate(texts)] + [(7, texts[7], "z")]
    df = spark.createDataFrame(rows, "`d.id` long, text string, n_tokens string")
    got = sorted(map(tuple, bpe.token_counts(df, PATH, "d.id").collect()), key=repr)
    assert got == sorted(((i, len(encoder.encode_ordinary(t or ""))) for i, t, _ in rows), key=repr)
    assert bpe.token_counts(df.limit(0), PATH, "d.id").count() == 0


def test_merges_are_the_librarys():
    encoder, known, r = library(), bpe.ranks(PATH), random.Random(2)
    for _ in range(400):
        piece = bytes(r.choice(b"abehilnorst \xc3\xa9") for _ in range(r.randint(1, 40)))
        assert [known[t] for t in bpe.merged(piece, known)] == encoder._encode_single_piece(piece)


def test_rows_stay_where_they_are(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    assert "Exchange" not in bpe.token_counts(df, PATH)._jdf.queryExecution().toString()
