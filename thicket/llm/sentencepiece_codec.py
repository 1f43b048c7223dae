"""SentencePiece models on the tokenizers library.

The model protobuf is parsed here (wire format, no generated code) and rebuilt
as a tokenizers pipeline: normaliser (precompiled character map, white-space
folding, dummy prefix, metaspace marker), BPE merges or unigram scores, and
byte fallback.  BPE merges never cross from another character to a marker
when no piece does, so the text is pre-split there, which keeps long texts
linear.  Parity with the sentencepiece library is verified for every row.  Where
a text's ids are those of its words, one after the other (see ``by_words``),
each distinct word is encoded once by both libraries and kept in a table of
bounded size, and rows are put together from it; elsewhere whole rows are encoded
by both.  What differs gets that library's ids, so what a text gives never
depends on other rows or on the partitioning.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.llm.runtime import bounded_batches, lean

MARK = "▁"
#: Piece types of the model format; fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Words that a worker remembers, characters of the longest of them (longer ones are encoded where they occur), and words encoded as one line.
WORDS, LONGEST, JOINED = 400_000, 64, 1000
#: A word with the blanks before it.
_WORD = re.compile(" +[^ ]*")

def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message: ints, 4- or 8-byte strings, bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind} is not used by this format")


def parse_model(data: bytes) -> dict:
    """pieces [(text, score, type)], model_type (1 unigram, 2 BPE), unk_id and the normaliser's settings."""
    out = {"pieces": [], "model_type": 1, "unk_id": 0, "charsmap": b"", "add_dummy_prefix": True, "remove_extra_whitespaces": True, "escape_whitespaces": True, "byte_fallback": False, "suffix": False}
    for number, value in fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    text = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            out["pieces"].append((text, score, kind))
        elif number == 2:
            names = {3: "model_type", 24: "suffix", 35: "byte_fallback", 40: "unk_id"}
            out |= {names[n]: v for n, v in fields(value) if n in names}
        elif number == 3:
            names = {2: "charsmap", 3: "add_dummy_prefix", 4: "remove_extra_whitespaces", 5: "escape_whitespaces"}
            out |= {names[n]: v for n, v in fields(value) if n in names}
    return out


def build(data: bytes):
    """A tokenizers.Tokenizer that encodes and decodes as the model does."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    model = parse_model(data)
    if model["suffix"] or not model["escape_whitespaces"]:
        raise ValueError("white space as suffix or unescaped is not supported")
    pieces = model["pieces"]
    bytes_known = bool(model["byte_fallback"]) or any(k == BYTE for _, _, k in pieces)
    steps = [normalizers.Precompiled(model["charsmap"])] if model["charsmap"] else []
    if model["remove_extra_whitespaces"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["add_dummy_prefix"]:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    if model["model_type"] == 2:
        ids = {}
        for i, (text, _, _) in enumerate(pieces):
            ids.setdefault(text, i)
        usable = {t: s for t, s, k in pieces if k in (NORMAL, USER_DEFINED)}
        order = []
        for text, score in usable.items():
            for cut in range(1, len(text)):
                if text[:cut] in usable and text[cut:] in usable:
                    order.append((-score, ids[text], ids[text[:cut]], text[:cut], text[cut:]))
        order.sort()
        core = models.BPE(ids, [(a, b) for *_, a, b in order], unk_token=pieces[model["unk_id"]][0], fuse_unk=True, byte_fallback=bytes_known)
    elif model["model_type"] == 1:
        core = models.Unigram([(t, s) for t, s, _ in pieces], unk_id=model["unk_id"], byte_fallback=bytes_known)
    else:
        raise ValueError(f"model type {model['model_type']} is not supported")
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizers.Sequence(steps)
    if splits_at_marks(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    tail = [decoders.Strip(" ", 1, 0)] if model["add_dummy_prefix"] else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), *([decoders.ByteFallback()] if bytes_known else []), decoders.Fuse(), *tail])
    return tokenizer


class Decoder:
    """The text of ids: the pieces' bytes joined; what is no UTF-8 is left to the library's decoder."""

    def __init__(self, model: dict, tokenizer):
        self.tokenizer, self.dummy = tokenizer, bool(model["add_dummy_prefix"])
        self.pieces = [bytes([int(t[3:5], 16)]) if k == BYTE else t.replace(MARK, " ").encode() for t, _, k in model["pieces"]]

    def __call__(self, ids: list[int]) -> str:
        pieces = self.pieces
        try:
            text = b"".join([pieces[i] for i in ids]).decode()
        except UnicodeDecodeError:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return text[1:] if self.dummy and text.startswith(" ") else text


def splits_at_marks(model: dict) -> bool:
    """True if no piece holds a marker after another character, so no merge crosses there."""
    return model["model_type"] == 2 and not any(MARK in t.lstrip(MARK) for t, _, k in model["pieces"] if k in (NORMAL, USER_DEFINED, UNUSED))


def by_words(model: dict) -> bool:
    """True if a text's ids are those of its words: nothing is merged across a blank, and blanks and characters stay as they are."""
    return splits_at_marks(model) and bool(model["add_dummy_prefix"]) and not model["charsmap"] and not model["remove_extra_whitespaces"]


class Words:
    """The ids of words, encoded by both libraries when first met; a full table is begun anew."""

    def __init__(self, tokenizer, decoder: Decoder, reference):
        self.tokenizer, self.decoder, self.reference, self.pieces = tokenizer, decoder, reference, decoder.pieces
        self.first = np.array([reference.id_to_piece(i).startswith(MARK) for i in range(len(self.pieces))])
        self.ids: dict[str, bytes] = {}
        self.odd: set[str] = set()

    def cut(self, text: str) -> list[str] | None:
        """The words of a text, each with all blanks before it but the first; None where the end is a blank, which is no word of its own."""
        if MARK in text:
            text = text.replace(MARK, " ")  # the library takes both for the same
        if not text:
            return []
        if text[-1] == " ":
            return None
        return [w[1:] for w in _WORD.findall(" " + text)] if "  " in text or text[0] == " " else text.split(" ")

    def learn(self, words: set[str]) -> None:
        """Puts words into the table, those that decoding does not give again into odd, too."""
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > WORDS:
            self.ids, self.odd, new = {}, set(), list(words)
        plain = [w for w in new if w[0] != " "]
        parts = [plain[lo : lo + JOINED] for lo in range(0, len(plain), JOINED)] + [[w] for w in new if w[0] == " "]
        lines = [" ".join(p) for p in parts]
        for part, line, coded in zip(parts, lines, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
            mine, theirs = coded.ids, self.reference.encode(line)
            ids = np.array(mine if mine == theirs else theirs, "<u4")
            raw, same = ids.tobytes(), b"".join([self.pieces[i] for i in ids.tolist()]) == (" " + line).encode()
            if len(part) == 1:
                self.ids[line] = raw
                if not same:
                    self.odd.add(line)
                continue
            starts = np.flatnonzero(self.first[ids])
            if not same or len(starts) != len(part):
                for word in part:
                    self.learn_one(word)
                continue
            ends = (np.append(starts[1:], len(ids)) * 4).tolist()
            self.ids.update(zip(part, [raw[a:b] for a, b in zip((starts * 4).tolist(), ends)]))

    def learn_one(self, word: str) -> None:
        mine, theirs = self.tokenizer.encode(word, add_special_tokens=False).ids, self.reference.encode(word)
        ids = mine if mine == theirs else theirs
        self.ids[word] = np.array(ids, "<u4").tobytes()
        if b"".join([self.pieces[i] for i in ids]) != (" " + word).encode():
            self.odd.add(word)

    def encode(self, texts: list[str]) -> list[tuple[int, int, bool, bytes] | None]:
        """(number of ids, their CRC-32, whether decoding gives the text again, ids) of each text; None for those that are no list of words."""
        cuts = [self.cut(t) for t in texts]
        met = {w for words in cuts if words for w in words}
        self.learn(met)
        ids, made = self.ids, []
        for text, words in zip(texts, cuts):
            if words is None:
                made.append(None)
                continue
            raw = b"".join([ids[w] for w in words])
            same = self.odd.isdisjoint(words) and MARK not in text or self.decoder(np.frombuffer(raw, "<u4").tolist()) == text
            made.append((len(raw) // 4, zlib.crc32(raw), same, raw))
        for word in [w for w in met if len(w) > LONGEST]:
            self.ids.pop(word, None)
            self.odd.discard(word)
        return made


@lru_cache(maxsize=4)
def loaded(path: str):
    """(tokenizer, decoder, sentencepiece processor) of a model file, once a worker."""
    import sentencepiece

    os.environ.setdefault("RAYON_NUM_THREADS", "2")
    with open(path, "rb") as f:
        data = f.read()
    tokenizer = build(data)
    return tokenizer, Decoder(parse_model(data), tokenizer), sentencepiece.SentencePieceProcessor(model_proto=data)


@lru_cache(maxsize=4)
def known_words(path: str) -> Words | None:
    """The table of words of a model file, once a worker; None where texts are no lists of words."""
    with open(path, "rb") as f:
        return Words(*loaded(path)) if by_words(parse_model(f.read())) else None


def check_parity(path: str, texts: list[str]) -> None:
    """Raises unless both libraries give the same ids and texts."""
    tokenizer, decoder, reference = loaded(path)
    for text, mine in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        theirs = reference.encode(text)
        if mine.ids != theirs:
            raise AssertionError(f"ids differ from sentencepiece on a text of {len(text)} characters: {text[:80]!r}")
        if not tokenizer.decode(mine.ids, skip_special_tokens=False) == decoder(mine.ids) == reference.decode(theirs):
            raise AssertionError(f"decoding differs from sentencepiece on {text[:80]!r}")


def _whole_rows(path: str, texts: list[str]) -> list[tuple[int, int, bool, bytes]]:
    """What Words.encode gives, of whole texts that both libraries encode."""
    tokenizer, decoder, reference = loaded(path)
    made = []
    for text, coded in zip(texts, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        theirs = reference.encode(text)
        same = decoder(theirs) == text if coded.ids == theirs else reference.decode(theirs) == text
        raw = np.array(theirs, "<u4").tobytes()
        made.append((len(theirs), zlib.crc32(raw), same, raw))
    return made


def _code(path: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known_words(path)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"  # read at each call; other operators of the worker may have set it
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            made, at = [], 0
            while at < len(texts):  # about 1 MB of text at a time
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 1 << 20):
                    size += len(texts[end])
                    end += 1
                part = texts[at:end]
                found = words.encode(part) if words else [None] * len(part)
                rest = iter(_whole_rows(path, [t for t, f in zip(part, found) if f is None]))
                made += [next(rest) if f is None else f for f in found]
                at = end
            columns = [batch.column(c) for c in keep]
            columns += [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.bool_())]
            names = keep + ["n_tokens", "ids_crc32", "round_trip"]
            if "ids" not in keep:
                offsets = pa.array(np.concatenate([[0], np.cumsum([m[0] for m in made])]), pa.int32())
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(m[3] for m in made), np.uint32).astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return lean(run)


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids), round_trip of every row.

    round_trip tells whether decoding gives the text again.  Null texts count
    as empty and have no ids; a null doc_id stays null.  Every row, or every
    word of it, is compared with the sentencepiece library.  Texts of any length
    are encoded whole.  Repeated rows and ties give repeated results; other
    columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    coded = text.mapInArrow(_code(model_path, ["doc_id"]), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, ids array<int>")
    return coded.select("doc_id", "ids", "n_tokens", "ids_crc32", "round_trip")
