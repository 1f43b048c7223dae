"""PII surrogates: keyed, type-consistent replacements that keep distinct values distinct.

Detected entities are replaced by a keyed permutation of their own format, a
Feistel network over the mixed radix of the entity's characters: a letter stays
a letter of its class, case and script, a digit a digit, separators stay.  A
permutation never maps two values to one, so distinctness and coreference hold
over the whole corpus without any exchange between tasks and at any number of
values; that is the collision check, and the tests run it over whole domains.
Values that mean the same (a phone number with and without spaces, an IBAN in
groups, an address in capitals) are brought to one form before the permutation
and the result is laid out as the value was.  Validity is kept by walking the
permutation's cycle until the value is valid again (card check digits, dates)
or by computing the check digits anew (IBAN).

A name is permuted word by word within classes of letters of its script, with
the endings that carry gender left as they are, so it keeps its length, shape,
gender and script.  Names are found after titles and labels; every other
mention of such a name, or of a word of it, in the same text is replaced alike.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from datetime import date
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.llm import tokens
from thicket.llm.runtime import bounded_batches, lean

#: Default key; a deployment passes its own.
KEY = b"thicket surrogate key"
ROUNDS = 8

# Fixed values of this module: titles by gender, labels of names and birth dates, streets.
TITLES = {
    "m": "Mr Mister Sir Lord Herr Herrn Señor Sr Don Monsieur Signor г-н господин κύριος",
    "f": "Mrs Ms Miss Lady Frau Señora Señorita Sra Srta Doña Madame Mme Mademoiselle Mlle Signora г-жа госпожа κυρία",
    "": "Dr Doctor Prof Professor",
}
#: Titles that are also taken in lower case before a capital; the others could be verbs or articles there.
ANY_CASE = "mr mrs ms dr prof herr frau sr sra mme monsieur madame señor señora"
NAME_LABELS = "name|full name|contact|customer|patient|employee|nombre|nom|имя"
BIRTH_LABELS = "born(?: on)?|date of birth|birth ?date|dob|geb\\.|geboren(?: am)?|geburtsdatum|né(?:e)? le|nacid[oa] el|fecha de nacimiento"
STREETS = "Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Drive|Boulevard|Blvd|Court|Ct"
PARTICLES = "van|von|der|den|de|del|della|di|da|dos|la|le|bin|al|el"
GENDER = {t.lower(): g for g, names in TITLES.items() for t in names.split()}
#: Calling codes of two digits; 1 and 7 have one, all others three.
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Classes of letters within which a name is permuted, and ranges of scripts without case.
LETTERS = ["aeiou", "bcdgkpqt", "fhjsvxz", "lmnrwy", "àáâäãåæèéêëìíîïòóôöõøùúûüœ", "çñ", "аеиоуыэюяё", "бвгдзкпт", "жсфхцчшщ", "лмнр", "αεηιουω", "βγδθκπτ", "ζξσφχψ", "λμνρ", "άέήίόύώ"]
RANGES = [(0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x0627, 0x064A), (0x05D0, 0x05EA), (0x0915, 0x0939)]
#: Endings that carry gender.
ENDINGS = re.compile(r"(?:ова|ева|ёва|ина|ская|цкая|ая|вна|ов|ев|ёв|ин|ский|цкий|ий|вич|ου|ος|ης|ας|α|η|a|o)$")
LETTER_CLASS = {c: letters for letters in LETTERS for c in letters}

_UPPER = "A-ZÀ-ÖØ-ÞΑ-ΩΆ-ΏА-ЯЁ"
_WORD = rf"[{_UPPER}](?:[\w’'-]*\w)?"
_LEAD = rf"(?:(?:{PARTICLES})[  ]){{0,3}}"
_NAME = rf"{_LEAD}{_WORD}(?:[  ](?:(?:{PARTICLES})[  ]){{0,2}}{_WORD}){{0,2}}(?:[  ]?\(?[\u4e00-\u9fa5]{{2,4}})?"
_LOUD = rf"[{_UPPER}]{{2,}}(?![\w’'-])"
_TITLE = rf"\b(?:(?:{'|'.join(t for names in TITLES.values() for t in names.split())}|{'|'.join(ANY_CASE.split())})\.?[  ](?={_LEAD}[{_UPPER}])|(?:{'|'.join(t.upper() for names in TITLES.values() for t in names.split())})\.?[  ](?=[{_UPPER}]{{2}}))"
_DATE = r"\d{1,2}[./-]\d{1,2}[./-]\d{4}|\d{4}-\d{2}-\d{2}"
ENTITY = re.compile(
    rf"""(?P<assigned>\b(?i:password|passwd|pwd|secret|token|api[_-]?key)\b["']?\s*[=:]\s*["']?(?P<assigned_value>[A-Za-z0-9_+/.-]{{8,}}))
    |(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})
    |(?P<access_key>\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b|\b(?:ghp|gho|ghs)_[A-Za-z0-9]{{36}}\b|\bsk-[A-Za-z0-9]{{20,}}\b|\bAIza[A-Za-z0-9_-]{{35}}\b)
    |(?P<iban>\b[A-Z]{{2}}\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
    |(?P<birth>\b(?i:{BIRTH_LABELS})\s*:?\s*(?P<date>{_DATE})(?!\d))
    |(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))
    |(?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
    |(?P<card>(?<![\w.-])[2-6]\d{{3}}(?:[ -]?\d{{4}}){{2}}[ -]?\d{{1,7}}(?![\w-]))
    |(?P<phone>(?<![\w.+-])(?:\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{2,4}}(?:[ .-]?\d{{2,4}}){{1,4}}|(?:\(\d{{3}}\)[ ]?|\d{{3}}[.-])\d{{3}}[.-]\d{{4}})(?![\w-]))
    |(?P<street>\b\d{{1,5}}[ ][A-Z][a-z]+[ ](?:{STREETS})\b\.?|\b[A-ZÄÖÜ][a-zäöüß]+(?:straße|strasse|str\.|gasse|allee)[ ]\d{{1,4}}[a-z]?\b)
    |(?P<title>{_TITLE})(?P<name>{_LOUD}|{_NAME})
    |(?P<label>\b(?i:{NAME_LABELS})\s*[:=]\s*)(?P<labelled>{_WORD}(?:[  ]{_WORD}){{1,2}})
    |(?P<han>[\u4e00-\u9fa5]{{2,4}})(?=先生|女士|小姐|博士|教授)""".replace("[  ]", "[ \u00a0]"),
    re.VERBOSE,
)
#: What a text without digits, '@', '=' and ':' needs to hold an entity.
TITLED = re.compile(rf"{_TITLE}|先生|女士|小姐|博士|教授".replace("[  ]", "[ \u00a0]"))
MENTION = re.compile(rf"(?<![\w’'-])[{_UPPER}](?:[\w’'-]*\w)?")
_MAYBE = np.zeros(256, bool)
_MAYBE[[*range(48, 58), ord("@"), ord("="), ord(":")]] = True


def _round(key: bytes, tweak: bytes, step: int, value: int) -> int:
    text = tweak + bytes([step]) + value.to_bytes((value.bit_length() + 7) // 8 or 1, "big")
    return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=48).digest(), "big")


def permute(values: list[int], radices: list[int], key: bytes, tweak: bytes, back: bool = False) -> list[int]:
    """A keyed bijection of the mixed-radix numbers with these radices; back: its inverse."""
    half = (len(values) + 1) // 2
    sizes, parts = [1, 1], [0, 0]
    for i, (v, r) in enumerate(zip(values, radices)):
        side = i >= half
        parts[side] = parts[side] * r + v
        sizes[side] *= r
    for step in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
        side = step % 2
        turn = _round(key, tweak, step, parts[1 - side])
        parts[side] = (parts[side] - turn if back else parts[side] + turn) % sizes[side]
    out = [0] * len(values)
    for i in range(len(values) - 1, -1, -1):
        side = i >= half
        parts[side], out[i] = divmod(parts[side], radices[i])
    return out


def derange(values: list[int], radices: list[int], key: bytes, tweak: bytes) -> list[int]:
    """A keyed bijection without fixed points where there is more than one number: one step of a keyed cycle."""
    at = permute(values, radices, key, tweak, back=True)
    for i in range(len(at) - 1, -1, -1):
        at[i] = (at[i] + 1) % radices[i]
        if at[i]:
            break
    return permute(at, radices, key, tweak)


def permute_text(text: str, key: bytes, tweak: bytes, classes: str = "") -> str:
    """permute over the letters and digits of text; other characters stay. classes 'x' keeps hexadecimal letters so."""
    alphabets, at, values = [], [], []
    for i, c in enumerate(text):
        for alphabet in ("0123456789", *(("abcdef", "ABCDEF") if classes == "x" else ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))):
            if c in alphabet:
                alphabets.append(alphabet)
                at.append(i)
                values.append(alphabet.index(c))
    # The tweak holds the format, so each format has its own permutation.
    shape = "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in text)
    out = list(text)
    for i, alphabet, v in zip(at, alphabets, permute(values, [len(a) for a in alphabets], key, tweak + shape.encode())):
        out[i] = alphabet[v]
    return "".join(out)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _email(value: str, key: bytes) -> str:
    local, _, domain = value.lower().partition("@")
    labels = domain.split(".")
    reserved = labels[-1] in ("example", "test", "invalid") or labels[-2:-1] == ["example"]
    kept = 2 if labels[-2:-1] == ["example"] else 1
    moved = [permute_text(x, key, b"domain") for x in labels[:-kept]]
    out = permute_text(local, key, b"local") + "@" + ".".join(moved + labels[-kept:] + ([] if reserved else ["example"]))
    return out.upper() if value.isupper() else out


def _card(value: str, key: bytes) -> str:
    digits = re.sub(r"\D", "", value)
    out = digits
    while True:
        out = out[0] + permute_text(out[1:], key, b"card" + digits[:1].encode())
        if luhn(out):
            return _laid_out(out, value)


def _laid_out(digits: str, value: str) -> str:
    """The characters of digits in the places of the letters and digits of value."""
    made = iter(digits)
    return "".join(next(made) if c.isalnum() else c for c in value)


def _ip(value: str, key: bytes) -> str:
    return ".".join(map(str, permute([int(x) for x in value.split(".")], [256] * 4, key, b"ip")))


def _phone(value: str, key: bytes) -> str:
    digits = re.sub(r"\D", "", value)
    # A number without a calling code is in the North American form.
    code = "" if not value.startswith("+") else digits[: 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3]
    return _laid_out(code + permute_text(digits[len(code) :], key, b"phone" + (code or "1").encode()), value)


def _iban_rest(country: str, account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account + country + "00")) % 97


def _iban(value: str, key: bytes) -> str:
    plain = value.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if int(check) == 98 - _iban_rest(country, account):
        account = permute_text(account, key, b"iban" + country.encode())
        return _laid_out(country + f"{98 - _iban_rest(country, account):02d}" + account, value)
    out = check + account
    while True:  # check digits that do not fit stay so
        out = permute_text(out, key, b"iban?" + country.encode())
        if int(out[:2]) != 98 - _iban_rest(country, out[2:]):
            return _laid_out(country + out, value)


def _date(value: str, key: bytes) -> str:
    """Another day, month and year in the same layout; years from 1900 to 2027 only."""
    parts = re.split(r"[./-]", value)
    year_first = len(parts[0]) == 4
    year, month, day = (int(x) for x in (parts if year_first else reversed(parts)))
    if month > 12 and not year_first:  # month before day
        at, (month, day) = (1, 0, 2), (day, month)
    else:
        at = (0, 1, 2)
    if not (1900 <= year < 2028 and _is_date(year, month, day)):
        return permute_text(value, key, b"date")
    narrow = at == (1, 0, 2)
    now = [year - 1900, month - 1, day - 1]
    while True:
        now = permute(now, [128, 12, 31], key, b"birth" + bytes([narrow]))
        year, month, day = now[0] + 1900, now[1] + 1, now[2] + 1
        if _is_date(year, month, day) and (day > 12 or not narrow):
            break
    made = [year, month, day] if year_first else [(day, month, year)[i] for i in at]
    texts = [str(x).zfill(len(p)) for x, p in zip(made, parts)]
    marks = re.findall(r"[./-]", value)
    return texts[0] + marks[0] + texts[1] + marks[1] + texts[2]


def _is_date(year: int, month: int, day: int) -> bool:
    try:
        date(year, month, day)
        return True
    except ValueError:
        return False


@lru_cache(maxsize=4096)
def _letters(c: str) -> str:
    """The letters that a letter of a name may become; only itself for marks and signs."""
    if c in LETTER_CLASS:
        return LETTER_CLASS[c]
    for lo, hi in RANGES:
        if lo <= ord(c) <= hi:
            return "".join(map(chr, range(lo, hi + 1)))
    if not c.isalpha() or c in "йьъς":
        return c
    start = ord(c) & ~127
    same = [x for x in map(chr, range(start, start + 128)) if x.isalpha() and x == x.lower() and len(x.upper()) == 1 and unicodedata.category(x) == unicodedata.category(c) and x not in LETTER_CLASS]
    return "".join(same) if c in same else c


def _ending(plain: str) -> int:
    """Length of the ending that stays; 0 where nothing else could change."""
    found = ENDINGS.search(plain)
    kept = len(found.group()) if found else 0
    return kept if any(len(_letters(c)) > 1 for c in plain[: len(plain) - kept]) else 0


@lru_cache(maxsize=1 << 16)
def surrogate_word(word: str, key: bytes) -> str:
    """One word of a name, so that a later mention by it stays the same person."""
    lower = [c.lower() if len(c.lower()) == 1 else c for c in word]
    plain = made = "".join(lower)
    kept = _ending(plain)
    size = len(plain) - kept
    alphabets = [_letters(c) for c in plain[:size]]
    # The tweak holds the classes and what stays, so each shape has its own permutation;
    # it is walked until the ending is the same again, as other words have the other endings.
    tweak = b"name" + ("".join(a[0] for a in alphabets) + "|" + plain[size:]).encode()
    while True:
        moved = derange([a.index(c) for a, c in zip(alphabets, made)], [len(a) for a in alphabets], key, tweak)
        made = "".join(a[v] for a, v in zip(alphabets, moved)) + plain[size:]
        if _ending(made) == kept:
            break
    return "".join(o.upper() if c != l and len(o.upper()) == 1 else o for o, c, l in zip(made, word, lower))


def surrogate_name(name: str, key: bytes = KEY) -> str:
    """Each word of a name on its own; particles, spaces and brackets stay."""
    return re.sub(r"[^\s(]+", lambda m: m[0] if m[0] in PARTICLES.split("|") else surrogate_word(m[0], key), name)


def surrogate(kind: str, value: str, key: bytes = KEY) -> str:
    """The replacement of an entity."""
    if kind == "name":
        return surrogate_name(value, key)
    if kind == "email":
        return _email(value, key)
    if kind == "card":
        return _card(value, key)
    if kind == "ip":
        return _ip(value, key)
    if kind == "phone":
        return _phone(value, key)
    if kind == "iban":
        return _iban(value, key)
    if kind == "birth":
        return _date(value, key)
    if kind == "street":
        return re.sub(rf"\d+[a-z]?|(?!(?:{STREETS})\b)[A-ZÄÖÜ][a-zäöüß]+?(?=straße|strasse|str\.|gasse|allee|\b)", lambda m: permute_text(m[0], key, b"house") if m[0][0].isdigit() else surrogate_word(m[0], key), value)
    if kind == "access_key":
        head = re.match(r"AKIA|ASIA|gh[pos]_|sk-|AIza", value).group()
        return head + permute_text(value[len(head) :], key, b"access" + head.encode())
    if kind == "assigned":
        return permute_text(value, key, b"assigned", "x" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) else "")
    return permute_text(value, key, kind.encode())


def find(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the entities of a text, left to right; other mentions of names are not among them."""
    at = 0
    while m := ENTITY.search(text, at):
        at = m.end()
        if m["name"] or m["labelled"] or m["han"]:
            group = "name" if m["name"] else "labelled" if m["labelled"] else "han"
            end = m.end(group) - (2 if re.search(r"['’]s$", m[group]) else 0)
            yield m.start(group), end, "name", text[m.start(group) : end]
        elif m["assigned"]:
            if re.search(r"\d", m["assigned_value"]):
                yield m.start("assigned_value"), m.end("assigned_value"), "assigned", m["assigned_value"]
            else:  # no secret: the value may be or hold another entity
                at = m.start("assigned_value")
        elif m["birth"]:
            yield m.start("date"), m.end("date"), "birth", m["date"]
        elif m["card"]:
            if luhn(re.sub(r"\D", "", m["card"])):
                yield m.start(), m.end(), "card", m["card"]
        else:
            yield m.start(), m.end(), m.lastgroup, m.group()


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """find, and every other mention of the words of the names found."""
    found = list(find(text))
    words = {w.lower() for _, _, kind, v in found if kind == "name" for w in re.findall(r"[^\s(]+", v) if len(w) > 1 and w not in PARTICLES.split("|")}
    if not words:
        return found
    out, k = [], 0
    for m in MENTION.finditer(text):
        value = re.sub(r"['’]s$", "", m[0])
        if value.lower() in words:
            while k < len(found) and found[k][1] <= m.start():
                out.append(found[k])
                k += 1
            end = m.start() + len(value)
            if k == len(found) or end <= found[k][0]:
                out.append((m.start(), end, "name", value))
    return out + found[k:]


def replace(text: str, key: bytes = KEY) -> tuple[str, list[tuple[int, int, str, str]]]:
    """(text with surrogates, [(start, end, kind, surrogate)]) with offsets into the given text."""
    out, last, spans = [], 0, []
    for start, end, kind, value in entities(text):
        made = surrogate(kind, value, key)
        out += [text[last:start], made]
        spans.append((start, end, kind, made))
        last = end
    return ("".join(out) + text[last:], spans) if spans else (text, spans)


def _worth(column: pa.Array) -> list[bool]:
    """False for texts that can hold no entity: no digit, '@', '=' or ':' and no title."""
    at, data = tokens.string_buffers(column)
    seen = np.concatenate([[0], np.cumsum(_MAYBE[data[at[0] : at[-1]]])]) if len(data) else np.zeros(1, np.int64)
    has = seen[at[1:] - at[0]] > seen[at[:-1] - at[0]] if len(data) else np.zeros(len(at) - 1, bool)
    return [bool(h) or bool(TITLED.search(t)) for h, t in zip(has, column.fill_null("").to_pylist())]


def _mask(key: bytes, keep: list[str], details: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            texts, spans = column.to_pylist(), []
            for i, worth in enumerate(_worth(column)):
                found: list = []
                if worth and texts[i]:
                    texts[i], found = replace(texts[i], key)
                spans.append([{"start": s, "end": e, "kind": k, "surrogate": m} for s, e, k, m in found])
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in keep]
            names = list(keep)
            if details:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("surrogate", pa.string())]))
                columns += [pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, kind)]
                names += ["n_entities", "entities"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return lean(run)


def deployment_key(spark: SparkSession) -> bytes:
    """The session's secret, setting spark.thicket.surrogateKey; a public one where it is unset, as in tests."""
    found = spark.conf.get("spark.thicket.surrogateKey", None)
    return found.encode() if found else KEY


def pseudonymise(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """doc_id, text, n_entities, entities of every row; offsets are code points of the original text.

    Without a key the deployment's is taken: whoever has it can undo the surrogates.
    Null texts stay null and empty ones empty, with no entities; a null doc_id
    stays null.  Each row is replaced on its own, so repeated rows and ties give
    the same result; texts of any length are read whole; other columns are
    ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_mask(key or deployment_key(docs.sparkSession), ["doc_id", "text"], True), "doc_id long, text string, n_entities int, entities array<struct<start:int,end:int,kind:string,surrogate:string>>")


def masked(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """docs with surrogates in text; n_chars, where present, follows the new text.

    Odd rows are treated as in pseudonymise; all columns stay.
    """
    bounded_batches(docs.sparkSession)
    # Arrow functions take no names with dots, so columns go through under plain ones.
    plain = ["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    inner = docs.toDF(*plain)
    out = inner.mapInArrow(_mask(key or deployment_key(docs.sparkSession), plain, False), inner.schema).toDF(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out
