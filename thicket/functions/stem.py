"""Spanish suffix stripping after the public Snowball description, applied until the word is stable."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def _by_last(ends: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """Endings by their last letter, the longest first."""
    found: dict[str, list[str]] = {}
    for end in sorted(ends, key=len, reverse=True):
        found.setdefault(end[-1], []).append(end)
    return {last: tuple(x) for last, x in found.items()}


# The suffix lists of the published algorithm.
VOWELS = frozenset("aeiouáéíóúü")
PRONOUNS = _by_last("selas selos sela selo las les los nos me se la le lo".split())
GERUNDS = {"iéndo": "iendo", "ándo": "ando", "ár": "ar", "ér": "er", "ír": "ir"}
STANDARD = (
    ("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos", ""),
    ("adora ador ación adoras adores aciones ante antes ancia ancias", "ic"),
    ("logía logías", "log"), ("ución uciones", "u"), ("encia encias", "ente"), ("amente", "amente"), ("mente", "mente"), ("idad idades", "idad"), ("iva ivo ivas ivos", "at"),
)
RULES = {s: rule for names, rule in STANDARD for s in names.split()}
SUFFIXES = _by_last(RULES)
Y_VERBS = _by_last("ya ye yan yen yeron yendo yo yó yas yes yais yamos".split())
VERBS_E = ("emos", "éis", "en", "es")
VERBS = tuple("arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos".split())
ALL_VERBS = _by_last((*VERBS, *VERBS_E))
#: The letters that an ending has last; other words keep theirs.
LAST = frozenset((*PRONOUNS, *SUFFIXES, *Y_VERBS, *ALL_VERBS, *"aoáíóeé"))
PLAIN = str.maketrans("áéíóú", "aeiou")
VOWEL, CONSONANT = (re.compile(f"[{x}{''.join(sorted(VOWELS))}]") for x in ("", "^"))
CLOSED = re.compile(VOWEL.pattern + CONSONANT.pattern)


def _regions(w: str) -> tuple[int, int, int]:
    def after(found: re.Match | None) -> int:
        return found.end() if found else len(w)

    r1 = after(CLOSED.search(w))
    r2 = after(CLOSED.search(w, r1))
    rv = len(w)
    if len(w) > 2:
        if w[1] not in VOWELS:
            rv = after(VOWEL.search(w, 2))
        elif w[0] in VOWELS:
            rv = after(CONSONANT.search(w, 2))
        else:
            rv = 3
    return r1, r2, rv


def _ending(w: str, ends: dict[str, tuple[str, ...]], least: int = 0) -> str:
    """The longest of ends that w has and that begins at least so far in; empty if none."""
    these = ends.get(w[-1:], ())
    return next(e for e in these if w.endswith(e, least)) if w.endswith(these, least) else ""


def _pronoun(w: str, rv: int) -> str:
    p = _ending(w, PRONOUNS)
    if not p or len(w) - len(p) < rv:
        return w
    body = w[: -len(p)]
    for end, plain in GERUNDS.items():
        if body.endswith(end) and len(body) - len(end) >= rv:
            return body[: -len(end)] + plain
    if any(body.endswith(e) and len(body) - len(e) >= rv for e in ("iendo", "ando", "ar", "er", "ir")) or body.endswith("uyendo") and len(body) - 5 >= rv:
        return body
    return w


def _drop(w: str, r2: int, *ends: str) -> str:
    e = next((e for e in ends if w.endswith(e) and len(w) - len(e) >= r2), None)
    return w[: -len(e)] if e else w


def _standard(w: str, r1: int, r2: int) -> str:
    end = _ending(w, SUFFIXES)
    if not end:
        return w
    rule = RULES[end]
    at = len(w) - len(end)
    if at < (r1 if rule == "amente" else r2):
        return w
    body = w[:at]
    if rule == "log":
        return body + "log"
    if rule == "u":
        return body + "u"
    if rule == "ente":
        return body + "ente"
    if rule == "ic":
        return _drop(body, r2, "ic")
    if rule == "amente":
        shorter = _drop(body, r2, "iv")
        return _drop(shorter, r2, "at") if shorter != body else _drop(body, r2, "os", "ic", "ad")
    if rule == "mente":
        return _drop(body, r2, "ante", "able", "ible")
    if rule == "idad":
        return _drop(body, r2, "abil", "ic", "iv")
    if rule == "at":
        return _drop(body, r2, "at")
    return body


def _verb(w: str, rv: int) -> str:
    end = _ending(w, Y_VERBS, rv)
    if end and w[: -len(end)].endswith("u"):
        return w[: -len(end)]
    end = _ending(w, ALL_VERBS, rv)
    if not end:
        return w
    body = w[: -len(end)]
    return body[:-1] if end in VERBS_E and body.endswith("gu") else body


def _plain(w: str) -> str:
    return w if w.isascii() else w.translate(PLAIN)


def stem_once(w: str) -> str:
    if w[-1:] not in LAST:
        return _plain(w)
    r1, r2, rv = _regions(w)
    w = _pronoun(w, rv)
    out = _standard(w, r1, r2)
    if out == w:
        out = _verb(w, rv)
    for end in ("os", "a", "o", "á", "í", "ó"):
        if out.endswith(end) and len(out) - len(end) >= rv:
            out = out[: -len(end)]
            break
    else:
        if out.endswith(("e", "é")) and len(out) - 1 >= rv:
            out = out[:-1]
            if out.endswith("gu") and len(out) - 1 >= rv:
                out = out[:-1]
    return _plain(out)


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """stem_once until nothing changes, so stemming twice is stemming once."""
    while True:
        out = stem_once(word)
        if out == word:
            return out
        word = out


@F.pandas_udf(StringType())
def stem_column(c: pd.Series) -> pd.Series:
    return c.map(stem, na_action="ignore")


def stem_lists(tokens: pa.Array) -> pa.Array:
    """Stems of token arrays, blank ones dropped; a distinct word of the arrays is looked up once."""
    coded = tokens.flatten().dictionary_encode()
    stems = [stem(w) for w in coded.dictionary.to_numpy(zero_copy_only=False)]
    kept = np.array([s != "" and not s.isspace() for s in stems], bool)
    out, starts = pa.array(stems, pa.string()).take(coded.indices), np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()))
    if not kept.all():
        kept = kept[coded.indices.to_numpy()]
        out, starts = out.filter(pa.array(kept)), np.append(0, np.cumsum(kept))[starts]
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), out, mask=tokens.is_null())


@F.arrow_udf(ArrayType(StringType()))
def stem_tokens(c: pa.Array) -> pa.Array:
    return stem_lists(c)


def stem_terms(tokens: DataFrame, term: str = "term") -> DataFrame:
    """tokens with stemmed terms; each distinct term is stemmed once and joined back."""
    stems = tokens.select(term).distinct().withColumn("_stem", stem_column(term))
    return tokens.join(stems, term).withColumn(term, F.col("_stem")).drop("_stem").filter(F.trim(term) != "")
