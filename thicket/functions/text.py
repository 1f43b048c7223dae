"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word of Unicode letters, digits and underscores.
WORD = r"([\p{L}\p{N}_]+)"
# Accented letters and what they fold to, position by position; sharp s
# and the Catalan double l are handled as strings, n with tilde and c with cedilla stay.
ACCENTED = "áéíóúàèìòùäëïöüâêîôûãõýÿśźżÁÉÍÓÚÀÈÌÒÙÄËÏÖÜÂÊÎÔÛÃÕÝŸŚŹŻ"
FOLDED = "aeiouaeiouaeiouaeiouaoyyszzAEIOUAEIOUAEIOUAEIOUAOYYSZZ"
# The translation dictionary.
DICTIONARY = {
    "dog": "perro", "cat": "gato", "infection": "infección", "bacterial": "bacteriana", "antibiotic": "antibiótico", "medicine": "medicamento",
    "treatment": "tratamiento", "dose": "dosis", "tablet": "comprimido", "injection": "inyección", "oral": "oral", "veterinary": "veterinario",
}
# Language labels by two- and three-letter code.
LANGUAGES = {"es": "es", "spa": "es", "en": "en", "eng": "en", "ca": "ca", "cat": "ca", "gl": "gl", "glg": "gl", "fr": "fr", "fra": "fr", "it": "it", "ita": "it", "pt": "pt", "por": "pt", "de": "de", "deu": "de", "nl": "nl", "nld": "nl", "ru": "ru", "rus": "ru"}
# Spanish month names.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()


def fold_accents(c: Column, lowered: bool = False) -> Column:
    """Letters without accents; multi-character folds first, those of capitals only if c may have some."""
    c = F.regexp_replace(c, "l·l|ŀl", "ll")
    if not lowered:
        c = F.regexp_replace(c, "L·L|ĿL", "LL")
    return F.translate(F.replace(c, F.lit("ß"), F.lit("ss")), ACCENTED, FOLDED)


def words(c: Column) -> Column:
    """Words of a text in order; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(c, F.lit(WORD), F.lit(1)), F.array().cast("array<string>"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once a row, also where lambdas use it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_on_space(c: Column) -> Column:
    """The white-space alternative to words()."""
    return F.filter(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"), lambda t: t != "")


def literal_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def without_stopwords(tokens: Column, stopwords: Sequence[str], preserve: Sequence[str] = ()) -> Column:
    """Keeps a token if it is preserved or no stopword; order and repeats stay."""
    if not stopwords:
        return tokens
    kept = set(stopwords) - set(preserve)
    return F.filter(tokens, lambda t: ~t.isin(*sorted(kept))) if kept else tokens


def translate_words(c: Column, language: Column, dictionary: Mapping[str, str] = DICTIONARY, target: str = "es") -> Column:
    """Word-by-word translation of texts that are not in the target language."""
    pairs = F.create_map(*[F.lit(x) for kv in dictionary.items() for x in kv])
    moved = F.array_join(F.transform(split_on_space(F.lower(c)), lambda w: F.coalesce(F.try_element_at(pairs, w), w)), " ")
    return F.when(language == target, c).otherwise(moved)


def language_code(label: Column, default: str = "es") -> Column:
    """Canonical code of a detector's label such as '__label__eng'; the default for all others."""
    bare = F.lower(F.regexp_replace(F.coalesce(label, F.lit("")), "^__label__", ""))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv]), bare), F.lit(default))


def corpus_words(c: Column) -> Column:
    """Words for corpus statistics: code, links, tags, punctuation and digits removed first."""
    for pattern in (r"(?s)```.*?```", r"`[^`]*`", r"https?://\S+|www\.\S+", r"<[^>]+>"):
        c = F.regexp_replace(c, pattern, " ")
    c = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", " ")
    return split_on_space(F.regexp_replace(c, r"\p{Nd}+", ""))


@dataclass
class Normaliser:
    """Options of normalise(); each switches one expression.

    strip_lists folds the accents of stopwords and preserved words too, so that
    accented entries can match; False keeps the lists as they are.
    """

    lowercase: bool = True
    accents: bool = True
    punctuation: bool = True
    remove_stopwords: bool = True
    stopwords: Sequence[str] = field(default_factory=tuple)
    preserve: Sequence[str] = field(default_factory=tuple)
    strip_lists: bool = True
    translate: bool = False

    def tokens(self, c: Column, language: Column | None = None) -> Column:
        """The token array of a text, before stemming (see functions.stem)."""
        if self.translate and language is not None:
            c = translate_words(c, language)
        if self.lowercase:
            c = F.lower(c)
        if self.accents:
            c = fold_accents(c, self.lowercase)
        out = words(c) if self.punctuation else split_on_space(c)
        if self.remove_stopwords:
            out = without_stopwords(out, [fold(w) if self.strip_lists and self.accents else w for w in self.stopwords], [fold(w) if self.strip_lists and self.accents else w for w in self.preserve])
        return F.filter(out, lambda t: F.trim(t) != "")


def fold(word: str) -> str:
    """fold_accents for one Python string."""
    for a, b in (("l·l", "ll"), ("ŀl", "ll"), ("L·L", "LL"), ("ĿL", "LL"), ("ß", "ss")):
        word = word.replace(a, b)
    return word.translate(str.maketrans(ACCENTED, FOLDED))


def spanish_date(ms: Column, zone: str = "Europe/Madrid", padded: bool = True) -> Column:
    """Epoch milliseconds as '21 de mayo de 2020'; -1 and null as ''."""
    local = F.from_utc_timestamp(F.timestamp_millis(ms), zone)
    day = F.lpad(F.dayofmonth(local).cast("string"), 2, "0") if padded else F.dayofmonth(local).cast("string")
    month = F.element_at(literal_array(MONTHS), F.month(local))
    return F.when(ms.isNull() | (ms == -1), "").otherwise(F.concat_ws(" de ", day, month, F.year(local).cast("string")))


def canonical_doc_id(c: Column) -> Column:
    """One id for all spellings: FT_ prefix dropped, underscores to spaces, EU-2-24-… as EU/2/24/…."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(c, "^FT_", ""), "_", " "))
    return F.when(bare.startswith("EU-"), registration_from_file(bare)).otherwise(bare)


def document_url(base: str, registration: Column) -> Column:
    return F.concat(F.lit(base), registration)


def registration_from_file(name: Column) -> Column:
    """The first four dash parts joined by '/', what follows by '-'."""
    parts = F.split(name, "-")
    rest = F.array_join(F.slice(parts, 5, F.greatest(F.size(parts) - 4, F.lit(0))), "-")
    return F.when(F.size(parts) > 4, F.concat_ws("-", F.array_join(F.slice(parts, 1, 4), "/"), rest)).otherwise(F.array_join(parts, "/"))


def file_from_registration(registration: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(registration, "/", "-"), " ", "_")


def path_leaf(c: Column) -> Column:
    """Last component of a Windows or Unix path; a trailing separator is ignored."""
    return F.regexp_extract(F.regexp_replace(c, r"[/\\]+$", ""), r"([^/\\]*)$", 1)


def path_stem(c: Column) -> Column:
    return F.regexp_replace(path_leaf(c), r"(?<=.)\.[^.]*$", "")


def path_extension(c: Column) -> Column:
    return F.regexp_extract(path_leaf(c), r".(\.[^.]*)$", 1)


def all_equal(c: Column) -> Column:
    """True for arrays with at most one distinct value."""
    return F.size(F.array_distinct(c)) <= 1


def ascii_letters(c: Column, alphabet: str = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,;'") -> Column:
    """Accents folded and everything outside the alphabet dropped."""
    keep = "".join("\\" + x if x in "\\]^-[" else x for x in alphabet)
    return F.regexp_replace(F.translate(fold_accents(c), "ñçÑÇ", "ncNC"), f"[^{keep}]", "")


def clean(c: Column, punctuation: str = "", stopwords: Sequence[str] = ()) -> Column:
    """Punctuation characters dropped, lower case, stopwords dropped, one space between words."""
    bare = F.lower(F.translate(c, punctuation, "") if punctuation else c)
    return F.array_join(without_stopwords(split_on_space(bare), stopwords), " ")


#: Marks at which a snippet may begin and end, in the order in which they are looked for.
BOUNDARIES = (".", "!", "?", "\n")


def snippet(text: Column, terms: Column, width: int = 40, preview: int = 300) -> Column:
    """The first place of each query term of three letters or more, with its surroundings; else a preview.

    terms is an array.  The surroundings are width characters on each side,
    clipped after the last boundary mark before the term and after the first
    one behind it; the term is upper-cased in brackets.  The result counts the
    terms that were found and lists them in order.
    """
    low = F.lower(text)
    asked = F.filter(F.coalesce(terms, F.array().cast("array<string>")), lambda t: F.length(t) >= 3)
    found = F.filter(asked, lambda t: F.instr(low, t) > 0)

    def place(t: Column) -> Column:
        at = F.position(t, low)
        start = F.greatest(at - width, F.lit(1))
        left = F.substring(text, start, at - start)
        right = F.substring(text, at + F.length(t), F.lit(width))
        # Of the marks the first kind that occurs is the boundary.
        before = F.coalesce(*[F.when(F.instr(left, c) > 0, F.substring_index(left, c, -1)) for c in BOUNDARIES], left)
        after = F.coalesce(*[F.when(F.instr(right, c) > 0, F.concat(F.substring_index(right, c, 1), F.lit(c))) for c in BOUNDARIES], right)
        trim = lambda c, side: F.regexp_replace(c, r"^\s+" if side == 0 else r"\s+$", "")
        return F.concat(F.lit("TOKEN '"), t, F.lit("':\n..."), trim(before, 0), F.lit("["), F.upper(F.substring(text, at, F.length(t))), F.lit("]"), trim(after, 1), F.lit("...\n"))

    head = F.concat(F.lit("Found "), F.size(found).cast("string"), F.lit(" of "), F.size(asked).cast("string"), F.lit(" query tokens:\n\n"))
    cut = F.when(F.length(text) > preview, F.concat(F.substring(text, 1, preview), F.lit("..."))).otherwise(text)
    missed = F.concat(F.when(F.length(text) > preview, F.lit("No matches for query tokens. Preview:\n")).otherwise(F.lit("No matches for query tokens. Content:\n")), cut)
    return F.when(F.size(asked) == 0, cut).when(F.size(found) > 0, F.concat(head, F.array_join(F.transform(found, place), "\n"))).otherwise(missed)


def complete_line(text: Column, at: Column, mark: str = "\n") -> Column:
    """The trimmed line around position at (from 1), between the marks."""
    before = F.substring_index(F.substring(text, F.lit(1), at), mark, -1)
    after = F.substring_index(F.substring(text, at + 1, F.length(text)), mark, 1)
    return F.trim(F.concat(before, after))


def literal_map(c: Column) -> Column:
    """A literal dictionary such as {'a': 'b'} as map<string,string>; null where it does not parse."""
    return F.from_json(c, "map<string,string>", {"allowSingleQuotes": "true"})
