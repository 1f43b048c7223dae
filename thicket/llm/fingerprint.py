"""Merkle fingerprints of documents, in DataFrame functions only.

A text is cut into sections (after blank lines), paragraphs (after line ends)
and leaves (runs of six words; a longer word counts as several), which together
hold every character.  Leaf hashes are SHA-256, and each paragraph, section and
the root hash the hashes below them, so equal roots mean equal texts.  The
fingerprint is one string:

    root|section:paragraph x leaves,paragraph x leaves;section:...|leaves

with the root in full and 8 hexadecimal digits for every other node.  Two
fingerprints are compared branch by branch without the texts: roots decide
equality exactly, while two different sections, paragraphs or leaves of one
pair of texts are taken for equal with a chance of 2**-32 each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thicket.llm.ranges import range_bounds, range_id
from thicket.llm.runtime import table_bytes

SECTION, PARAGRAPH, LEAF = r"(?<=\n\n)(?!\n)", r"(?<=\n)", r"(?s)(?:\S{1,32}+\s*+|\s++){1,6}+"
DIGITS = 8
#: Bytes of a table, as stored, behind a range of doc_id.
RANGE_BYTES = 64 << 20


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the fingerprint of the named column; null counts as empty."""
    used = [f"{name}_{k}" for k in ("leaves", "paragraphs", "sections")]
    leaves, paragraphs, sections = used
    filled = F.coalesce(F.col(text), F.lit(""))
    cut = F.transform(
        F.filter(F.split(filled, SECTION, -1), lambda s: s != ""),
        lambda s: F.transform(F.filter(F.split(s, PARAGRAPH, -1), lambda p: p != ""), lambda p: F.transform(F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda x: F.sha2(x, 256))),
    )
    df = df.withColumn(leaves, cut)
    df = df.withColumn(paragraphs, F.transform(leaves, lambda s: F.transform(s, lambda p: F.sha2(F.array_join(p, ""), 256))))
    df = df.withColumn(sections, F.transform(paragraphs, lambda s: F.sha2(F.array_join(s, ""), 256)))
    short = lambda h: F.substring(h, 1, DIGITS)
    tree = F.zip_with(
        F.col(sections),
        F.arrays_zip(F.col(paragraphs).alias("p"), F.transform(leaves, lambda s: F.transform(s, lambda p: F.size(p))).alias("n")),
        lambda h, s: F.concat(short(h), F.lit(":"), F.array_join(F.zip_with(s["p"], s["n"], lambda p, n: F.concat(short(p), F.lit("x"), n.cast("string"))), ",")),
    )
    line = F.concat(F.sha2(F.array_join(sections, ""), 256), F.lit("|"), F.array_join(tree, ";"), F.lit("|"), F.array_join(F.transform(F.flatten(F.flatten(leaves)), short), ""))
    return df.withColumn(name, line).drop(*used)


def leaves_of(fingerprint: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.substring_index(fingerprint, "|", -1), F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0)))


def root_of(fingerprint: Column) -> Column:
    return F.substring(fingerprint, 1, 64)


def likeness(mine: str, other: str) -> Column:
    """Share of equal leaves (Dice) of two columns of distinct leaves: 1 for equal sets, two empty ones included."""
    a, b = F.col(mine), F.col(other)
    both, total = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * both / total)


def _let(value: Column, use) -> Column:
    """use(value), with value computed once a row, also where lambdas use it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _indexed(values: Column, use) -> Column:
    """use(has), where has(x) tells whether the array values holds x in about 2 * sqrt(n) steps: sorted chunks and their heads."""

    def chunked(ordered: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(ordered))).cast("int"), F.lit(1))
        return F.when(F.size(ordered) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / width).cast("int")), lambda i: F.slice(ordered, i * width + 1, width))).otherwise(F.array().cast("array<array<string>>"))

    def with_heads(chunks: Column) -> Column:
        return _let(
            F.struct(chunks.alias("chunks"), F.transform(chunks, lambda c: F.get(c, F.lit(0))).alias("heads")),
            lambda ix: use(lambda x: F.coalesce(F.array_contains(F.get(ix["chunks"], F.size(F.filter(ix["heads"], lambda h: h <= x)) - 1), x), F.lit(False))),
        )

    return _let(F.array_sort(F.array_distinct(values)), lambda ordered: _let(chunked(ordered), with_heads))


def changed_paragraphs(mine: Column, other: Column) -> Column:
    """Positions (from 0, over the whole text) of paragraphs of mine that other does not hold.

    The trees are walked from the root: equal roots end it, sections that other
    has are passed over, and of the others the paragraphs are looked at.  Each
    tree is cut once, and a text of n paragraphs takes about n * sqrt(n) steps.
    """
    tree = lambda f: F.filter(F.split(F.element_at(F.split(f, r"\|"), 2), ";"), lambda s: s != "")
    digest = lambda s: F.substring(s, 1, DIGITS)
    inside = lambda s: F.transform(F.split(F.substring_index(s, ":", -1), ","), digest)

    def walk(trees: Column) -> Column:
        ours, theirs = trees["ours"], trees["theirs"]
        lost = _indexed(F.transform(ours, digest), lambda has: F.flatten(F.transform(F.filter(theirs, lambda s: ~has(digest(s))), inside)))
        flat = _indexed(F.transform(theirs, digest), lambda has: F.flatten(F.transform(ours, lambda s: _let(~has(digest(s)), lambda open: F.transform(inside(s), lambda p: F.struct(open.alias("open"), p.alias("p")))))))
        placed = F.transform(flat, lambda x, i: F.struct(x["open"].alias("open"), x["p"].alias("p"), i.alias("i")))
        return _indexed(lost, lambda has: F.transform(F.filter(placed, lambda x: x["open"] & ~has(x["p"])), lambda x: x["i"]))

    found = _let(F.struct(tree(mine).alias("ours"), tree(other).alias("theirs")), walk)
    return F.when(root_of(mine) == root_of(other), F.array().cast("array<int>")).otherwise(found)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row; other columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_fingerprint(rows, "text", "fingerprint").select("doc_id", "fingerprint")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, their likeness, and where they differ (edited_paragraphs).

    The edited text has its last floor(n_chars / 4) code points replaced by
    the first as many (or all) of the next document's, in ascending doc_id
    with the least after the last.  Null texts are empty.  Rows that repeat a
    doc_id follow each other in the order of their texts; rows with a null
    doc_id come first and are no document's next, except each other's.  Texts of
    any length are read whole; other columns are ignored.  One
    row for each row of docs; an empty table gives an empty result.

    Texts move once: rows are dealt by ranges of doc_id whose bounds are
    values of the column, and the first document of each range is also sent to
    the range before it, so every next document is found inside a range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table_bytes(docs) // RANGE_BYTES))
    bounds = range_bounds(rows, "doc_id", n)
    last = max(0, len(bounds) - 1)
    here = F.struct(range_id(F.col("doc_id"), bounds).cast("int").alias("range"), F.lit(0).alias("ghost"))
    before = F.struct((range_id(F.col("doc_id"), bounds) - 1).cast("int").alias("range"), F.lit(1).alias("ghost"))
    around = F.struct(F.lit(last).cast("int").alias("range"), F.lit(2).alias("ghost"))
    first = F.col("doc_id") == F.lit(bounds[0] if bounds else None).cast("long")
    heads = F.array(*[F.lit(b).cast("long") for b in bounds[1:]]) if len(bounds) > 1 else F.array().cast("array<long>")
    place = F.when(first, F.array(here, around)).when(F.array_contains(heads, F.col("doc_id")), F.array(here, before)).otherwise(F.array(here))
    dealt = with_fingerprint(rows, "text", "fingerprint").select("*", F.explode(place).alias("at")).select("doc_id", "text", "fingerprint", "at.range", "at.ghost")
    window = Window.partitionBy("range").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "text")
    paired = dealt.select("*", F.lead("text").over(window).alias("next_text"), F.lead("fingerprint").over(window).alias("next_fingerprint")).filter("ghost = 0")
    size = F.length("text")
    tail = F.floor(size / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), tail))
    paired = paired.select("doc_id", size.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", edited.alias("edited"))
    done = with_fingerprint(paired, "edited", "edited_fingerprint").select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", changed_paragraphs(F.col("edited_fingerprint"), F.col("fingerprint")).alias("edited_paragraphs"), leaves_of(F.col("fingerprint")).alias("a"), leaves_of(F.col("edited_fingerprint")).alias("b"), leaves_of(F.coalesce("next_fingerprint", F.lit("||"))).alias("c"))
    return done.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("a", "b").alias("near_edited"), likeness("a", "c").alias("near_next"), "edited_paragraphs")
