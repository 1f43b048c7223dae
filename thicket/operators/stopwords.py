"""Corpus stopwords from term and document frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thicket.functions.text import corpus_words, fold, fold_accents
from thicket.session import stored


def term_statistics(tokens: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(term, tf, df) of tokens(doc, term): counted within documents first, so one shuffle carries small rows."""
    inner = tokens.groupBy("term", doc).agg(F.count("*").alias("n"))
    return inner.groupBy("term").agg(F.sum("n").alias("tf"), F.count("*").alias("df"))


def array_statistics(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(term, tf, df) of documents with token arrays: a document's distinct terms are found in its row, so tasks send one small row a term."""
    once = lambda terms, tf, df: F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(tf).alias("tf"), F.lit(df).alias("df")))
    both = F.concat(once(F.col(tokens), 1, 0), once(F.array_distinct(tokens), 0, 1))
    return docs.select(F.inline(both)).groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


#: Terms of one prefix that the driver may see when it looks for a cut.
PREFIX_TERMS = 10_000


def generate(tokens: DataFrame, n_docs: int, base: Sequence[str] = (), doc: str = "doc_id") -> DataFrame:
    """(term): terms in half of the documents, the fifth (ten at least) of least tf-idf, and base; accents folded.

    Terms in one document are not scored; one-character terms are left out
    after the cut.  Equal scores go by term.  The cut is found by counting, so
    no task holds the fifth.
    """
    stats = stored(term_statistics(tokens, doc), "terms")
    total, n_scored = stats.agg(F.sum("tf"), F.count_if(F.col("df") > 1)).first()
    scored = stats.filter("df > 1").select("term", F.round(F.col("tf") / F.lit(total or 1) * F.log(F.lit(n_docs) / F.col("df")), 12).alias("score"))
    score, term = _cut(stored(scored, "scored"), max(10, int(0.2 * n_scored)))
    least = scored.filter((F.col("score") < score) | (F.col("score") == score) & (F.col("term") <= term)) if score is not None else scored
    common = stats.filter((F.col("df") >= max(2, n_docs // 2)) & (F.length("term") > 1)).select("term")
    fixed = tokens.sparkSession.createDataFrame([(fold(w),) for w in base], "term string")
    return least.filter(F.length("term") > 1).select("term").unionByName(common).select(fold_accents(F.col("term")).alias("term")).unionByName(fixed).distinct()


def _cut(scored: DataFrame, n: int) -> tuple[float | None, str | None]:
    """(score, term) of the n-th row by score, then term; nothing where there are no more than n rows."""
    lo, hi, rows = scored.agg(F.min("score"), F.max("score"), F.count("*")).first()
    if rows <= n:
        return None, None
    below, bins = 0, 4096
    while lo < hi:  # ever finer bins; the driver sees their counts
        width = (hi - lo) / bins
        at = F.least(F.floor((F.col("score") - lo) / width), F.lit(bins - 1)) if width > 0 and lo + width > lo else F.when(F.col("score") > lo, 1).otherwise(0)
        part = scored.filter((F.col("score") >= lo) & (F.col("score") <= hi)).groupBy(at.alias("bin"))
        for r in part.agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).orderBy("bin").collect():
            if below + r.n >= n:
                lo, hi = r.lo, r.hi
                break
            below += r.n
    ties, prefix = scored.filter(F.col("score") == lo), ""
    while True:
        inside = ties.filter(F.startswith("term", F.lit(prefix)))
        counts = inside.groupBy(F.substring("term", 1, len(prefix) + 1).alias("p")).agg(F.count("*").alias("n")).collect()  # one row a next letter
        for r in sorted(counts):
            if below + r.n >= n:
                break
            below += r.n
        if r.n <= PREFIX_TERMS or r.p == prefix:
            found = ties.filter(F.startswith("term", F.lit(r.p)) if r.p != prefix else F.col("term") == prefix).select("term").collect()
            return lo, sorted(x.term for x in found)[n - below - 1]
        prefix = r.p


def content_hashes(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    return files.select(F.col(path).alias("path"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, status) over both hash sets: added, removed, changed or same."""
    both = old.select("path", F.col("sha256").alias("_o")).join(new.select("path", F.col("sha256").alias("_n")), "path", "full_outer")
    return both.select("path", F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.col("_o") != F.col("_n"), "changed").otherwise("same").alias("status"))


def decisions(diff: DataFrame, by: Sequence[str], age: str, max_age: float = 15, share: float = 50) -> DataFrame:
    """(*by, again) for each group of diff(*by, status): whether its stopwords are made anew.

    They are on the first run (null age), past max_age days, for a changed set
    of paths, or if share percent of the common files changed.
    """
    counted = diff.groupBy(*by).agg(F.count_if(F.col("status").isin("added", "removed")).alias("moved"), F.count_if(F.col("status") == "changed").alias("changed"), F.count_if(F.col("status").isin("changed", "same")).alias("common"))
    due = F.col(age).isNull() | (F.col(age) > max_age) | (F.col("moved") > 0) | (F.col("common") > 0) & (100 * F.col("changed") >= share * F.col("common"))
    return counted.select(*by, due.alias("again"))


def must_regenerate(diff: DataFrame, age_days: float | None, max_age: float = 15, share: float = 50) -> bool:
    """decisions() of one corpus, at the driver; a corpus without files is only made anew by its age."""
    if age_days is None or age_days > max_age:
        return True
    found = decisions(diff.withColumn("age", F.lit(float(age_days))), ["age"], "age", max_age, share).first()
    return bool(found) and found.again


def refresh(files: DataFrame, old: DataFrame, held: DataFrame, age_days: float | None, base: Sequence[str] = ()) -> tuple[DataFrame, bool]:
    """(stopwords, whether they were made anew) of files(path, content) after a run that left hashes old(path, sha256) and words held(term)."""
    if not must_regenerate(changes(old, content_hashes(files)), age_days):
        return held.select("term"), False
    words = files.select(F.col("path").alias("doc_id"), F.explode(corpus_words(F.col("content"))).alias("term"))
    return generate(words, files.count(), base), True


def order_preserving_distinct(df: DataFrame, value: str, position: str, partition: Sequence[str] = ()) -> DataFrame:
    """The first occurrence of each value, in order of position."""
    window = Window.partitionBy(*partition, value).orderBy(position)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def blank_repeats(df: DataFrame, value: str, position: str) -> DataFrame:
    """Every row, with later occurrences of a value blanked."""
    window = Window.partitionBy(value).orderBy(position)
    return df.withColumn("_nth", F.row_number().over(window)).withColumn(value, F.when(F.col("_nth") == 1, F.col(value)).otherwise("")).drop("_nth")


def seeded_sample(df: DataFrame, ident: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by a hash of id and seed: the same rows on every run and engine."""
    return df.withColumn("_h", F.sha2(F.concat(F.col(ident).cast("string"), F.lit(f":{seed}")), 256)).orderBy("_h", ident).limit(n).drop("_h")
