"""Similarity of names: 1 - indel distance / total length, which is 2 * LCS / (l1 + l2)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

THRESHOLD, LENGTH_GAP = 0.85, 5


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by bit-parallel rows (one machine integer per row)."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row = (1 << len(a)) - 1
    full = row
    for c in b:
        match = row & places.get(c, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - bin(row).count("1")


def ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def clean_name(c: Column) -> Column:
    return F.lower(F.trim(c))


def _allowed(length: int) -> int:
    """The most insertions and deletions between an entry of this length and a match."""
    longest = min(length + LENGTH_GAP, int(length * (2 - THRESHOLD) / THRESHOLD + 1e-9))
    return int((1 - THRESHOLD) * (length + longest) + 1e-9)


def _segments(length: int) -> list[tuple[int, int]]:
    """(start, size) of the pieces of an entry, one more than the edits allowed, so a match has one of them unchanged."""
    n = _allowed(length) + 1
    cuts = [length * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _entry_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(e, p, c, f"{len(e)}:{i}:{e[a : a + n]}") for e, p, c in zip(*(batch.column(k).to_pylist() for k in range(3))) if e for i, (a, n) in enumerate(_segments(len(e)))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())], ["entry", "position", "category", "key"])


def _name_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name in batch.column(0).to_pylist():
            keys = set()
            for length in range(max(1, len(name) - LENGTH_GAP), len(name) + LENGTH_GAP + 1):
                edits = _allowed(length)
                for i, (a, n) in enumerate(_segments(length)):
                    for at in range(max(0, a - edits), min(len(name) - n, a + edits) + 1):
                        keys.add(f"{length}:{i}:{name[at : at + n]}")
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(sorted(keys), pa.string())], ["name", "key"])


def _first_entries(dictionary: DataFrame) -> DataFrame:
    """(name, position, category): every distinct entry once, by its first position, as no later one can be chosen."""
    known = dictionary.select(F.col("entry").alias("name"), F.struct(F.col("position").cast("long").alias("position"), F.col("category").cast("string").alias("category")).alias("_first"))
    return known.groupBy("name").agg(F.min("_first").alias("_first")).select("name", "_first.position", "_first.category")


def closest_matches(names: DataFrame, dictionary: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(name, entry, category, ratio): each distinct name's best entry of dictionary(position, entry, category).

    Names whose length differs by more than five are no match; the first entry
    wins ties.  A name that is an entry has no closer one.  The others are joined
    with the entries that have one of their segments unchanged in about its
    place: every match of THRESHOLD has one, and only these pairs are compared.
    """
    if threshold < THRESHOLD:
        raise ValueError(f"segments are made for similarities of {THRESHOLD} and more")
    left = names.select(clean_name(F.col("name")).alias("name")).filter("name IS NOT NULL").distinct()
    known = _first_entries(dictionary)
    exact = left.join(known, "name").select("name", "position", F.col("name").alias("entry"), "category", F.lit(1.0).alias("ratio"))
    others = left.join(known.select("name"), "name", "left_anti").mapInArrow(_name_keys, "name string, key string")
    entries = known.select("name", "position", "category").filter("name IS NOT NULL").mapInArrow(_entry_keys, "entry string, position long, category string, key string")
    pairs = others.join(entries, "key").select("name", "position", "entry", "category").distinct()
    scored = pairs.withColumn("ratio", similarity("name", "entry")).select(*exact.columns).unionByName(exact).filter(F.col("ratio") >= threshold)
    best = Window.partitionBy("name").orderBy(F.desc("ratio"), "position")
    return scored.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").select("name", "entry", "category", "ratio")


def normalise_names(df: DataFrame, column: str, dictionary: DataFrame, out: str) -> DataFrame:
    """df with out: the category of the exact entry, else of the closest, else the raw name."""
    exact = dictionary.select(F.col("entry").alias("_key"), F.col("category").alias("_exact"))
    with_exact = df.withColumn("_key", clean_name(F.col(column))).join(exact, "_key", "left")
    missing = with_exact.filter("_exact IS NULL").select(F.col(column).alias("name"))
    fuzzy = closest_matches(missing, dictionary).select(F.col("name").alias("_key"), F.col("category").alias("_fuzzy"))
    return with_exact.join(fuzzy, "_key", "left").withColumn(out, F.coalesce("_exact", "_fuzzy", column)).drop("_key", "_exact", "_fuzzy")


def name_map(names: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(raw, normalised, known) of every distinct name: what nested normalisation looks up; known where the dictionary has it or a close entry."""
    raw = names.select(F.col("name").alias("raw")).filter("raw IS NOT NULL").distinct()
    made = normalise_names(raw, "raw", dictionary.withColumn("category", F.concat(F.lit("="), "category")), "_made")
    known = F.startswith("_made", F.lit("=")) & (F.col("_made") != F.col("raw"))
    return made.select("raw", F.when(known, F.substring("_made", 2, 1 << 20)).otherwise(F.col("raw")).alias("normalised"), known.alias("known"))


def unmapped_names(names: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct names without an exact entry, their closest match ('None' if there is none) and an empty suggestion."""
    distinct = names.select(clean_name(F.col("name")).alias("name")).filter("name <> ''").distinct()
    unknown = distinct.join(dictionary.select(F.col("entry").alias("name")), "name", "left_anti")
    close = closest_matches(unknown, dictionary).select("name", F.col("category").alias("closest"))
    return unknown.join(close, "name", "left").select("name", F.coalesce("closest", F.lit("None")).alias("closest"), F.lit("").alias("suggestion"))


def import_mappings(dictionary: DataFrame, suggestions: DataFrame) -> DataFrame:
    """The dictionary with rows of suggestions(name, suggestion) upserted where the suggestion is not blank."""
    new = suggestions.filter(F.trim("suggestion") != "").select(clean_name(F.col("name")).alias("entry"), F.trim("suggestion").alias("category")).dropDuplicates(["entry"])
    top = dictionary.agg(F.coalesce(F.max("position"), F.lit(-1)).alias("top"))
    kept = dictionary.join(new.select("entry", F.col("category").alias("_new")), "entry", "left").select("position", "entry", F.coalesce("_new", "category").alias("category"))
    added = new.join(dictionary, "entry", "left_anti").crossJoin(F.broadcast(top)).select((F.col("top") + 1).cast("long").alias("position"), "entry", "category")
    return kept.unionByName(added)


def group_ids(df: DataFrame, category: str, ident: str) -> DataFrame:
    """(category, n, number, ident): distinct ids of each category, one row an id; they go by number, then ident.

    number is the id's leading number, 999999 without one.
    """
    number = F.coalesce(F.regexp_extract(F.col(ident), r"^\s*(\d+)", 1).try_cast("long"), F.lit(999999))
    rows = df.filter(F.col(category).isNotNull()).select(category, number.alias("number"), F.col(ident).cast("string").alias(ident)).distinct()
    return rows.join(rows.groupBy(category).agg(F.count("*").alias("n")), category).select(category, "n", "number", ident)


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(position, entry, category) of a JSON object name -> category, in its order; empty without a file."""
    files = spark.read.text(path, wholetext=True)
    pairs = files.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("position", "e"))
    return pairs.select(F.col("position").cast("long").alias("position"), F.col("e.key").alias("entry"), F.col("e.value").alias("category"))


def save_mapping(dictionary: DataFrame, path: str) -> None:
    """The dictionary as one JSON object in entry order; a dictionary is small enough for one file by its nature."""
    whole = dictionary.agg(F.to_json(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("position", "entry", "category"))), lambda x: F.struct(x["entry"], x["category"])))).alias("value"))
    whole.write.mode("overwrite").text(path)


def add_mapping(dictionary: DataFrame, name: str, category: str) -> DataFrame:
    """The dictionary with one name, trimmed and lower-cased, mapped to category."""
    new = dictionary.sparkSession.createDataFrame([(name, category)], "name string, suggestion string")
    return import_mappings(dictionary, new)
