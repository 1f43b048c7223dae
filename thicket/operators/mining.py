"""Attribute groupings, criteria filters and inverted groupings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _or_null(c: Column) -> Column:
    """Explodes to one null where the list is null or empty."""
    return F.explode_outer(F.when(F.size(c) > 0, c))


def mine_groupings(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """Counts of species x indication x route x antibiotic category, with a description.

    docs is (species array, indications map species -> array, routes array,
    categories array).  Repeats within species, indications and routes count
    again, categories are a set; an absent attribute is null.
    """
    rows = docs.select("*", F.explode("species").alias("especie"))
    rows = rows.select("*", _or_null(F.try_element_at("indications", F.col("especie"))).alias("indicacion"))
    rows = rows.select("*", _or_null(F.col("routes")).alias("via"))
    rows = rows.select("especie", "indicacion", "via", _or_null(F.array_distinct("categories")).alias("categoria_antibiotico"))
    counted = rows.groupBy("especie", "indicacion", "via", "categoria_antibiotico").agg(F.count("*").alias("num_docs")).filter(F.col("num_docs") >= min_docs)
    say = F.concat(
        F.lit(" para "), F.col("especie"), F.coalesce(F.concat(F.lit(" con "), F.col("indicacion")), F.lit("")),
        F.coalesce(F.concat(F.lit(" por vía "), F.col("via")), F.lit("")), F.coalesce(F.concat(F.lit(" antibiótico categoría "), F.col("categoria_antibiotico")), F.lit("")),
    )
    return counted.withColumn("descripcion", say)


def matching(docs: DataFrame, criteria: DataFrame) -> DataFrame:
    """Rows of criteria x docs that match; a null or empty criterion matches every document.

    criteria is (query_id, especie, indicacion, via, categoria_antibiotico).
    Each is joined on the first attribute that it gives; only one without any,
    which asks for all documents, is dealt to each of them.
    """
    given = lambda c: F.nullif(F.trim(c), F.lit(""))
    names = ("especie", "indicacion", "via", "categoria_antibiotico")
    first = F.coalesce(*[F.when(given(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c))) for c in names])
    empty = F.array().cast("array<string>")
    said = lambda c, array: F.transform(F.filter(F.coalesce(array, empty), lambda x: x.isNotNull()), lambda x: F.concat(F.lit(f"{c}="), x))
    held = F.flatten(F.filter(F.map_values("indications"), lambda x: x.isNotNull()))
    keys = F.array_distinct(F.concat(said("especie", F.col("species")), said("indicacion", held), said("via", F.col("routes")), said("categoria_antibiotico", F.col("categories"))))
    of_species = F.when(given("especie").isNotNull(), F.try_element_at("indications", F.col("especie"))).otherwise(held)
    has = lambda array, c: given(c).isNull() | F.coalesce(F.array_contains(array, F.col(c)), F.lit(False))
    ok = has(F.col("species"), "especie") & has(of_species, "indicacion") & has(F.col("routes"), "via") & has(F.col("categories"), "categoria_antibiotico")
    keyed = criteria.withColumn("_key", first)
    found = docs.withColumn("_key", F.explode(keys)).join(keyed.filter("_key IS NOT NULL"), "_key").filter(ok).drop("_key")
    open_ = keyed.filter("_key IS NULL").drop("_key").collect()  # criteria that ask for everything
    if not open_:
        return found
    each = F.explode(F.array(*[F.struct(*[F.lit(r[c]).cast(criteria.schema[c].dataType).alias(c) for c in criteria.columns]) for r in open_]))
    return found.unionByName(docs.withColumn("_c", each).select(*docs.columns, "_c.*"))


def invert(df: DataFrame, path: str, ident: str, min_docs: int = 2) -> DataFrame:
    """(value, n_ids, id): documents by the values at a dotted path, one row an id; arrays give one group a value.

    A group is not gathered into one row, so its size does not matter.
    """
    value = F.col(path)
    kind = df.select(value.alias("v")).schema["v"].dataType.typeName()
    rows = df.select(F.col(ident).cast("string").alias("id"), (F.explode(value) if kind == "array" else value).alias("value")).filter("value IS NOT NULL")
    sizes = rows.groupBy("value").agg(F.count("*").alias("n_ids")).filter(F.col("n_ids") >= min_docs)
    return rows.join(sizes, "value").select("value", "n_ids", "id")


def pivot_counts(df: DataFrame, group: str, named: Mapping[str, Column]) -> DataFrame:
    """Conditional counts of each group."""
    return df.groupBy(group).agg(*[F.count_if(c).alias(n) for n, c in named.items()])
