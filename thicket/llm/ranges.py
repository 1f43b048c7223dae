"""Deterministic ranges of a key: contiguous, of about equal size, computed by an expression."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def range_bounds(df: DataFrame, column: str, n: int) -> list[int]:
    """At most n increasing values of the column, the least first; at the driver n numbers, whatever the table."""
    steps = [i / n for i in range(n)]
    found = df.agg(F.percentile_approx(column, F.array(*map(F.lit, steps)), F.lit(max(10_000, 4 * n))).alias("q"), F.min(column).alias("lo")).first()
    return sorted({found.lo, *found.q}) if found.lo is not None else []


def range_id(column: Column, bounds: list[int]) -> Column:
    """Index of the range that holds the value: bounds[i] <= value < bounds[i+1]; 0 for nulls.

    Looks up a literal array in two levels, about 2 * sqrt(n) comparisons.
    """
    if len(bounds) < 2:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*[F.lit(g[0]).cast("long") for g in groups])
    body = F.array(*[F.array(*[F.lit(x).cast("long") for x in g]) for g in groups])
    group = F.greatest(F.size(F.filter(heads, lambda b: b <= column)), F.lit(1))
    inside = F.size(F.filter(F.element_at(body, group), lambda b: b <= column))
    return F.coalesce(F.when(column.isNull(), 0).otherwise(F.greatest((group - 1) * width + inside - 1, F.lit(0))), F.lit(0))


def slots(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a number that Spark's hash puts there, so that repartition(n, slot) deals one group to each."""
    found = spark.range(32 * n + 64).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("at")).agg(F.min("id").alias("id"))
    held = {r.at: r.id for r in found.collect()}  # one row a partition
    return [held.get(i, i) for i in range(n)]


def slot_of(column: Column, found: list[int]) -> Column:
    """The slot of a number from 0."""
    return F.element_at(F.array(*[F.lit(x).cast("long") for x in found]), (column + 1).cast("int"))


def locate(bounds: list[int], value: int) -> int:
    """The same on the driver."""
    return max(0, bisect_right(bounds, value) - 1)
