"""Vector expressions over array<float> or array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(a: Column) -> Column:
    return F.sqrt(inner_product(a, a))


def normalised(a: Column) -> Column:
    """The vector over its length; a zero vector stays."""
    n = l2_norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))
