"""Similarity of vectors and token sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """In [-1, 1]; null where sizes differ, a vector is empty or has no length."""
    usable = (F.size(a) == F.size(b)) & (F.size(a) > 0) & (norm(a) > 0) & (norm(b) > 0)
    return F.when(usable, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / (norm(a) * norm(b)))))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)
