"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_from(product: Column, norm_a: Column, norm_b: Column) -> Column:
    scale = norm_a * norm_b
    return F.when(scale != 0, product / scale)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a vector has no length."""
    return cosine_from(dot(a, b), norm(a), norm(b))
