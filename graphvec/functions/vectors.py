"""Cosine similarity and the score profiles built on it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column) -> Column:
    return c.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """In double precision; null for a zero or null vector."""
    a, b = as_double(a), as_double(b)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


# c: cosine similarity.  Only `distance` has lower values for better matches by contract;
# `redis_norm` and `azure` grow with similarity.
PROFILES: dict[str, Callable[[Column], Column]] = {
    "distance": lambda c: 1 - c,
    "redis_norm": lambda c: F.greatest((1 + c) / 2, F.lit(0.0)),
    "opensearch": lambda c: 1 - 1 / (2 - c),
    "azure": lambda c: 1 / (2 - c),
}
