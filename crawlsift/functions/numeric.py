"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlsift.functions.html import let


def class_probability(logits: Column, k: int = 0) -> Column:
    """Softmax probability of class ``k`` from an array of logits."""

    def softmax(values: Column) -> Column:
        peak = F.array_max(values)
        total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - peak))
        return F.exp(F.element_at(values, k + 1) - peak) / total

    return let(logits.cast("array<double>"), softmax)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two vectors; NULL when a vector is missing, has no length, or sizes differ."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def angle(pair: Column) -> Column:
        norm = F.sqrt(dot(pair.a, pair.a)) * F.sqrt(dot(pair.b, pair.b))
        return F.when(
            (F.size(pair.a) == F.size(pair.b)) & (norm > 0), dot(pair.a, pair.b) / norm
        )

    return let(
        F.struct(left.cast("array<double>").alias("a"), right.cast("array<double>").alias("b")),
        angle,
    )
