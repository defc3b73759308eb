"""Weights and similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tf_rel(cnt: Column, total: Column) -> Column:
    return cnt / total


def idf(n_docs: Column | int, df: Column) -> Column:
    """Smoothed: ``ln(1 + N/df)``; a missing or zero df counts as 1."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return F.log(F.lit(1.0) + n / F.coalesce(F.nullif(df, F.lit(0)), F.lit(1)))


def norm(weights: Column) -> Column:
    """L2 norm of an array of weights."""
    return F.sqrt(F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w * w))


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    return F.when((norm_a > 0) & (norm_b > 0), dot / (norm_a * norm_b)).otherwise(F.lit(0.0))
