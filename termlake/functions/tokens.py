"""Tokenizers and per-row token counting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _runs(text: Column, outside: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), outside), "")


def lex_alpha(text: Column) -> Column:
    """Lower-cased runs of ASCII letters."""
    return _runs(text, "[^a-z]+")


def lex_alnum(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return _runs(text, "[^a-z0-9]+")


def tokenize_word(text: Column) -> Column:
    """Words of letters, numbers, ``_`` and ``'``; split first, lower-cased after."""
    parts = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}_']+"), "")
    return F.transform(parts, lambda t: F.lower(t))


def min_len(tokens: Column, n: int = 2) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= n)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_tokens(tokens: Column) -> Column:
    """``array<struct<term, cnt>>`` of one row's tokens, sorted by term.

    A document sits in one row, so its counts need no shuffle: sort the tokens
    and measure the runs.
    """

    def over_sorted(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return bind(
            starts,
            lambda b: F.transform(
                b,
                lambda p, j: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(b, j + 1), F.size(s)) - p).cast("bigint").alias("cnt"),
                ),
            ),
        )

    none = F.array().cast("array<struct<term:string,cnt:bigint>>")
    return bind(
        F.sort_array(tokens),
        lambda s: F.when(F.size(s) > 0, over_sorted(s)).otherwise(none),
    )
