"""Token normalization: minimum length, stopwords, lemmas."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..session import broadcast_if_small, is_small
from .counts import bag_counts, term_bags, term_counts

# Lists up to these lengths are looked up inside a document's row.
ROW_STOPWORDS = 10_000
ROW_LEMMAS = 256
BAG = "array<struct<term:string,cnt:bigint>>"


def as_words(words: DataFrame | Iterable[str], like: DataFrame) -> DataFrame:
    """One-column table ``term`` of distinct words from a list or a table."""
    if isinstance(words, DataFrame):
        return words.select(F.col(words.columns[0]).alias("term")).distinct()
    rows = [(w,) for w in sorted(set(words))]
    return like.sparkSession.createDataFrame(rows, "term string")


def stopword_anti(terms: DataFrame, stopwords: DataFrame | Iterable[str]) -> DataFrame:
    """Rows whose ``term`` is no stopword."""
    return terms.join(broadcast_if_small(as_words(stopwords, terms)), "term", "left_anti")


def lemma_join(terms: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replaces ``term`` by its lemma where ``lemmas(token, lemma)`` has one."""
    table = lemmas.select(F.col("token").alias("term"), "lemma").groupBy("term").agg(F.min("lemma").alias("lemma"))
    joined = terms.join(broadcast_if_small(table), "term", "left")
    return joined.withColumn("term", F.coalesce("lemma", "term")).drop("lemma").select(*terms.columns)


def normalize_counts(
    counts: DataFrame,
    stopwords: DataFrame | Iterable[str] = (),
    lemmas: DataFrame | None = None,
    min_len: int = 2,
    id_col: str = "id",
) -> DataFrame:
    """Normalizes ``(id, term, cnt)``; in the order length, stopwords, lemma.

    Works on term counts, not on tokens: equal tokens of a document are joined
    once. Terms that meet in one lemma are added up.
    """
    kept = stopword_anti(counts.where(F.length("term") >= min_len), stopwords)
    if lemmas is None:
        return kept.select(id_col, "term", "cnt")
    return lemma_join(kept, lemmas).groupBy(id_col, "term").agg(F.sum("cnt").alias("cnt"))


def normalize_docs(
    docs: DataFrame,
    stopwords: DataFrame | Iterable[str] = (),
    lemmas: DataFrame | None = None,
    min_len: int = 2,
    tokenizer: Callable[[Column], Column] = tk.lex_alpha,
) -> DataFrame:
    """``(id, total, term, cnt)`` of ``docs(id, text)`` after :func:`normalize_counts`.

    A document without terms gives one row with a null term.
    """
    return bag_counts(normalize_bags(docs, stopwords, lemmas, min_len, tokenizer))


def normalize_bags(
    docs: DataFrame,
    stopwords: DataFrame | Iterable[str] = (),
    lemmas: DataFrame | None = None,
    min_len: int = 2,
    tokenizer: Callable[[Column], Column] = tk.lex_alpha,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """As :func:`normalize_docs`, ``(id, total, bag)`` with one row per document.

    With short lists tokens are filtered, mapped and counted in the document's
    own row, so nothing is shuffled, and columns to ``keep`` stay with it; longer
    lists are joined.
    """
    words = as_words(stopwords, docs)
    pairs = None if lemmas is None else lemmas.groupBy("token").agg(F.min("lemma").alias("lemma"))
    if is_small(words, ROW_STOPWORDS) and (pairs is None or is_small(pairs, ROW_LEMMAS)):
        stop = [r["term"] for r in words.collect()]
        mapped = [F.lit(x) for r in (pairs.collect() if pairs is not None else []) for x in (r["token"], r["lemma"])]

        def normal(text: Column) -> Column:
            kept = F.filter(tokenizer(text), lambda t: (F.length(t) >= min_len) & (~t.isin(stop) if stop else F.lit(True)))
            return F.transform(kept, lambda t: F.coalesce(F.create_map(*mapped)[t], t)) if mapped else kept

        return term_bags(docs, normal, keep=keep)
    counts = normalize_counts(term_counts(docs, tokenizer).drop("total"), stopwords, lemmas, min_len)
    grouped = counts.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "cnt"))).alias("bag"))
    total = F.aggregate("bag.cnt", F.lit(0).cast("bigint"), lambda a, x: a + x)
    totals = grouped.select("id", total.alias("total"), "bag")
    rows = docs.select("id").join(totals, "id", "left")
    return rows.select("id", F.coalesce("total", F.lit(0).cast("bigint")).alias("total"), F.coalesce("bag", F.array().cast(BAG)).alias("bag"))
