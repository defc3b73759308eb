"""Term and document counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as tk


def unique_docs(docs: DataFrame, order: str | None = None, id_col: str = "id") -> DataFrame:
    """One row per id: the last by ``order``, else the largest by content.

    Partial aggregation keeps one row per id and task before the shuffle, so a
    large group of copies costs no more than any other.
    """
    rest = [c for c in docs.columns if c != id_col]
    by = F.struct(order, *rest) if order else F.struct(*rest)
    last = F.max_by(F.struct(*rest), by).alias("_last")
    return docs.groupBy(id_col).agg(last).select(id_col, "_last.*").select(*docs.columns)


def term_counts(
    docs: DataFrame,
    tokenizer: Callable[[Column], Column] = tk.lex_alpha,
    id_col: str = "id",
    text_col: str = "text",
    keep_empty: bool = False,
) -> DataFrame:
    """``(id, total, term, cnt)``: counts of each document's terms, no shuffle.

    ``total`` is the number of tokens in the document. With ``keep_empty`` a
    document without tokens gives one row with null term and count.
    """
    rows = bag_counts(term_bags(docs, tokenizer, id_col, text_col), id_col)
    return rows if keep_empty else rows.where(F.col("term").isNotNull())


def term_bags(
    docs: DataFrame,
    tokenizer: Callable[[Column], Column] = tk.lex_alpha,
    id_col: str = "id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, total, bag, *keep)``: each document's counts ``(term, cnt)`` in its own row, by term."""
    return docs.select(id_col, *keep, tokenizer(F.col(text_col)).alias("_tokens")).select(
        id_col,
        F.size("_tokens").cast("bigint").alias("total"),
        tk.count_tokens(F.col("_tokens")).alias("bag"),
        *keep,
    )


def bag_counts(bags: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, total, term, cnt)`` from bags; an empty one gives a row with null term and count."""
    # The outer form, because Spark guards the inner one by a filter on the size
    # of the array, which would count every document's tokens a second time.
    return bags.select(id_col, "total", F.inline_outer("bag"))


def merged_bags(bags: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, total, bag)`` with the counts of all rows of an id added up."""
    sums = bag_counts(bags, id_col).groupBy(id_col, "term").agg(F.sum("cnt").alias("cnt"))
    pair = F.when(F.col("term").isNotNull(), F.struct("term", "cnt"))
    whole = sums.groupBy(id_col).agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total"), F.sort_array(F.collect_list(pair)).alias("bag"))
    return whole.select(id_col, F.col("total").cast("bigint").alias("total"), "bag")


def term_freq(docs: DataFrame, **how) -> DataFrame:
    """``(id, term, cnt)``."""
    return term_counts(docs, **how).drop("total")


def doc_total(
    docs: DataFrame,
    tokenizer: Callable[[Column], Column] = tk.lex_alpha,
    id_col: str = "id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, total)``: tokens per document."""
    return docs.select(id_col, F.size(tokenizer(F.col(text_col))).cast("bigint").alias("total"))


def doc_freq(counts: DataFrame) -> DataFrame:
    """``(term, df)`` from rows unique on (id, term); counted per task first."""
    return counts.where(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def doc_freq_from_text(
    docs: DataFrame, tokenizer: Callable[[Column], Column] = tk.lex_alpha, text_col: str = "text"
) -> DataFrame:
    """``(term, df)`` straight from text, when no term counts are wanted."""
    # The outer form for the same reason as in term_counts; doc_freq drops nulls.
    terms = docs.select(F.explode_outer(F.array_distinct(tokenizer(F.col(text_col)))).alias("term"))
    return doc_freq(terms)


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row ``n``: number of document rows, at least 1."""
    return docs.agg(F.greatest(F.lit(1), F.count(F.lit(1))).alias("n"))


def vocab_union(counts: DataFrame) -> DataFrame:
    """Distinct terms."""
    return counts.select("term").where(F.col("term").isNotNull()).distinct()
