"""Statistics of an index of document vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .keys import top_k


def vocab_size(vecs: DataFrame) -> DataFrame:
    """One row ``(n_docs, n_terms)``; the term count is exact."""
    docs = vecs.agg(F.count(F.lit(1)).alias("n_docs"))
    terms = vecs.select(F.explode("tfidf.term").alias("term")).distinct().agg(F.count(F.lit(1)).alias("n_terms"))
    return docs.select("n_docs", terms.scalar().alias("n_terms"))


def index_size(bags: DataFrame, vocab: DataFrame) -> DataFrame:
    """As :func:`vocab_size`, from the counted documents ``(id, ...)`` and their distinct terms: no weights are needed."""
    docs = bags.select("id").distinct().agg(F.count(F.lit(1)).alias("n_docs"))
    return docs.select("n_docs", vocab.agg(F.count(F.lit(1)).alias("n_terms")).scalar().alias("n_terms"))


def terms_per_doc(vecs: DataFrame, id_col: str = "id") -> DataFrame:
    return vecs.select(id_col, "n_terms")


def largest_docs(vecs: DataFrame, n: int = 3, id_col: str = "id") -> DataFrame:
    """The ``n`` documents with most terms; ties go to the lower id."""
    return vecs.orderBy(F.desc("n_terms"), F.asc(id_col)).limit(n)


def top_terms(weighted: DataFrame, n: int = 10, id_col: str = "id") -> DataFrame:
    """The ``n`` heaviest terms of each document with their rank."""
    return top_k(weighted, [id_col], [F.desc("w"), F.asc("term")], n)


def inspect_index(vecs: DataFrame, docs: DataFrame, n: int = 3, terms: int = 10, digits: int = 6) -> DataFrame:
    """Index report in long form ``(part, rank, id, url, term, value)``.

    Parts: ``total_docs``, ``vocab_size``, ``n_terms`` of the largest documents
    and their ``top_term`` weights.
    """
    none = F.lit(None).cast("string")
    # Each part reads the vectors.
    vecs = stage(vecs, "vectors")
    sizes = vocab_size(vecs)

    def single(part: str, column: str) -> DataFrame:
        return sizes.select(
            F.lit(part).alias("part"), F.lit(1).alias("rank"), none.alias("id"), none.alias("url"),
            none.alias("term"), F.col(column).cast("double").alias("value"),
        )

    # n rows at most from here on.
    big = largest_docs(vecs, n).join(docs.select("id", "url"), "id", "left")
    order = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("n_terms"), F.asc("id")))
    largest = big.select(
        F.lit("n_terms").alias("part"), order.alias("rank"), F.col("id").cast("string").alias("id"), "url",
        none.alias("term"), F.col("n_terms").cast("double").alias("value"),
    )
    pairs = big.select("id", "url", F.inline("tfidf")).withColumn("w", F.round("w", digits))
    heavy = top_terms(pairs, terms).select(
        F.lit("top_term").alias("part"), "rank", F.col("id").cast("string").alias("id"), "url",
        "term", F.col("w").alias("value"),
    )
    report = single("total_docs", "n_docs").unionByName(single("vocab_size", "n_terms"))
    return report.unionByName(largest).unionByName(heavy)
