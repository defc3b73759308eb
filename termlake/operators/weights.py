"""TF-IDF weights and document vectors."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from . import keys
from .keys import join_by_frequency

# Executors need not have this package installed: ship the lookups with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def weight_join(counts: DataFrame, vocab: DataFrame, n_docs: int) -> DataFrame:
    """Counts with their term's ``df`` and the corpus size ``n``."""
    return join_by_frequency(counts, vocab, "term", "df").withColumn("n", F.lit(n_docs).cast("bigint"))


def tfidf(counts: DataFrame, vocab: DataFrame, n_docs: int) -> DataFrame:
    """Adds ``tf``, ``idf`` and ``w`` to ``(id, total, term, cnt)``."""
    return (
        weight_join(counts, vocab, n_docs)
        .withColumn("tf", scores.tf_rel(F.col("cnt"), F.col("total")))
        .withColumn("idf", scores.idf(F.col("n"), F.col("df")))
        .withColumn("w", F.col("tf") * F.col("idf"))
    )


def vectors(weighted: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, n_terms, norm, tfidf)`` with one row per document.

    ``tfidf`` is an array of (term, w) sorted by term. A group is one
    document's own vocabulary, collected per task before the shuffle.
    """
    pair = F.when(F.col("term").isNotNull(), F.struct("term", "w"))
    return sized(weighted.groupBy(id_col).agg(F.sort_array(F.collect_list(pair)).alias("tfidf")), id_col)


def postings(vecs: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, norm, term, w)``, one row per document and term."""
    return vecs.select(id_col, "norm", F.inline_outer("tfidf")).where(F.col("term").isNotNull())


def doc_norm(weighted: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, norm)`` from weighted terms."""
    w = F.coalesce(F.col("w"), F.lit(0.0))
    return weighted.groupBy(id_col).agg(F.sqrt(F.sum(w * w)).alias("norm"))


def weigh_bags(bags: DataFrame, vocab: DataFrame, n_docs: int) -> DataFrame:
    """``bags(_row, id, total, bag, ...)`` with ``tfidf``, an array of (term, w), in place of total and bag.

    ``vocab`` has every term of the bags. A document stays in its row: the terms of
    several documents are looked up there, as many of the most frequent ones
    as a broadcast may hold; a term of one document needs no lookup. Only postings of the
    terms between are shuffled, and then the rows once, to meet what was found.
    """
    floor = keys.hot_floor(vocab, "term", "df", least=2)
    n = F.lit(n_docs).cast("bigint")
    valued = vocab.select("term", "df", scores.idf(n, F.col("df")).alias("idf"))
    hot = valued.where(F.col("df") >= floor) if floor is not None else valued.limit(0)
    table = hot.select("term", "idf").toArrow()
    shared = bags.sparkSession.sparkContext.broadcast((table["term"].combine_chunks(), table["idf"].combine_chunks()))
    once = bags.sparkSession.range(1).select(scores.idf(n, F.lit(1)).alias("idf")).first()["idf"]
    extra = [c for c in bags.columns if c not in ("total", "bag")]
    kinds = {f.name: f.dataType.simpleString() for f in bags.schema.fields}
    split = bags.select(*extra, "total", F.col("bag.term").alias("terms"), F.col("bag.cnt").alias("cnts"))

    if floor is None or floor > 2:
        rest = valued.where((F.col("df") > 1) & (F.lit(True) if floor is None else F.col("df") < floor))
        missed = split.select("_row", "terms").mapInArrow(_missed(shared), "_row bigint, term string")
        found = missed.join(rest.select("term", "idf"), "term").groupBy("_row")
        found = found.agg(F.collect_list("term").alias("rare"), F.collect_list("idf").alias("idfs"))
        split = split.join(found, "_row", "left")
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in extra] + ["tfidf array<struct<term:string,w:double>>"])
    return split.mapInArrow(_weigh(shared, once, extra), schema)


def _lookup(flat: pa.Array, terms: pa.Array, values: pa.Array) -> np.ndarray:
    """The value of each term, NaN where it has none."""
    if not len(terms):
        return np.full(len(flat), np.nan)
    return np.array(values.take(pc.index_in(flat, value_set=terms)).fill_null(np.nan))


def _missed(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, values = shared.value
        for batch in batches:
            rows, column = batch.column(0), batch.column(1)
            flat = pc.list_flatten(column)
            out = pa.array(np.isnan(_lookup(flat, terms, values)))
            owner = rows.take(pc.list_parent_indices(column).filter(out))
            yield pa.RecordBatch.from_arrays([owner, flat.filter(out)], names=["_row", "term"])

    return run


def _weigh(shared, once: float, extra: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, values = shared.value
        for batch in batches:
            column = batch.column("terms")
            flat, cnt = pc.list_flatten(column), pc.list_flatten(batch.column("cnts")).to_numpy()
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            idf = _lookup(flat, terms, values)
            if "rare" in batch.schema.names:
                rare, at = pc.list_flatten(batch.column("rare")), np.flatnonzero(np.isnan(idf))
                # A term has one idf, whichever row of the batch brought it.
                idf[at] = _lookup(flat.take(pa.array(at)), rare, pc.list_flatten(batch.column("idfs")))
            idf[np.isnan(idf)] = once
            w = cnt / np.repeat(batch.column("total").to_numpy(), sizes) * idf
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            tfidf = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([flat, pa.array(w)], names=["term", "w"]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in extra] + [tfidf], names=[*extra, "tfidf"])

    return run


def sized(weighed: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, n_terms, norm, tfidf)`` from rows ``(id, tfidf)``."""
    return weighed.select(
        id_col, F.size("tfidf").cast("bigint").alias("n_terms"), scores.norm(F.col("tfidf.w")).alias("norm"), "tfidf"
    )
