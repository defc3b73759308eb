"""Building an index."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..functions import urls
from ..operators import counts as C
from ..operators import weights as Wt
from ..operators.normalize import normalize_bags
from ..operators.search import search_records
from ..session import broadcast_if_small, stage
from ..sources import indexfiles, textfiles


@dataclass
class Index:
    """Lazy parts of an index. ``bags`` (one row per document) and ``vocab`` are staged tables."""

    docs: DataFrame
    bags: DataFrame
    vocab: DataFrame
    n_docs: int

    @property
    def counts(self) -> DataFrame:
        """``(id, total, term, cnt)``."""
        return C.bag_counts(self.bags)

    @cached_property
    def weighted(self) -> DataFrame:
        """``(id, total, term, cnt, df, n, tf, idf, w)``."""
        return Wt.tfidf(self.counts, self.vocab, self.n_docs).where(F.col("term").isNotNull())

    @cached_property
    def repeated(self) -> DataFrame | None:
        """Ids of more than one row; None when there are none."""
        again = self.bags.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        again = stage(again.select(F.col("id").alias("_id")), "repeated")
        return None if again.isEmpty() else again

    def _by_repetition(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ids that come once, and of those that come again."""
        again, same = broadcast_if_small(self.repeated), F.col("id").eqNullSafe(F.col("_id"))
        return rows.join(again, same, "left_anti"), rows.join(again, same, "left_semi")

    def _whole(self, rows: DataFrame, column: str) -> DataFrame:
        """``(id, column)``, one row per id: the arrays of its rows in one, sorted."""
        if self.repeated is None:
            return rows.select("id", column)
        once, again = self._by_repetition(rows.select("id", column))
        return once.unionByName(again.groupBy("id").agg(F.sort_array(F.flatten(F.collect_list(column))).alias(column)))

    @cached_property
    def _weighed(self) -> DataFrame:
        return Wt.weigh_bags(self.bags, self.vocab, self.n_docs)

    @property
    def vectors(self) -> DataFrame:
        """``(id, n_terms, norm, tfidf)``; empty documents included."""
        return Wt.sized(self._whole(self._weighed, "tfidf"))

    @property
    def term_lists(self) -> DataFrame:
        """``(id, terms)``; empty documents included."""
        return self._whole(self.bags.select("id", F.col("bag.term").alias("terms")), "terms")

    @property
    def postings(self) -> DataFrame:
        return Wt.postings(self.vectors)

    @property
    def records(self) -> DataFrame:
        """``(id, url, title, tfidf MAP)``, one row per row of ``docs``.

        All rows of an id have one vector, that of their texts together.
        """
        if self.repeated is not None:
            return self._merged.records
        if "url" not in self.bags.columns:
            return indexfiles.index_records(self.vectors, self.docs)
        return indexfiles.bag_records(self._weighed)

    @property
    def plain_records(self) -> DataFrame | None:
        """``records`` with titles as they are; None unless each id has one row of its own URL and title."""
        if self.repeated is not None or "url" not in self.bags.columns:
            return None
        return indexfiles.bag_records(self._weighed, blank=False)

    @property
    def keyed(self) -> DataFrame:
        """``records`` with one row per id."""
        if self.repeated is None:
            return self.records
        meta = F.struct("url", "title")
        one = self.docs.groupBy("id").agg(F.min(meta).alias("_m")).select("id", "_m.*")
        return indexfiles.index_records(self._merged.vectors, one)

    @cached_property
    def _merged(self) -> Index:
        """The same index with one bag per id."""
        once, again = self._by_repetition(self.bags.select("id", "total", "bag"))
        merged = index_bags(self.docs, once.unionByName(C.merged_bags(again)), self.n_docs)
        merged.__dict__["repeated"] = None
        return merged


def document_ids(pages: DataFrame, *keep: str) -> DataFrame:
    """``(id, url, title, text)`` from extracted pages."""
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("title", "text")]
    return pages.select(urls.doc_id(F.col("url")).alias("id"), "url", *blank, *keep)


def index_bags(docs: DataFrame, bags: DataFrame, n_docs: int) -> Index:
    """Index from ``bags(id, total, bag)`` and, where ``docs`` has the same rows, ``url`` and ``title``.

    The bags are staged once; the vocabulary then reads one column of them.
    """
    bags = stage(bags.withColumn("_row", F.monotonically_increasing_id()), "bags")
    vocab = C.doc_freq(bags.select(F.explode_outer("bag.term").alias("term")))
    return Index(docs, bags, stage(vocab, "vocab"), n_docs)


def index_docs(
    docs: DataFrame,
    tokenizer: Callable[[Column], Column] = tk.lex_alpha,
    unique_ids: bool = False,
    order: str | None = None,
) -> Index:
    """Index of ``docs(id, url, title, text)``.

    N counts rows; of several rows with one id the last by ``order`` is indexed.
    ``unique_ids`` says that there are none, which saves a shuffle of the texts.
    """
    n_docs = max(1, docs.count())
    if not unique_ids:
        docs = stage(C.unique_docs(docs, order), "unique_docs")
    return index_bags(docs.drop("text"), C.term_bags(docs, tokenizer, keep=("url", "title")), n_docs)


def write_all(index: Index, docs: DataFrame, out_dir: str) -> None:
    """Writes ``docs``, ``tfidf_index`` (JSON lines), ``tfidf_keyed`` and
    ``postings`` (Parquet) below ``out_dir``. The weights are computed once: the
    last three follow from the keyed table."""
    indexfiles.write_docs(docs, f"{out_dir}/docs")
    records = index.keyed
    indexfiles.write_index_keyed(records, f"{out_dir}/tfidf_keyed")
    keyed = docs.sparkSession.read.schema(records.schema).parquet(f"{out_dir}/tfidf_keyed")
    indexfiles.write_index(keyed, f"{out_dir}/tfidf_index")
    indexfiles.write_postings(indexfiles.record_postings(keyed), f"{out_dir}/postings")


def build_index(
    pages: DataFrame,
    out_dir: str | None = None,
    tokenizer: Callable[[Column], Column] = tk.lex_alpha,
    unique_ids: bool = False,
    order: str | None = None,
) -> Index:
    """Index of extracted pages ``(url, title, text)``; written when ``out_dir`` is given."""
    docs = document_ids(pages, *([order] if order else []))
    if out_dir is not None:
        # Read several times below; the pages may still have to be parsed.
        docs = stage(docs, "docs")
    index = index_docs(docs, tokenizer, unique_ids, order)
    if out_dir is not None:
        write_all(index, docs, out_dir)
    return index


def build_index_files(
    manifest: DataFrame,
    root: str,
    stopwords: DataFrame | Iterable[str] = (),
    lemmas: DataFrame | None = None,
    min_len: int = 2,
    packed: bool = False,
) -> Index:
    """Index of text files with normalized terms; ``docs`` is ``(id, url, title, path)`` with the path as URL.

    ``packed``: the files were written by :func:`textfiles.write_packed`.
    """
    docs = textfiles.read_text_docs(manifest, root, packed)
    docs = docs.select("id", F.col("path").alias("url"), F.lit("").alias("title"), "text")
    bags = normalize_bags(docs, stopwords, lemmas, min_len, keep=("url", "title"))
    listed = manifest.select("id", F.col("path").alias("url"), F.lit("").alias("title"), "path")
    return index_bags(listed, bags, max(1, manifest.count()))


def search_index(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int = 10,
    whole: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Searches the index file or folder ``path``, of any shape that the lenient reader takes.

    The records are read once and staged; hits are ``(qid, rank, score, id, url, title)``.
    """
    records = stage(indexfiles.read_index(spark, path, whole), "read-index")
    return search_records(records, queries, k, digits=digits)
