"""Ranking documents for a batch of queries by cosine similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..functions import tokens as tk
from ..session import BROADCAST_MAX_ROWS, is_small, measure, stage
from .keys import ranked, top_k

# Fixed value: beyond this many values Parquet only sees the range of an IN list.
PRUNE_TERMS = 10
# A batch measured to be under these limits is scored inside the documents' rows.
ROW_BATCH_TERMS = 100_000
ROW_BATCH_BYTES = 8 * 1024 * 1024
# Scored pairs that a task holds before it goes back to its best k per query.
HELD_PAIRS = 500_000
# Records handed to Arrow kernels at a time.
SLICE_ROWS = 1024


def query_vector(
    queries: DataFrame,
    tokenizer: Callable[[Column], Column] = tk.tokenize_word,
    qid_col: str = "qid",
    query_col: str = "query",
) -> DataFrame:
    """``(qid, term, qw, qnorm)``: relative frequencies, no IDF.

    A query without tokens gives no rows. Counted inside each row, no shuffle.
    """
    counted = queries.select(F.col(qid_col).alias("qid"), tokenizer(F.col(query_col)).alias("_tokens")).select(
        "qid", F.size("_tokens").alias("_total"), tk.count_tokens(F.col("_tokens")).alias("_counts")
    )
    weighted = counted.select(
        "qid",
        F.transform(
            "_counts", lambda c: F.struct(c["term"].alias("term"), (c["cnt"] / F.col("_total")).alias("qw"))
        ).alias("_weights"),
    )
    # The norm in a step before the explode, else it is computed for every term.
    normed = weighted.select("qid", scores.norm(F.col("_weights.qw")).alias("qnorm"), "_weights")
    rows = normed.select("qid", "qnorm", F.inline_outer("_weights"))
    return rows.where(F.col("term").isNotNull()).select("qid", "term", "qw", "qnorm")


def postings_match(postings: DataFrame, qvec: DataFrame) -> DataFrame:
    """Postings of the query terms, one row per (query, document, shared term).

    A small batch is broadcast, so the postings are scanned in place; a larger
    one is joined by a shuffle that adaptive execution splits at hot terms.
    """
    rows, small = measure(qvec)
    if rows <= PRUNE_TERMS:
        terms = [r["term"] for r in qvec.select("term").limit(PRUNE_TERMS).collect()]
        postings = postings.where(F.col("term").isin(terms))
    return postings.join(F.broadcast(qvec) if small else qvec, "term")


def dot_product(matches: DataFrame, id_col: str = "id") -> DataFrame:
    """``(qid, id, dot, norm, qnorm, n_overlap)`` from matched postings."""
    return matches.groupBy("qid", id_col).agg(
        F.sum(F.col("w") * F.col("qw")).alias("dot"),
        F.max("norm").alias("norm"),
        F.max("qnorm").alias("qnorm"),
        F.count(F.lit(1)).alias("n_overlap"),
    )


def score(dots: DataFrame, digits: int | None = None) -> DataFrame:
    """Adds ``score`` and keeps positive ones; ``digits`` rounds before ranking."""
    scored = dots.withColumn("score", scores.cosine(F.col("dot"), F.col("norm"), F.col("qnorm"))).where(F.col("score") > 0)
    return scored if digits is None else scored.withColumn("score", F.round("score", digits))


def search_topk(scored: DataFrame, k: int = 10, id_col: str = "id") -> DataFrame:
    """Best ``k`` documents per query; ties go to the lower id."""
    return top_k(scored, ["qid"], [F.desc("score"), F.asc(id_col)], k)


def overlap_terms(matches: DataFrame, id_col: str = "id") -> DataFrame:
    """``(qid, id, terms, n)``: shared terms, sorted."""
    shared = matches.groupBy("qid", id_col).agg(F.sort_array(F.collect_set("term")).alias("terms"))
    return shared.withColumn("n", F.size("terms").cast("bigint"))


def overlap_in_rows(term_lists: DataFrame, qvec: DataFrame) -> DataFrame:
    """As :func:`overlap_terms`, for documents ``(id, terms)`` with one row each and a batch measured to be small.

    A document's terms are looked up in the batch in its row, so no match is shuffled.
    """
    names, vocab, counts, starts, q_of, _ = query_table(qvec)
    kinds = {f.name: f.dataType.simpleString() for f in [*term_lists.schema.fields, *qvec.schema.fields]}
    width = max(1, len(names))

    def shared(part: pa.RecordBatch) -> pa.RecordBatch:
        where = pc.index_in(pc.list_flatten(part.column(1)), value_set=vocab)
        hit = pc.is_valid(where)
        term = where.filter(hit).to_numpy().astype(np.int64)
        reps = counts[term]
        pos = np.repeat(starts[term] - np.cumsum(np.r_[0, reps[:-1]]), reps) + np.arange(reps.sum())
        doc = np.repeat(pc.list_parent_indices(part.column(1)).filter(hit).to_numpy().astype(np.int64), reps)
        # Terms are numbered in order, so one sort gives each pair its terms, sorted and once each.
        keyed = np.unique((doc * width + q_of[pos]) * max(1, len(vocab)) + np.repeat(term, reps))
        pair, term = keyed // max(1, len(vocab)), keyed % max(1, len(vocab))
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[first, len(pair)])
        terms = pa.ListArray.from_arrays(pa.array(np.r_[first, len(pair)].astype(np.int32)), vocab.take(pa.array(term)))
        qids = names.take(pa.array(pair[first] % width))
        ids = part.column(0).take(pa.array(pair[first] // width))
        return pa.RecordBatch.from_arrays([qids, ids, terms, pa.array(sizes)], names=["qid", "id", "terms", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield shared(batch.slice(start, SLICE_ROWS))

    columns = term_lists.select("id", "terms")
    return columns.mapInArrow(run, f"qid {kinds['qid']}, id {kinds['id']}, terms array<string>, n bigint")


def attach_meta(hits: DataFrame, docs: DataFrame, small_hits: bool, id_col: str = "id") -> DataFrame:
    """Hits with ``url`` and ``title``; every hit is a document.

    ``small_hits`` says that their number is known to be small: then they are
    broadcast and the documents are read in place.
    """
    return docs.select(id_col, "url", "title").join(F.broadcast(hits) if small_hits else hits, id_col)


def search(
    postings: DataFrame,
    docs: DataFrame,
    queries: DataFrame,
    k: int | None = 10,
    tokenizer: Callable[[Column], Column] = tk.tokenize_word,
    digits: int | None = None,
) -> DataFrame:
    """``(qid, rank, score, id, url, title)`` for ``queries(qid, query)``; ``k=None``: every hit."""
    qvec = query_vector(queries, tokenizer)
    scored = score(dot_product(postings_match(postings, qvec)), digits)
    if k is None:
        hits, few = ranked(scored.select("qid", "id", "score").withColumn("_s", -F.col("score")), ["qid"], ["_s", "id"]), False
    else:
        hits = search_topk(scored, k)
        # No more than k hits per query exist, so a short batch bounds the hits.
        few = is_small(queries.select("qid"), max_rows=BROADCAST_MAX_ROWS // max(k, 1))
    found = attach_meta(hits.select("qid", "rank", "score", "id"), docs, few)
    return found.select("qid", "rank", "score", "id", "url", "title")


def fits_rows(qvec: DataFrame) -> bool:
    """Whether a batch was measured to be small enough to be met in the documents' rows."""
    return is_small(qvec, ROW_BATCH_TERMS, ROW_BATCH_BYTES)


def query_table(qvec: DataFrame) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A small batch as arrays: its ids, its terms in order, and for the i-th term
    ``counts[i]`` places of queries and their weights, laid end to end from ``starts[i]``."""
    rows = qvec.toArrow()
    # A null id is the last one.
    ids = rows["qid"].combine_chunks()
    names = pc.unique(ids).take(pc.sort_indices(pc.unique(ids)))
    place = {q: i for i, q in enumerate(names.to_pylist())}
    table: dict[str, list[tuple[int, float]]] = {}
    for qid, term, qw, qnorm in zip(*(rows[c].to_pylist() for c in ("qid", "term", "qw", "qnorm"))):
        table.setdefault(term, []).append((place[qid], qw / qnorm))
    terms = sorted(table)
    counts = np.array([len(table[t]) for t in terms], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    q_of = np.array([i for t in terms for i, _ in table[t]], dtype=np.int64)
    w_of = np.array([w for t in terms for _, w in table[t]], dtype=np.float64)
    return names, pa.array(terms, pa.string()), counts, starts, q_of, w_of


def row_scores(qvec: DataFrame) -> tuple[pa.Array, Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The ids of a small batch, and a function from a slice of documents ``(id, terms,
    weights, norm)`` to document, query and score of the pairs with positive scores."""
    names, vocab, counts, starts, q_of, w_of = query_table(qvec)
    width = max(1, len(names))

    def scored(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse sums of one slice: only the coordinates that some query holds leave Arrow."""
        keys_, weights_ = part.column(1), part.column(2)
        flat = pc.list_flatten(keys_)
        where = pc.index_in(flat, value_set=vocab)
        hit = pc.is_valid(where)
        owner = pc.list_parent_indices(keys_).filter(hit).to_numpy().astype(np.int64)
        term = where.filter(hit).to_numpy().astype(np.int64)
        w = pc.list_flatten(weights_).filter(hit).to_numpy(zero_copy_only=False).astype(np.float64)
        norms = part.column(3).to_numpy(zero_copy_only=False)
        if owner.size == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        reps = counts[term]
        pos = np.repeat(starts[term] - np.cumsum(np.r_[0, reps[:-1]]), reps) + np.arange(reps.sum())
        doc = np.repeat(owner, reps)
        pair = doc * width + q_of[pos]
        contrib = np.repeat(w, reps) * w_of[pos]
        # Sums in the order of the document's terms, as a running sum would give.
        order = np.argsort(pair, kind="stable")
        pair, contrib = pair[order], contrib[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        dots = np.add.reduceat(contrib, first)
        pair = pair[first]
        doc, query = pair // width, pair % width
        norm = norms[doc]
        ok = (norm > 0) & (dots > 0)
        return doc[ok], query[ok], dots[ok] / norm[ok]

    return names, scored


def _columns(records: DataFrame, *keep: str) -> DataFrame:
    """What :func:`row_scores` reads. The norm is computed in the JVM over all terms; Python sees only the matching ones."""
    weights = F.map_values("tfidf")
    return records.select("id", F.map_keys("tfidf").alias("terms"), weights.alias("weights"), scores.norm(weights).alias("norm"), *keep)


def hits_in_rows(records: DataFrame, qvec: DataFrame) -> DataFrame:
    """``(qid, id, score, url, title)``: every hit of a small batch, from the documents' rows without a shuffle."""
    names, scored = row_scores(qvec)
    kinds = {f.name: f.dataType.simpleString() for f in [*records.schema.fields, *qvec.schema.fields]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                doc, query, value = scored(part)
                at = pa.array(doc)
                found = [names.take(pa.array(query)), part.column(0).take(at), pa.array(value)]
                yield pa.RecordBatch.from_arrays(
                    found + [part.column(i).take(at) for i in (4, 5)], names=["qid", "id", "score", "url", "title"]
                )

    schema = f"qid {kinds['qid']}, id {kinds['id']}, score double, url {kinds['url']}, title {kinds['title']}"
    return _columns(records, "url", "title").mapInArrow(run, schema)


def search_all(records: DataFrame, queries: DataFrame, tokenizer: Callable[[Column], Column] = tk.tokenize_word, digits: int | None = None) -> DataFrame:
    """Every hit ``(qid, rank, score, id, url, title)`` over index records of unique ids.

    The hits are staged with their URLs and titles: ranking is then the only shuffle.
    """
    qvec = query_vector(queries, tokenizer)
    if not fits_rows(qvec):
        normed = records.select("id", scores.norm(F.map_values("tfidf")).alias("norm"), "tfidf")
        rows = normed.select("id", "norm", F.explode_outer("tfidf").alias("term", "w")).where(F.col("term").isNotNull())
        return search(rows, records, queries, None, tokenizer, digits)
    found = hits_in_rows(records, qvec)
    if digits is not None:
        found = found.withColumn("score", F.round("score", digits))
    hits = ranked(stage(found.withColumn("_s", -F.col("score")), "hits"), ["qid"], ["_s", "id"])
    return hits.select("qid", "rank", "score", "id", "url", "title")


def best_in_rows(records: DataFrame, qvec: DataFrame, k: int, margin: float) -> DataFrame:
    """``(qid, id, score)``: each task's best ``k`` documents per query, with positive scores.

    A document is one row of ``records(id, tfidf)``, so its terms are looked up
    in the batch there and no (query, document) pair is shuffled before it was
    found to be among a task's best. Pairs within ``margin`` of the k-th stay,
    so rounding and ties are decided by the caller.
    """
    names, scored = row_scores(qvec)
    names = names.to_pylist()
    kinds = {f.name: f.dataType.simpleString() for f in records.schema.fields} | {f.name: f.dataType.simpleString() for f in qvec.schema.fields}
    held_pairs = HELD_PAIRS

    def best(query: np.ndarray, value: np.ndarray) -> np.ndarray:
        order = np.lexsort((-value, query))
        starts_ = np.flatnonzero(np.r_[True, query[order][1:] != query[order][:-1]])
        sizes = np.diff(np.r_[starts_, len(order)])
        kth = value[order][starts_ + np.minimum(sizes, k) - 1]
        return order[value[order] >= np.repeat(kth, sizes) - margin]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, query, value = [], [], []
        pending = 0

        def pruned():
            q, v = np.concatenate(query), np.concatenate(value)
            keep = best(q, v)
            return [ids[i] for i in keep.tolist()], q[keep], v[keep]

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                doc, got_q, got_v = scored(part)
                if not len(doc):
                    continue
                got_ids = part.column(0).take(pa.array(doc)).to_pylist()
                ids += got_ids
                query.append(got_q)
                value.append(got_v)
                pending += len(got_ids)
                if pending > held_pairs:
                    ids, q, v = pruned()
                    query, value, pending = [q], [v], 0
        if ids:
            ids, q, v = pruned()
            yield pa.RecordBatch.from_pydict({"qid": [names[i] for i in q.tolist()], "id": ids, "score": v})

    return _columns(records).mapInArrow(run, f"qid {kinds['qid']}, id {kinds['id']}, score double")


def search_records(
    records: DataFrame,
    queries: DataFrame,
    k: int = 10,
    tokenizer: Callable[[Column], Column] = tk.tokenize_word,
    digits: int | None = None,
    docs: DataFrame | None = None,
) -> DataFrame:
    """As :func:`search`, over index records ``(id, url, title, tfidf MAP)`` of unique ids.

    With ``docs`` a hit has the URL and title of each of its rows there. A batch of measured size is scored in the records' rows; a larger one goes
    through postings.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    qvec = query_vector(queries, tokenizer)
    if not fits_rows(qvec) or k == 0:
        normed = records.select("id", scores.norm(F.map_values("tfidf")).alias("norm"), "tfidf")
        rows = normed.select("id", "norm", F.explode_outer("tfidf").alias("term", "w")).where(F.col("term").isNotNull())
        return search(rows, records if docs is None else docs, queries, k, tokenizer, digits)
    margin = 1e-12 if digits is None else 10.0**-digits
    found = best_in_rows(records, qvec, k, margin)
    if digits is not None:
        found = found.withColumn("score", F.round("score", digits))
    few = is_small(queries.select("qid"), max_rows=BROADCAST_MAX_ROWS // max(k, 1))
    hits = attach_meta(search_topk(found, k).select("qid", "rank", "score", "id"), records if docs is None else docs, few)
    return hits.select("qid", "rank", "score", "id", "url", "title")
