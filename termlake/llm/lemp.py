"""Ranked lexical search with LEMP-style norm buckets and exact integer scores.

A document's impact vector holds, for each of its terms,
``(10^9 tf) div (1000 tf + 12 m)`` with ``m = 75 + (25 n N) div L``; it is built in
the document's row and never regrouped. Its norm is that of all its terms, but only
the terms of some query are written, for no other can add to a score. A query's vector holds ``c * w`` for a
term seen c times, ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``. A score is the
integer inner product of the two.

The index is range-partitioned by the vectors' norms, falling, so a task holds a
bucket of similar lengths and reads it longest first. For each query the task
keeps the best k so far; a query is dropped for the rest of the bucket once
``|q| |d|`` (Cauchy-Schwarz) falls below its k-th score, a document is skipped
for a query when the bound through the query's heaviest coordinate can't reach
it, and only the survivors are scored, exactly, in integers. A first pass over
the longest vectors gives every task a threshold to start from. Each task then
hands on at most k rows of each query, and the last ranking keeps k.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.tokens import count_tokens
from ..session import is_small, stage
from .batches import bound_batches

# Fixed values of the contract: a term is a maximal run outside these ASCII ranges.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 20
# Longest vectors scored first to give every task a starting threshold.
SEED_DOCS = 256
# Rows handed to Python at a time; texts differ in length by a factor of 10,000.
SLICE = 256
# Queries handed to the tasks at a time (their terms and weights go with the plan).
QUERY_BLOCK = 1024
# Most terms of queries that are broadcast, so that only these are written for each document.
WANTED = 200_000
# Relative slack on floating bounds, so that no exact integer score is pruned.
SLACK = 1e-9


def terms(text: Column) -> Column:
    """The terms of a text: maximal runs of the class above, only A-Z lower-cased; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _count(wanted):
    """``(doc_id, n, freqs, terms, cnts)`` of each text, in Arrow kernels and numpy, slices of rows.

    Texts are split on maximal runs of the excluded ASCII ranges, so the pieces
    left are the terms; (row, term) pairs are counted by one sort of codes. ``freqs`` says
    how many terms occur how often, which is all that the norm needs. With ``wanted``, a
    broadcast of terms, only these are listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                low = pc.ascii_lower(pc.fill_null(part.column("t"), ""))
                pieces = pc.split_pattern_regex(low, pattern=SEPARATOR)
                flat = pc.list_flatten(pieces)
                owner = pc.list_parent_indices(pieces)
                keep = pc.greater(pc.binary_length(flat), 0)
                flat, owner = flat.filter(keep), owner.filter(keep).to_numpy().astype(np.int64)
                coded = pc.dictionary_encode(flat)
                words = coded.dictionary
                pair = owner * max(1, len(words)) + coded.indices.to_numpy().astype(np.int64)
                unique, cnts = np.unique(pair, return_counts=True)
                rows, word = unique // max(1, len(words)), unique % max(1, len(words))
                ends = np.arange(part.num_rows + 1)
                span = int(cnts.max(initial=0)) + 1
                code, times = np.unique(rows * span + cnts, return_counts=True)
                pairs = pa.StructArray.from_arrays([pa.array((code % span).astype(np.int64)), pa.array(times.astype(np.int64))], names=["cnt", "times"])
                freqs = _lists(np.searchsorted(code // span, ends), pairs)
                if wanted is not None:
                    listed = pc.is_in(words, value_set=wanted.value).to_numpy(zero_copy_only=False)[word]
                    rows, word, cnts = rows[listed], word[listed], cnts[listed]
                offsets = np.searchsorted(rows, ends)
                n = np.bincount(owner, minlength=part.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), freqs, _lists(offsets, words.take(pa.array(word))), _lists(offsets, pa.array(cnts.astype(np.int64)))],
                    names=["doc_id", "n", "freqs", "terms", "cnts"],
                )

    return run


def impact_index(documents: DataFrame, key: str = "doc_id", text: str = "text", wanted: DataFrame | None = None) -> tuple[DataFrame, int, int]:
    """``(index, N, L)``: index rows ``(doc_id, norm, terms, imps)`` of documents with terms.

    Every row of ``documents`` is a document, repeated rows and null ids
    included. Terms are counted in the document's row; the counts are written
    once to the shared folder. ``wanted``, a table of distinct terms, is for searches that know
    theirs: the norm and L are still those of all terms, but only the wanted ones are written and listed, if
    they are few enough for a broadcast.
    """
    texts = bound_batches(documents).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t"))
    shared = None
    if wanted is not None and is_small(wanted, WANTED):
        shared = documents.sparkSession.sparkContext.broadcast(wanted.toArrow().column(0).combine_chunks().cast(pa.string()))
    counted = texts.mapInArrow(_count(shared), "doc_id bigint, n bigint, freqs array<struct<cnt:bigint,times:bigint>>, terms array<string>, cnts array<bigint>")
    counted = stage(counted.where(F.col("n") > 0), "lemp-counts")
    got = counted.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    big_n, big_l = int(got["N"]), int(got["L"] or 0)
    if big_n == 0:
        return counted.select("doc_id", F.lit(0.0).alias("norm"), "terms", F.col("cnts").alias("imps")), 0, 0
    # Integer division of longs, as the contract has it (all terms are positive).
    counted = counted.withColumn("m", F.expr(f"75 + (25 * n * {big_n}L) div {big_l}L"))

    def impact(c: str) -> str:
        return f"((1000000000L * {c}) div (1000L * {c} + 12L * m))"

    square = F.expr(f"aggregate(freqs, 0D, (s, f) -> s + f.times * double({impact('f.cnt')}) * double({impact('f.cnt')}))")
    return counted.select("doc_id", F.sqrt(square).alias("norm"), "terms", F.expr(f"transform(cnts, c -> {impact('c')})").alias("imps")), big_n, big_l


def query_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(qid, item_id, term, cnt)`` of the distinct (item_id, text) rows, written."""
    distinct = items.select(F.col(key).alias("item_id"), F.col(text).alias("t")).distinct()
    distinct = distinct.withColumn("qid", F.xxhash64("item_id", "t"))
    counted = distinct.select("qid", "item_id", F.explode(count_tokens(terms(F.col("t")))).alias("c"))
    return stage(counted.select("qid", "item_id", F.col("c.term").alias("term"), F.col("c.cnt").alias("cnt")), "lemp-qterms")


def query_vectors(qterms: DataFrame, index: DataFrame, big_n: int) -> DataFrame:
    """``(qid, item_id, terms, qv)``: the queries with their weighted terms.

    ``df`` is counted only for the terms that some query holds: the doc terms
    are semi-joined to that set, then counted per task before the shuffle.
    """
    wanted = qterms.select("term").distinct()
    df = index.select(F.explode("terms").alias("term")).join(wanted, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * big_n + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("bigint")
    weighted = qterms.join(df, "term", "left").select("qid", "item_id", "term", (F.col("cnt") * F.coalesce(weight, F.lit(0))).alias("qv"))
    return weighted.where(F.col("qv") > 0).groupBy("qid", "item_id").agg(
        F.collect_list("term").alias("terms"), F.collect_list("qv").alias("qv")
    )


def _scorer(block: list[dict], thresholds: dict[int, int], k: int):
    """A task function over index batches sorted by norm, falling."""
    by_term: dict[str, list[tuple[int, int]]] = {}
    qnorm, focus, rest_norm = [], [], []
    for qi, q in enumerate(block):
        pairs = list(zip(q["terms"], q["qv"]))
        for t, v in pairs:
            by_term.setdefault(t, []).append((qi, int(v)))
        qnorm.append(math.sqrt(sum(float(v) * v for _, v in pairs)))
        ft, fv = max(pairs, key=lambda p: (p[1], p[0]))
        focus.append((ft, int(fv)))
        rest_norm.append(math.sqrt(max(0.0, sum(float(v) * v for _, v in pairs) - float(fv) * fv)))
    seed = [thresholds.get(q["qid"], 0) for q in block]
    vocab = pa.array(sorted(by_term), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list] = [[] for _ in block]
        active = set(range(len(block)))

        def floor_of(qi: int) -> int:
            h = heaps[qi]
            return max(seed[qi], h[0][0]) if len(h) >= k else seed[qi]

        for part in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            if not active:
                break
            norms = part.column("norm").to_pylist()
            if not norms:
                continue
            # Bucket bound: rows come longest first, so a query cut at a batch's
            # longest vector stays cut for the rest of the task.
            top = norms[0]
            for qi in [q for q in active if qnorm[q] * top * (1 + SLACK) + 1 < floor_of(q)]:
                active.discard(qi)
            if not active:
                break
            # Only the coordinates that some query has reach Python.
            flat = pc.list_flatten(part.column("terms"))
            hit = pc.is_in(flat, value_set=vocab)
            owner = pc.list_parent_indices(part.column("terms")).filter(hit).to_numpy()
            hit_terms = flat.filter(hit).to_pylist()
            hit_imps = pc.list_flatten(part.column("imps")).filter(hit).to_pylist()
            ids = part.column("doc_id").to_pylist()
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            for row in np.nonzero(bounds[1:] > bounds[:-1])[0].tolist():
                doc_id, norm = ids[row], norms[row]
                lo_, hi_ = bounds[row], bounds[row + 1]
                vec = dict(zip(hit_terms[lo_:hi_], hit_imps[lo_:hi_]))
                touched = {qi for t in vec for qi, _ in by_term[t] if qi in active}
                order_key = -doc_id if doc_id is not None else -(1 << 63) - 1
                for qi in touched:
                    need = floor_of(qi)
                    if qnorm[qi] * norm * (1 + SLACK) + 1 < need:
                        continue
                    ft, fv = focus[qi]
                    df_ = vec.get(ft, 0)
                    # Coordinate bound through the heaviest term of the query.
                    bound = fv * df_ + rest_norm[qi] * math.sqrt(max(0.0, norm * norm - float(df_) * df_))
                    if bound * (1 + SLACK) + 1 < need:
                        continue
                    score = 0
                    for t, v in zip(block[qi]["terms"], block[qi]["qv"]):
                        got = vec.get(t)
                        if got:
                            score += int(v) * got
                    if score <= 0 or score < need:
                        continue
                    entry = (score, order_key, doc_id)
                    if len(heaps[qi]) < k:
                        heapq.heappush(heaps[qi], entry)
                    elif entry > heaps[qi][0]:
                        heapq.heapreplace(heaps[qi], entry)
        qids, ids, scores = [], [], []
        for qi, h in enumerate(heaps):
            for score, _, doc_id in h:
                qids.append(block[qi]["qid"]), ids.append(doc_id), scores.append(score)
        if qids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(qids, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["qid", "doc_id", "score"]
            )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("qid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = K, doc_key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """The ``k`` highest-scoring documents of every item: ``(item_id, rank, doc_id, score)``.

    Only scores above 0 are ranked; equal scores go by ascending doc_id (null
    last). Each distinct (item_id, text) is a query of its own; repeated rows of
    documents are documents of their own. Null and empty texts have no terms;
    an item without terms, an empty table or one without terms gives no rows.
    Extra columns are ignored.
    """
    spark = documents.sparkSession
    empty = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    qterms = query_terms(items, item_key)
    index, big_n, _ = impact_index(documents, doc_key, wanted=qterms.select("term").distinct())
    if big_n == 0:
        return empty
    queries = stage(query_vectors(qterms, index, big_n), "lemp-queries")
    parts = max(1, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Range blocks by norm, falling; a tie-breaker splits equal norms over blocks. The sort reads the
    # rows twice and a document without a listed term scores nothing.
    scored = stage(index.where(F.size("terms") > 0), "lemp-index")
    buckets = stage(
        scored.repartitionByRange(parts, F.desc("norm"), F.xxhash64("doc_id", "terms")).sortWithinPartitions(F.desc("norm")),
        "lemp-buckets",
    )
    out = []
    ids = [r["qid"] for r in queries.select("qid").collect()]
    for start in range(0, len(ids), QUERY_BLOCK):
        chosen = queries.where(F.col("qid").isin(ids[start : start + QUERY_BLOCK]))
        block = [r.asDict() for r in chosen.collect()]
        schema = "qid bigint, doc_id bigint, score bigint"
        # The longest vectors: each task hands on its own first SEED_DOCS, then one task keeps SEED_DOCS.
        seed_rows = buckets.orderBy(F.desc("norm"), F.xxhash64("doc_id", "terms")).limit(SEED_DOCS).coalesce(1).sortWithinPartitions(F.desc("norm"))
        seeded = _ranked(seed_rows.mapInArrow(_scorer(block, {}, k), schema), k).where(F.col("rank") == k).collect()
        thresholds = {r["qid"]: r["score"] for r in seeded}
        found = buckets.mapInArrow(_scorer(block, thresholds, k), schema)
        out.append(_ranked(found, k).join(F.broadcast(chosen.select("qid", "item_id")), "qid"))
    if not out:
        return empty
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
