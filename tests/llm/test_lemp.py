"""LEMP search against a plain restatement of the scores, on the given tables and on odd rows."""

import math
import re
from collections import Counter

import duckdb

from termlake.llm import lemp
from termlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    low = (text or "").translate(str.maketrans(lemp.UPPER, lemp.LOWER))
    return TERM.findall(low)


def brute(docs, items, k=20):
    vecs = [(i, Counter(words(t))) for i, t in docs]
    vecs = [(i, c) for i, c in vecs if c]
    big_n, big_l = len(vecs), sum(sum(c.values()) for _, c in vecs)
    df = Counter(t for _, c in vecs for t in c)
    out = set()
    for item, text in set(items):
        q = Counter(words(text))
        scored = []
        for i, c in vecs:
            n = sum(c.values())
            m = 75 + (25 * n * big_n) // big_l
            s = sum(q[t] * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in q if t in c)
            if s > 0:
                scored.append((-s, i if i is not None else float("inf"), i, s))
        for rank, (_, _, i, s) in enumerate(sorted(scored)[:k], 1):
            out.add((item, rank, i, s))
    return out


def test_query_equals_sql(scratch):
    got = {tuple(r) for r in QUERIES["op11_lemp"](scratch, SF).collect()}
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = {tuple(r) for r in con.execute(ORACLE["op11_lemp"]).fetchall()}
    assert got == want and len(got) > 0


def test_odd_rows(scratch, odd_docs, no_docs):
    items = scratch.createDataFrame(
        [(1, "stone river"), (1, "stone river"), (2, None), (3, "ÄÖ café STONE!! 42"), (4, "zzzz"), (5, "the the the")],
        "item_id bigint, text string",
    ).withColumn("rank", lemp.F.lit("x"))
    got = {tuple(r) for r in lemp.search(odd_docs, items, k=3).collect()}
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    want = brute(docs, [(r["item_id"], r["text"]) for r in items.collect()], k=3)
    assert got == want and len(got) > 0
    assert lemp.search(no_docs, items).count() == 0
    assert lemp.search(odd_docs, items.where("item_id < 0")).count() == 0


def test_ties_and_pruning(scratch):
    # Many equal documents tie; the lowest ids must win, whatever the buckets.
    docs = [(i, "alpha beta gamma " * (1 + i % 3)) for i in range(300)] + [(1000 + i, "delta " * (i + 1)) for i in range(50)]
    df = scratch.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    items = scratch.createDataFrame([(1, "alpha"), (2, "delta delta gamma"), (3, "omega")], "item_id bigint, text string")
    got = {tuple(r) for r in lemp.search(df, items, k=5).collect()}
    assert got == brute(docs, [(1, "alpha"), (2, "delta delta gamma"), (3, "omega")], k=5)


def test_only_terms_of_queries_are_written(scratch, monkeypatch):
    docs = [(i, " ".join([f"w{i}x{k}" for k in range(40)] + ["alpha"] * (i % 4) + ["beta"])) for i in range(60)]
    df = scratch.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    rows = [(1, "alpha w3x5"), (2, "Beta beta")]
    items = scratch.createDataFrame(rows, "item_id bigint, text string")
    written, stage = [], lemp.stage

    def watched(table, label):
        written.append(stage(table, label))
        return written[-1]

    monkeypatch.setattr(lemp, "stage", watched)
    assert {tuple(r) for r in lemp.search(df, items, k=5).collect()} == brute(docs, rows, k=5)
    # Whole vectors of 41 terms, written three times, filled the disk.
    assert max(len(r["terms"]) for t in written if "doc_id" in t.columns for r in t.collect()) <= 3
    # Too many terms for a broadcast: every term is kept, with the same result.
    monkeypatch.setattr(lemp, "WANTED", 1)
    assert {tuple(r) for r in lemp.search(df, items, k=5).collect()} == brute(docs, rows, k=5)
