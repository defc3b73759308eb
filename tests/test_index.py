import json
import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termlake.functions import tokens as tk
from termlake.operators import keys, search, stats
from termlake.operators import weights as Wt
from termlake.plans import index
from termlake.sources import indexfiles, textfiles

TINY = [
    ("1", "https://a.org/1", "One", "the cat sat on the mat"),
    ("2", "https://a.org/2", "Two", "The dog; the CAT!"),
    ("3", "https://a.org/3", "Three", ""),
]
DOCS = "id string, url string, title string, text string"


def plain_index(docs):
    """The formulas in plain Python: id -> {term: weight}."""
    counts = {d[0]: Counter(t for t in "".join(c if "a" <= c <= "z" else " " for c in d[3].lower()).split()) for d in docs}
    df = Counter(t for c in counts.values() for t in c)
    n = max(1, len(docs))
    return {
        i: {t: k / sum(c.values()) * math.log(1 + n / df[t]) for t, k in c.items()} for i, c in counts.items()
    }


def collected(vecs):
    return {r["id"]: {p["term"]: p["w"] for p in r["tfidf"]} for r in vecs.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for i in a:
        assert a[i].keys() == b[i].keys()
        for t in a[i]:
            assert a[i][t] == pytest.approx(b[i][t], rel=1e-12)


def random_docs(n=40, seed=3):
    rng = random.Random(seed)
    vocab = ["w" + "abcdefghij"[i % 10] * (1 + i // 10) for i in range(60)]
    # One term is in every document, and documents differ a lot in length.
    return [
        (f"d{i:02}", f"https://r.org/{i}", f"t{i}", "all " + " ".join(rng.choices(vocab, k=rng.randint(0, 80))))
        for i in range(n)
    ]


def test_vectors_match_plain_python(spark):
    for docs in (TINY, random_docs()):
        ix = index.index_docs(spark.createDataFrame(docs, DOCS))
        close(collected(ix.vectors), plain_index(docs))


def test_one_page_example(spark):
    ix = index.index_docs(spark.createDataFrame([("x", "u", "t", "Boats leave at noon.")], DOCS))
    assert collected(ix.vectors)["x"] == pytest.approx(dict.fromkeys(("boats", "leave", "at", "noon"), math.log(2) / 4))
    queries = spark.createDataFrame([(1, "when boats leave")], "qid long, query string")
    (hit,) = search.search(ix.postings, ix.docs, queries).collect()
    # Two of three query words meet two of four equal weights.
    assert hit["score"] == pytest.approx(2 / math.sqrt(12)) and hit["rank"] == 1


def test_duplicate_ids_keep_the_last_and_count_every_row(spark):
    rows = [("a", "u", "t", "old words", 1), ("a", "u", "t", "new", 2), ("b", "v", "t", "new", 3)]
    ix = index.index_docs(spark.createDataFrame(rows, DOCS + ", at int"), order="at")
    got = collected(ix.vectors)
    assert set(got["a"]) == {"new"}
    assert got["a"]["new"] == pytest.approx(math.log(1 + 3 / 2))


def test_split_join_equals_plain_join(spark, monkeypatch):
    docs = random_docs(60)
    ix = index.index_docs(spark.createDataFrame(docs, DOCS))
    total = ix.vocab.agg(F.sum("df")).first()[0]
    want = sorted(map(tuple, ix.counts.join(ix.vocab, "term", "left").select("id", "term", "cnt", "df").collect()), key=str)
    for hot in (1, 20, 10_000):
        monkeypatch.setattr(keys, "HOT_KEYS", hot)
        got = keys.split_join(ix.counts, ix.vocab, "term", "df", total).select("id", "term", "cnt", "df").collect()
        assert sorted(map(tuple, got), key=str) == want


def test_large_vocabulary_takes_the_split_join(spark, monkeypatch):
    docs = random_docs(30)
    monkeypatch.setattr(keys, "BROADCAST_MAX_ROWS", 5)
    monkeypatch.setattr(keys, "HOT_KEYS", 20)
    close(collected(index.index_docs(spark.createDataFrame(docs, DOCS)).vectors), plain_index(docs))


def test_ranked_is_exact_for_hot_groups(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}", rng.randint(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = {r["i"]: r["rank"] for r in keys.ranked(df, ["k"], ["v", "i"]).collect()}
    for k in {r[0] for r in rows}:
        group = sorted((v, i) for kk, v, i in rows if kk == k)
        assert [got[i] for _, i in group] == list(range(1, len(group) + 1))
    overall = {r["i"]: r["rank"] for r in keys.ranked(df, [], ["v", "i"]).collect()}
    assert [overall[i] for _, i in sorted((v, i) for _, v, i in rows)] == list(range(1, len(rows) + 1))


def test_top_k_beyond_the_group_limit(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id")
    want = sorted(map(tuple, keys.top_k(df, ["g"], [F.desc("id")], 40).collect()))
    monkeypatch.setattr(keys, "GROUP_LIMIT", 10)
    assert sorted(map(tuple, keys.top_k(df, ["g"], [F.desc("id")], 40).collect())) == want
    with pytest.raises(ValueError):
        keys.top_k(df, ["g"], [F.desc("id")], -1)


def unit(vector):
    """The vector at length 1; a zero vector stays."""
    length = math.hypot(*vector.values())
    return {term: x / length for term, x in vector.items()} if length else vector


def angle(one, two):
    """Cosine from the definition: the inner product of unit vectors."""
    one, two = unit(one), unit(two)
    return math.fsum(one[term] * two[term] for term in one.keys() & two.keys())


def test_search_matches_plain_python(spark, monkeypatch):
    docs = random_docs(50, seed=9)
    ix = index.index_docs(spark.createDataFrame(docs, DOCS))
    texts = ["wa wbb wbb", "all", "", "nothing known", "Wa's 42 wcc", "all żółw wdd", "wa wa wa"]
    queries = spark.createDataFrame(list(enumerate(texts)), "qid long, query string")
    hits = search.search(ix.postings, ix.docs, queries, k=7).collect()
    key = lambda h: (h["qid"], h["rank"])
    for held in (search.HELD_PAIRS, 5):
        monkeypatch.setattr(search, "HELD_PAIRS", held)
        found = search.search_records(ix.records, queries, k=7)
        assert "Exchange hashpartitioning(qid" not in search.best_in_rows(ix.records, search.query_vector(queries), 7, 0.0)._jdf.queryExecution().toString()
        rows = sorted(found.collect(), key=key)
        assert [(key(h), h["id"]) for h in rows] == [(key(h), h["id"]) for h in sorted(hits, key=key)]
        assert [h["score"] for h in rows] == pytest.approx([h["score"] for h in sorted(hits, key=key)])
    monkeypatch.setattr(search, "ROW_BATCH_TERMS", 1)
    assert sorted(search.search_records(ix.records, queries, k=7).collect(), key=key) == sorted(hits, key=key)
    plain = plain_index(docs)
    for qid, text in enumerate(texts):
        toks = [t for t in __import__("re").split(r"[^\w']+", text.lower()) if t]
        qv = {t: c / len(toks) for t, c in Counter(toks).items()}
        want = sorted(((angle(qv, v), i) for i, v in plain.items() if set(qv) & set(v)), key=lambda x: (-x[0], x[1]))
        want = [(s, i) for s, i in want if s > 0][:7]
        got = sorted((h for h in hits if h["qid"] == qid), key=lambda h: h["rank"])
        assert [h["rank"] for h in got] == list(range(1, len(want) + 1))
        assert [h["score"] for h in got] == pytest.approx([s for s, _ in want])
        assert {h["id"]: (h["url"], h["title"]) for h in got} == {
            d[0]: (d[1], d[2]) for d in docs if d[0] in {h["id"] for h in got}
        }


def test_query_tokenizer_can_follow_the_index(spark):
    ix = index.index_docs(spark.createDataFrame(TINY, DOCS))
    queries = spark.createDataFrame([(1, "cat's")], "qid long, query string")
    assert search.search(ix.postings, ix.docs, queries).count() == 0
    assert search.search(ix.postings, ix.docs, queries, tokenizer=tk.lex_alpha).count() == 2


def test_large_query_batches_are_not_broadcast(spark, monkeypatch):
    ix = index.index_docs(spark.createDataFrame(TINY, DOCS))
    queries = spark.createDataFrame([(i, "the cat") for i in range(20)], "qid long, query string")
    want = sorted(map(tuple, search.search(ix.postings, ix.docs, queries).collect()))
    monkeypatch.setattr(search, "measure", lambda df: (10**9, False))
    monkeypatch.setattr(search, "is_small", lambda df, **k: False)
    assert sorted(map(tuple, search.search(ix.postings, ix.docs, queries).collect())) == want


def test_inspect_index(spark):
    ix = index.index_docs(spark.createDataFrame(TINY, DOCS))
    rows = stats.inspect_index(ix.vectors, ix.docs, n=2).collect()
    value = {(r["part"], r["rank"], r["id"], r["term"]): r["value"] for r in rows}
    assert value[("total_docs", 1, None, None)] == 3 and value[("vocab_size", 1, None, None)] == 6
    assert value[("n_terms", 1, "1", None)] == 5 and value[("n_terms", 2, "2", None)] == 3
    assert sum(r["part"] == "top_term" for r in rows) == 8
    assert {r["id"]: r["n_terms"] for r in stats.terms_per_doc(ix.vectors).collect()} == {"1": 5, "2": 3, "3": 0}


def test_written_index_reads_back(spark, tmp_path):
    out = str(tmp_path / "out")
    pages = spark.createDataFrame([d[1:] for d in TINY], "url string, title string, text string")
    ix = index.build_index(pages, out)
    want = {u: v for (_, u, *_), v in zip(TINY, plain_index(TINY).values())}
    for path in ("tfidf_index",):
        back = indexfiles.read_index(spark, f"{out}/{path}").collect()
        close({r["url"]: dict(r["tfidf"]) for r in back}, want)
    keyed = spark.read.parquet(f"{out}/tfidf_keyed").collect()
    close({r["url"]: dict(r["tfidf"]) for r in keyed}, want)
    docs = [json.loads(x) for x in spark.read.text(f"{out}/docs").toPandas()["value"]]
    assert {d["url"]: d["text"] for d in docs} == {d[1]: d[3] for d in TINY}
    assert all(set(d) == {"id", "url", "title", "text"} for d in docs)
    postings = spark.read.parquet(f"{out}/postings")
    queries = spark.createDataFrame([(1, "cat")], "qid long, query string")
    assert search.search(postings, ix.docs, queries).count() == 2


LINES = [
    '{"id": "r", "url": "u", "title": "t", "tfidf": {"a": 1, "b": "2.5", "c": "x", "d": true, "e": null, "f": "1d"}}',
    '{"id": "s", "url": "", "path": "p", "tfidf": "{\\"a\\": 3}"}',
    '{"m1": {"url": "", "path": "q", "tfidf": {"z": 1}}, "m2": {"url": "w", "title": "T"}}',
    "[1, 2]",
    '{"id": "broken", "url": ',
    '{"other": 1}',
    "",
    '{"id": "dup", "url": "first", "tfidf": {"a": 1}}',
    '{"id": 5, "tfidf": [1]}',
    '{"id": "dup", "url": "last"}',
    "{}",
]


def test_lenient_reader(spark, tmp_path):
    (tmp_path / "index.jsonl").write_text("\n".join(LINES), encoding="utf-8")
    rows = {r["id"]: r for r in indexfiles.read_index(spark, str(tmp_path)).collect()}
    assert set(rows) == {"r", "s", "m1", "m2", "dup", "5"}
    assert dict(rows["r"]["tfidf"]) == {"a": 1.0, "b": 2.5, "d": 1.0}
    assert dict(rows["s"]["tfidf"]) == {"a": 3.0} and rows["s"]["url"] == "p" and rows["s"]["title"] == ""
    assert rows["m1"]["url"] == "q" and rows["m2"]["title"] == "T" and dict(rows["m2"]["tfidf"]) == {}
    assert rows["dup"]["url"] == "last" and dict(rows["dup"]["tfidf"]) == {}
    assert dict(rows["5"]["tfidf"]) == {}


def test_pretty_printed_file(spark, tmp_path):
    whole = {"a": {"url": "u", "title": "t", "tfidf": {"x": 0.5}}, "b": {"url": "", "path": "p", "tfidf": {}}}
    (tmp_path / "index.json").write_text(json.dumps(whole, indent=2), encoding="utf-8")
    rows = {r["id"]: r for r in indexfiles.read_index(spark, str(tmp_path), whole=True).collect()}
    assert dict(rows["a"]["tfidf"]) == {"x": 0.5} and rows["b"]["url"] == ""


def test_keyed_index_keeps_the_last(spark, tmp_path):
    rows = [("a", "u1", "t", {"x": 1.0}, 1), ("a", "u2", "t", {"y": 2.0}, 2), ("b", "v", "t", {}, 1)]
    df = spark.createDataFrame(rows, "id string, url string, title string, tfidf map<string,double>, at int")
    out = str(tmp_path / "keyed")
    indexfiles.write_index_keyed(df, out, order="at")
    assert {r["id"]: r["url"] for r in spark.read.parquet(out).collect()} == {"a": "u2", "b": "v"}


def test_text_files_and_their_index(spark, tmp_path):
    files = {"good": b"The cats are\r\nrunning cats", "empty": b"", "bad": b"\xff\xfe cats"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    listed = [(n, str(tmp_path / n)) for n in (*files, "missing")]
    manifest = spark.createDataFrame(listed, "id string, path string")
    text = {r["id"]: r["text"] for r in textfiles.read_text_docs(manifest, str(tmp_path)).collect()}
    assert text == {"good": "The cats are\nrunning cats", "empty": "", "bad": "", "missing": ""}
    lemmas = spark.createDataFrame([("cats", "cat"), ("are", "be")], "token string, lemma string")
    ix = index.build_index_files(manifest, str(tmp_path), ["the"], lemmas)
    got = collected(ix.vectors)
    assert set(got) == {"good", "empty", "bad", "missing"} and got["empty"] == {}
    assert got["good"] == pytest.approx({"cat": 0.5 * math.log(5), "be": 0.25 * math.log(5), "running": 0.25 * math.log(5)})


def test_a_file_index_is_written_read_and_searched(spark, tmp_path):
    for name, text in (("a", "cats run"), ("b", "dogs run far"), ("c", "")):
        (tmp_path / name).write_text(text)
    manifest = spark.createDataFrame([(n, str(tmp_path / n)) for n in "abc"], "id string, path string")
    ix = index.build_index_files(manifest, str(tmp_path))
    out = str(tmp_path / "out")
    indexfiles.write_file_index(ix.records, out)
    assert all(set(json.loads(r["value"])) == {"id", "path", "tfidf"} for r in spark.read.text(out).collect())
    queries = spark.createDataFrame([(1, "cats"), (2, "run")], "qid long, query string")
    hits = index.search_index(spark, out, queries).collect()
    assert {(h["qid"], h["rank"], h["id"], h["url"]) for h in hits if h["qid"] == 1} == {(1, 1, "a", str(tmp_path / "a"))}
    assert [h["id"] for h in sorted(hits, key=lambda h: (h["qid"], h["rank"]))] == ["a", "a", "b"]
    assert search.search(ix.postings, ix.docs, queries).count() == 3


def test_a_null_id_is_a_record(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": null, "url": "u", "tfidf": {"a": 1}}\n{"id": "k", "url": "v", "tfidf": {}}')
    assert {(r["id"], r["url"]) for r in indexfiles.read_index(spark, str(tmp_path)).collect()} == {(None, "u"), ("k", "v")}


def test_short_lists_normalize_without_a_shuffle(spark, monkeypatch):
    from termlake.operators import normalize as nz

    docs = spark.createDataFrame([("d", "cats cat x be the"), ("e", ""), ("f", "the")], "id string, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("cat", "be")], "token string, lemma string")

    def run():
        df = nz.normalize_docs(docs, ["be", "the"], lemmas)
        return df, sorted(map(tuple, df.collect()), key=repr)

    df, rows = run()
    assert rows == [("d", 2, "be", 1), ("d", 2, "cat", 1), ("e", 0, None, None), ("f", 0, None, None)]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(nz, "ROW_LEMMAS", 1)
    assert run()[1] == rows


def test_tiny_scores_are_hits_whatever_the_digits(spark):
    dots = spark.createDataFrame([(1, "a", 1e-8, 1.0, 1.0, 1), (1, "b", 0.0, 1.0, 1.0, 1)], "qid long, id string, dot double, norm double, qnorm double, n_overlap long")
    assert [r["id"] for r in search.score(dots, digits=6).collect()] == [r["id"] for r in search.score(dots).collect()] == ["a"]


def test_stopwords_come_before_lemmas(spark):
    from termlake.operators.normalize import normalize_counts

    counts = spark.createDataFrame([("d", "cats", 2), ("d", "cat", 1), ("d", "x", 4), ("d", "be", 1)], "id string, term string, cnt long")
    lemmas = spark.createDataFrame([("cats", "cat"), ("cat", "be")], "token string, lemma string")
    got = {r["term"]: r["cnt"] for r in normalize_counts(counts, ["be"], lemmas).collect()}
    # "be" as a lemma stays: stopwords are dropped before the lemmas are looked up.
    assert got == {"cat": 2, "be": 1}


def test_doc_norm_equals_vector_norm(spark):
    ix = index.index_docs(spark.createDataFrame(random_docs(), DOCS))
    a = {r["id"]: r["norm"] for r in Wt.doc_norm(ix.weighted).collect()}
    b = {r["id"]: r["norm"] for r in ix.vectors.collect()}
    assert a == pytest.approx({i: b[i] for i in a})


def test_scratch_folder_follows_the_session(spark):
    from termlake.session import scratch_root

    assert os.path.isdir(scratch_root(spark))


def test_large_manifests_are_not_broadcast(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_bytes(b"one\rtwo")
    listed = [("a", str(tmp_path / "a")), ("b", str(tmp_path / "a")), ("c", str(tmp_path / "none"))]
    manifest = spark.createDataFrame(listed, "id string, path string")
    want = {("a", "one\ntwo"), ("b", "one\ntwo"), ("c", "")}
    assert {(r["id"], r["text"]) for r in textfiles.read_text_docs(manifest, str(tmp_path)).collect()} == want
    monkeypatch.setattr(textfiles, "is_small", lambda df: False)
    assert {(r["id"], r["text"]) for r in textfiles.read_text_docs(manifest, str(tmp_path)).collect()} == want


def test_pages_with_one_url_are_one_document(spark, tmp_path):
    rows = [("u", "A", "red fox"), ("u", "B", "red hen hen"), ("v", "C", "fox")]
    pages = spark.createDataFrame(rows, "url string, title string, text string")
    out = str(tmp_path / "out")
    ix = index.build_index(pages, out, unique_ids=True)
    assert spark.read.parquet(f"{out}/tfidf_keyed").count() == 2
    weigh = {"red": 2 / 5 * math.log(1 + 3), "fox": 1 / 5 * math.log(1 + 3 / 2), "hen": 2 / 5 * math.log(1 + 3)}
    queries = spark.createDataFrame([(1, "hen fox")], "qid long, query string")
    hits = search.search_records(spark.read.schema(ix.records.schema).parquet(f"{out}/tfidf_keyed"), queries, docs=ix.docs).collect()
    assert sorted((h["rank"], h["url"], h["title"]) for h in hits) == [(1, "v", "C"), (2, "u", "A"), (2, "u", "B")]
    want = (weigh["hen"] + weigh["fox"]) / math.hypot(*weigh.values()) / math.sqrt(2)
    assert [h["score"] for h in hits if h["url"] == "u"] == pytest.approx([want, want])


@pytest.mark.parametrize("rows", [1_000_000, 25, 3, 0])
def test_vectors_need_no_shuffle_of_all_postings(spark, monkeypatch, rows):
    docs = random_docs(60, seed=4) + [("x", "u", "t", "lone wolf"), ("y", "u", "t", "pair pair"), ("z", "u", "t", "pair")]
    monkeypatch.setattr(keys, "BROADCAST_MAX_ROWS", rows)
    ix = index.index_docs(spark.createDataFrame(docs, DOCS), unique_ids=True)
    close(collected(ix.vectors), plain_index(docs))
    plan = ix.records._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (rows < 1000)
    assert {r["id"]: set(r["tfidf"]) for r in ix.records.collect()} == {i: set(v) for i, v in plain_index(docs).items()}


def test_every_hit_is_ranked_with_one_shuffle_of_the_hits(spark):
    docs = [d if i % 7 else (*d[:2], None, d[3]) for i, d in enumerate(random_docs(50, seed=9))]
    ix = index.index_docs(spark.createDataFrame(docs, DOCS), unique_ids=True)
    queries = spark.createDataFrame(list(enumerate(["wa wbb wbb", "all", "", "nothing", "all wdd"])), "qid long, query string")
    want = sorted(map(tuple, search.search(ix.postings, ix.docs, queries, k=None, digits=6).collect()), key=str)
    assert sorted(map(tuple, search.search_all(ix.plain_records, queries, digits=6).collect()), key=str) == want and want
    plan = search.hits_in_rows(ix.records, search.query_vector(queries))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_shared_terms_are_found_in_the_rows(spark):
    docs = random_docs(50, seed=9)
    ix = index.index_docs(spark.createDataFrame(docs + docs[:2], DOCS), unique_ids=True)
    qvec = search.query_vector(spark.createDataFrame([(1, "wa wbb all"), (2, ""), (3, "nothing"), (4, "wdd wa")], "qid long, query string"))
    want = sorted(map(tuple, search.overlap_terms(search.postings_match(ix.postings, qvec)).collect()))
    got = search.overlap_in_rows(ix.term_lists, qvec)
    assert sorted(map(tuple, got.collect())) == want and want


def test_text_files_of_pages_are_packed(spark, tmp_path):
    from catalog import queries as Q

    rows = [(i, f"u{i}", f"cats {i}\r\nrun") for i in range(60)] + [(7, "u", "again"), (60, "v", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    manifest, root = Q.text_files(spark, str(tmp_path))
    # A file or folder for each page would make the work grow with their number.
    parts = [f for d, _, names in os.walk(root.removeprefix("file:")) for f in names if f.startswith("part-")]
    assert 0 < len(parts) < 30
    got = sorted((r["id"], r["text"]) for r in textfiles.read_text_docs(manifest, root, packed=True).collect())
    text = {str(i): f"cats {i}\nrun\n" for i in range(60)} | {"7": "cats 7\nrun\nagain\n", "60": "\n"}
    missing = [(f"none-{i}", "") for i, _, _ in rows]
    assert got == sorted([*text.items(), *missing])
