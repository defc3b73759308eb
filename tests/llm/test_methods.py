"""Operators against brute force, exact round trips and held-out accuracy."""

import gzip
import io
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termlake.llm import bpe, components, mixing, ngram_join, quality_net, quality_rules, repeats, spotsigs, toxicity, warc
from termlake.llm.queries import byte_bpe

from .conftest import SCHEMA, prose


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(byte_bpe())


def test_bpe_equals_the_library(tokenizer):
    rnd = random.Random(4)
    letters = "aaaabcdehtt  \n\n'slv1ßéê漢😀"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> <|endof", "a" * 5000, "ha" * 400, " " * 900, "", prose(3, 500)]
    own = bpe.load(byte_bpe())
    got = own.encode(texts)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in got] == want and own.failed > 0
    assert [own.decode(g) for g in got] == [tokenizer.decode(w, skip_special_tokens=False) for w in want]


def test_bpe_splits_every_code_point_like_the_library(tokenizer):
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}  {chr(c)} {chr(c)}" for c in points]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in bpe.load(byte_bpe()).encode(texts)] == want


def test_repeated_words_by_counting_windows():
    rnd = random.Random(2)
    for _ in range(200):
        words = [rnd.choice([b"a", b"b"]) for _ in range(rnd.randint(0, 40))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        count = Counter(windows)
        inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
        assert quality_rules.repeated_words(words) == len(inside)


def test_outliers_go_and_the_rest_stays(scratch):
    rows = [(i, prose(i, 80), "en", "a", 0) for i in range(300)]
    rows += [(1000 + i, " | ".join(prose(i, 80).split()), "en", "a", 0) for i in range(60)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_table(scratch.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] for i in range(300)) and not any(got[1000 + i] for i in range(60))


def test_chi_square_tail():
    x = quality_rules.chi2_quantile(0.05)
    assert abs(x - 12.5916) < 1e-3


def test_raking_meets_targets_both_ways(scratch):
    cells = scratch.createDataFrame([("a", "x", 1, 60), ("a", "y", 2, 40), ("b", "x", 2, 30), ("b", "y", 1, 70), (None, "x", 1, 50)], "source string, lang string, topic int, mass bigint")
    targets = mixing.smoothed_targets(cells, 0.5)
    small = mixing.rake(cells, targets)
    goals = {}
    for m in mixing.MARGINS:
        t = [(r["value"], r["target"]) for r in targets[m].collect()]
        whole = sum(x for _, x in t)
        goals[m] = {v: x / whole * 250 for v, x in t}
    for m in mixing.MARGINS:
        got = Counter()
        for r in small.collect():
            got[r[m]] += r["fit"]
        assert all(math.isclose(got[v], g, rel_tol=0.02) for v, g in goals[m].items())
    limit, mixing.LOCAL_CELLS = mixing.LOCAL_CELLS, 1
    try:
        spread = mixing.rake(cells, targets)
        key = lambda r: (r["source"] or "", r["lang"], r["topic"])
        assert all(math.isclose(a["fit"], b["fit"], rel_tol=1e-9) for a, b in zip(sorted(small.collect(), key=key), sorted(spread.collect(), key=key)))
    finally:
        mixing.LOCAL_CELLS = limit
    done = mixing.calibrate(small, 0.4).collect()
    assert math.isclose(sum(r["mass"] * r["probability"] for r in done), 0.4 * 250, rel_tol=1e-3)


def test_components(scratch):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7), (300, 301)]
    got = {r["id"]: r["comp"] for r in components.components(scratch.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[150] == got[200] == 100 and got[301] == 300 and len(got) == 66


def test_near_duplicates_by_brute_force(scratch):
    rnd = random.Random(9)
    texts = []
    for g in range(12):
        base = prose(g, 120).split()
        for _ in range(8):
            words = list(base)
            for _ in range(rnd.randint(0, 6)):
                words[rnd.randrange(len(words))] = f"w{rnd.randrange(1000)}"
            texts.append(" ".join(words))
    texts += ["", "hm", "hm", None]
    docs = scratch.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [set(ngram_join.shingles(t or "").tolist()) for t in texts]
    links, root = Counter(), list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (a or b) and len(a & b) >= 0.8 * len(a | b) or (not a and not b and (texts[i] or "") == (texts[j] or "")):
                links[i] += 1
                links[j] += 1
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    kept = ngram_join.BLOCK_SETS
    for size in (kept, 3):
        ngram_join.BLOCK_SETS = size
        try:
            rows = ngram_join.near_duplicates(docs).collect()
        finally:
            ngram_join.BLOCK_SETS = kept
        assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == {i: (root[i], links[i]) for i in range(len(texts))}


def test_posterior_bound():
    least = ngram_join.least_matches(0.8, 1e-9)
    assert least[16] <= least[32] <= least[144] < 0.8 * 144


def starts_by_counting(segments, length):
    count = Counter(s[i : i + length] for s in segments for i in range(len(s) - length + 1))
    found = []
    for s in segments:
        twice = [count[s[i : i + length]] > 1 for i in range(len(s) - length + 1)]
        edge = np.flatnonzero(np.diff(np.r_[0, np.array(twice, np.int8), 0])) if twice else []
        found.append(list(zip(edge[::2], (np.array(edge[1::2]) - 1).tolist() if len(edge) else [])))
    return found


def test_interval_expansion_by_counting():
    rnd = random.Random(5)
    for _ in range(150):
        length = rnd.choice([1, 2, 3, 5, 8])
        base = bytes(rnd.choice(b"ab") for _ in range(40))
        segments = [base[rnd.randint(0, 10) : rnd.randint(12, 40)] for _ in range(rnd.randint(1, 5))]
        assert repeats.repeated_starts(segments, length) == starts_by_counting(segments, length)


def test_anchor_runs_cover_all_starts():
    data = np.frombuffer((prose(1, 400) + "a" * 900).encode(), np.uint8)
    runs = repeats.anchor_runs(data)
    assert runs[0][2] == 0 and runs[-1][3] == len(data) - repeats.LENGTH
    assert all(a[3] + 1 == b[2] for a, b in zip(runs, runs[1:]))
    assert all(first <= at + repeats.GRAM <= first + repeats.LENGTH for _, at, first, _ in runs)


@pytest.mark.parametrize("group", [256, 2])
def test_repeats_by_brute_force(scratch, group):
    rnd = random.Random(3)
    passage = prose(77, 110)
    texts = [f"{prose(i, 90)} {passage} {prose(500 + i, 60)}" for i in range(12)]
    texts += [prose(900, 200) for _ in range(2)] + ["z" * 1300, prose(901, 70) * 2, None, "short"]
    edited = list(texts[12])
    edited[500] = "#"
    texts.append("".join(edited))
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399))
    want = []
    for b in raw:
        mark = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 399):
            if count[b[i : i + 400]] > 1:
                mark[i] += 1
                mark[i + 400] -= 1
        want.append(bytes(np.frombuffer(b, np.uint8)[np.cumsum(mark)[:-1] == 0]))
    kept, repeats.GROUP = repeats.GROUP, group
    try:
        docs = scratch.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(docs).collect()}
    finally:
        repeats.GROUP = kept
    assert [got[i] for i in range(len(texts))] == want


def test_spans_of_a_long_copy_are_one(scratch):
    copy = prose(40, 3000)
    docs = scratch.createDataFrame([(copy,), (copy,), (prose(41, 300),), (copy + " end",)], "text string")
    got = [[tuple(s) for s in r["spans"]] for r in repeats.covered(docs).collect()]
    assert sorted(got) == [[(0, len(copy))]] * 2


def test_a_text_of_many_runs(scratch):
    docs = scratch.createDataFrame([(0, "z" * 12000 + prose(42, 30)), (1, prose(43, 200))], "doc_id bigint, text string")
    sizes = [r["n"] for r in repeats.occurrences(docs).select(F.size("runs").alias("n")).collect()]
    assert max(sizes) == repeats.RUNS and sum(sizes) > 11600
    got = {r["doc_id"]: [tuple(s) for s in r["removed"]] for r in repeats.remove_repeats(docs).collect()}
    assert got == {0: [(0, 12000)], 1: []}


def test_only_runs_of_shared_anchors_move(scratch):
    texts = [prose(1000 + i, 200) for i in range(40)]
    shared = repeats.shared_occurrences(scratch.createDataFrame([(t,) for t in [*texts, texts[0], texts[0]]], "text string"))
    # The texts but the first are alone, so of them at most an anchor met by chance is kept.
    rows = shared.groupBy("tid").agg(F.sum("n").alias("n"), F.count("n").alias("runs")).collect()
    runs = repeats.anchor_runs(np.frombuffer(texts[0].encode(), np.uint8))
    assert (3 * len(runs), len(runs)) in [(r["n"], r["runs"]) for r in rows] and len(rows) < 10


@pytest.mark.parametrize("most", [1 << 29, 1 << 15])
def test_bitmap_keeps_all_named_texts(scratch, most):
    rows = scratch.range(40000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("tid"), "id")
    kept, repeats.MOST_BITS = repeats.MOST_BITS, most
    try:
        found = repeats.may_be_in(rows, rows.where("id % 8 = 0")).groupBy(F.col("id") % 8 == 0, "_maybe").count().collect()
    finally:
        repeats.MOST_BITS = kept
    counts = {(named, maybe): n for named, maybe, n in found}
    assert counts[True, True] == 5000 and (True, False) not in counts
    assert counts[False, True] < 35000 * (0.08 if most > 1 << 15 else 0.2)


def test_similar_spotsigs(scratch):
    texts = [prose(1, 200), prose(1, 200) + " extra word", prose(2, 200), prose(1, 200)]
    members, pairs = spotsigs.similar_pairs(scratch.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {(r["class_id"], r["doc_id"]) for r in members.collect()} == {(0, 0), (0, 3), (1, 1), (2, 2)}
    assert [(r["a"], r["b"]) for r in pairs.collect()] in ([(0, 1)], [(1, 0)])


def test_pairs_of_terms_matter():
    rnd = random.Random(1)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rnd.random() < 0.4, rnd.random() < 0.4
        rows.append(np.array([i for i, x in enumerate((a, b)) if x], np.int64))
        labels.append(float(a != b))  # no additive weights tell this
    m = toxicity.fit(rows, np.array(labels), [10, 20], float(np.mean(labels)))
    right = [(m.score(r) >= 0.5) == bool(t) for r, t in zip(rows, labels)]
    assert np.mean(right) > 0.99


def test_classifiers_on_held_out_rows(scratch):
    rows, labels = [], []
    for i in range(900):
        toxic, junk = i % 3 == 0, i % 4 == 0
        words = prose(i, 60).split()
        if toxic:
            words[i % 60] = "moron"
        if junk:
            words = [w for w in words[:20] for _ in range(4)]
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, int(not junk), int(toxic and "moron" in words)))
    docs = scratch.createDataFrame(rows, SCHEMA)
    truth = {i: (q, t) for i, q, t in labels}
    table = scratch.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    for got, k in ((toxicity.toxicity_table(docs, table), 1), (quality_net.quality_scores(docs, table), 0)):
        held = [r for r in got.collect() if r["held_out"]]
        assert held and np.mean([r["predicted"] == truth[r["doc_id"]][k] for r in held]) > 0.95


def test_normaliser_keeps_what_is_whole():
    records = [warc.record(i, f"http://x/{i}", b"p" * 5000 * i, None, False) for i in range(4)]
    whole = gzip.compress(b"".join(records))
    out = io.BytesIO()
    index, truncated = warc.normalise(io.BytesIO(whole), out)
    assert not truncated and len(index) == 4
    for entry, want in zip(index, records):
        member = out.getvalue()[entry["offset"] : entry["offset"] + entry["length"]]
        assert gzip.decompress(member) == want
    cut, out = gzip.compress(b"".join(records)[:-30]), io.BytesIO()
    index, truncated = warc.normalise(io.BytesIO(cut), out)
    assert truncated and len(index) == 3
