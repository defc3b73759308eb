"""SuperMinHash near duplicates against all pairs of full sets, and on odd rows."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from termlake.llm import superminhash as smh
from termlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def shingles(text):
    low = (text or "").translate(str.maketrans(smh.UPPER, smh.LOWER))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", low) if w]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([" ".join(words)])
    return frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b:
                inter = len(a & b)
                if 100 * inter >= 85 * (len(a) + len(b) - inter):
                    parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        if not sets[i]:
            comp = d
        else:
            ids = [x for x in groups[find(i)] if x is not None]
            comp = min(ids) if ids else None
        out.append((d, len(sets[i]), comp, d == comp))
    return sorted(out, key=repr)


def test_query_equals_all_pairs(scratch):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = brute([(r["doc_id"], r["text"]) for r in table])
    got = sorted((tuple(r[:4]) for r in QUERIES["op13_superminhash"](scratch, SF).collect()), key=repr)
    assert got == want
    assert sum(1 for r in want if not r[3]) > 0


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted((tuple(r) for r in smh.near_duplicates(odd_docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == brute(rows)
    assert smh.near_duplicates(no_docs).count() == 0


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 400)
    other = np.concatenate([base[:300], rng.integers(-(2**62), 2**62, 100)])
    sig = smh.signatures([np.sort(base), np.sort(other), np.array([], np.int64)])
    true = 300 / 500
    assert abs((sig[0] == sig[1]).mean() - true) < 0.15
    assert (sig[2] == np.iinfo(np.int64).max).all()
    # Order of elements doesn't matter.
    assert (smh.signatures([base[::-1].copy()])[0] == sig[0]).all()


def test_near_copies_link(scratch):
    words = [f"w{i}" for i in range(200)]
    a = " ".join(words)
    b = " ".join(words[:199] + ["x"])
    c = " ".join(words[:150] + ["y"] * 50)
    rows = [(5, a), (3, b), (9, c), (4, a.upper()), (None, b)]
    df = scratch.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in smh.near_duplicates(df).collect()}
    assert got == {(5, 3, False), (3, 3, True), (9, 9, True), (4, 3, False), (None, 3, False)}


def test_no_sets_are_written(scratch, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(300))) for i in range(40)] + [(100, " ".join(f"w3x{k}" for k in range(299)))]
    written, stage = [], smh.stage

    def watched(table, label):
        written.append(stage(table, label))
        return written[-1]

    monkeypatch.setattr(smh, "stage", watched)
    df = scratch.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in smh.near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)
    # A set is as large as its text: written sets and whole signatures filled the disk.
    lists = [(t, f.name) for t in written for f in t.schema if f.dataType.simpleString() == "array<bigint>"]
    assert lists and max(len(r[c]) for t, c in lists for r in t.collect()) <= smh.BANDS


def test_links_of_groups_cut_by_batches():
    rng, rows = np.random.default_rng(3), []
    for key in range(40):
        base = rng.integers(-(2**62), 2**62, 60)
        for nid in range(int(rng.integers(2, 7))):
            own = np.unique(np.r_[base[: 60 - nid], rng.integers(-(2**62), 2**62, nid + 1)])
            rows.append((key, 0, key % 2, 1, 10 * key + nid, 10 * key + nid, nid % 2 * (key % 2), len(own), [key * 100 + nid], own.tolist()))
    schema = pa.schema([(c, pa.int64()) for c in (*smh.GROUP, "band", "nid", "comp", "block", "n")] + [(c, pa.list_(pa.int64())) for c in ("keys", "s")])
    whole = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def links(size):
        found = smh._links(whole.slice(i, size) for i in range(0, len(rows), size))
        return [(a, b) for x in found for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())]

    parent = {r[4]: r[4] for r in rows}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    want = []
    for i, x in enumerate(rows):
        for y in rows[:i]:
            a, b = set(x[-1]), set(y[-1])
            if x[0] == y[0] and (x[6] != y[6] or x[1] == x[2]) and 100 * len(a & b) >= 85 * len(a | b) and find(x[4]) != find(y[4]):
                parent[max(find(x[4]), find(y[4]))] = min(find(x[4]), find(y[4]))
                want.append((x[4], y[4]))
    assert len(want) > 40
    # Whether a group's rows come in one batch or in several, and without batches.
    assert all(links(size) == want for size in (len(rows), 50, 7, 2, 1))
    assert links(1000) == want and list(smh._links(iter([]))) == []
