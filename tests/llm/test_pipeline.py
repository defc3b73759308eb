"""Every stage of the pipeline against a plain restatement over what its predecessor kept."""

import hashlib
import math
from collections import Counter

from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from termlake.llm import line_chunks, mixing, ngram_join
from termlake.llm.queries import byte_bpe

from .conftest import SCHEMA, prose


def fixture_rows():
    shared = "\n".join(prose(900 + i, 12) for i in range(9))
    rows = []
    for i in range(230):
        lines = [prose(i * 31 + k, 14) for k in range(6)]
        text = "\n".join(lines)
        if i % 9 == 0:
            text = "\n".join([*lines[:3], shared, *lines[3:]])
        if i % 10 == 1:
            text = " | ".join(text.split())  # an outlier
        if i % 10 == 2:
            text = "few words"  # fails the base rule
        if i % 10 == 3:
            words = rows[-3][1].split(" ")
            words[5] = f"changed{i}"
            text = " ".join(words)  # a near copy
        rows.append((i, text, "en" if i < 225 else "de", "abc"[i % 3], len(text)))
    return rows


def chunk(text):
    lines = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    found, own = [], []
    for i, line in enumerate(lines):
        own.append(line)
        rolled = hashes[i] * line_chunks.FACTOR + (hashes[i - 1] if i else 0)
        if (rolled >> 4) % line_chunks.MEAN_LINES == 0 or i == len(lines) - 1:
            found.append(own)
            own = []
    return found


def plain_line_dedup(docs):
    seen, out = set(), {}
    for doc, text in sorted(docs.items()):
        kept = []
        for own in chunk(text):
            body = "\n".join(own)
            worth = len(own) >= line_chunks.LEAST_LINES and len(body.encode()) >= line_chunks.LEAST_BYTES
            if not (worth and body in seen):
                kept.append(body)
            if worth:
                seen.add(body)
        out[doc] = "\n".join(kept)
    return out


def plain_one_each(docs):
    sets = {i: set(ngram_join.shingles(t).tolist()) for i, t in docs.items()}
    ids, root = sorted(docs), {i: i for i in docs}
    for i in ids:
        for j in ids:
            if j < i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return {i for i in ids if root[i] == i}


def plain_sample(rows):
    def cell(r):
        words = [w for w in r["text"].replace("\n", " ").split(" ") if w]
        top = max(words, key=lambda w: (len(w), w), default="")
        return (r["source"], r["lang"], int(hashlib.md5(top.encode()).hexdigest()[:8], 16) % mixing.TOPICS), len(words)

    mass, of = Counter(), {}
    for r in rows:
        of[r["doc_id"]], n = cell(r)
        mass[of[r["doc_id"]]] += n
    total, fit = sum(mass.values()), {c: float(m) for c, m in mass.items()}
    goals = []
    for k in range(3):
        own = Counter()
        for c, m in mass.items():
            own[c[k]] += m
        powers = {v: m**pipeline.MIX_POWER for v, m in own.items()}
        goals.append({v: p / sum(powers.values()) * total for v, p in powers.items()})
    for _ in range(mixing.ROUNDS):
        for k in range(3):
            now = Counter()
            for c, f in fit.items():
                now[c[k]] += f
            fit = {c: f * goals[k][c[k]] / now[c[k]] for c, f in fit.items()}
    weight = {c: f / mass[c] for c, f in fit.items()}
    low, high = -50.0, 50.0
    for _ in range(200):
        mid = (low + high) / 2
        used = sum(m * min(1, weight[c] * math.exp(mid)) for c, m in mass.items())
        low, high = (mid, high) if used <= pipeline.MIX_SHARE * total else (low, mid)
    draw = lambda i: int(hashlib.md5(f"{pipeline.MIX_SEED}:{i}".encode()).hexdigest()[:12], 16) / 2**48
    return {i for i, c in of.items() if draw(i) < min(1, weight[c] * math.exp(low))}


def test_stages_equal_their_restatements(scratch, tmp_path):
    rows = fixture_rows()
    scratch.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = scratch.read.parquet(f"{tmp_path}/documents.parquet")
    tables = [docs.collect()]
    for name, stage in pipeline.STAGES:
        stage(scratch, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = scratch.read.parquet(f"{tmp_path}/{name}")
        assert name == "bpe" or tuple(docs.columns) == pipeline.COLUMNS
        tables.append(docs.collect())
    texts = [{r["doc_id"]: r["text"] for r in t} for t in tables[:-1]]

    assert set(texts[1]) == {r[0] for r in rows if r[0] % 10 not in (1, 2)}
    assert texts[2] == plain_line_dedup(texts[1]) != texts[1]
    assert set(texts[3]) == plain_one_each(texts[2]) < set(texts[2])
    assert set(texts[4]) == plain_sample(tables[3]) < set(texts[3])
    tokenizer = Tokenizer.from_file(byte_bpe())
    for r in tables[5]:
        ids = tokenizer.encode(texts[4][r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[4][r["doc_id"]].encode()).hexdigest()
    whole = entry.queries()["pipeline"](scratch, str(tmp_path))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, tables[5]))


def test_all_eleven_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
