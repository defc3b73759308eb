"""The n-gram join on tables whose ids have several texts or are null."""

from termlake.llm import ngram_join
from termlake.llm.queries import QUERIES

from .conftest import SCHEMA, prose


def several_texts():
    own = [(i, prose(40 + i, 90), "en", "a", 0) for i in range(6)]
    other = [(i, prose(80 + i, 90), "en", "a", 0) for i in range(6)]
    near = [(10 + i, prose(80 + i, 90) + " end", "en", "b", 0) for i in range(6)]  # near copies of the other texts
    null = [(None, prose(40, 90) + " end", "en", "b", 0), (None, prose(200, 90), "en", "b", 0), (None, prose(200, 90) + " end", "en", "b", 0)]
    return own + other + near + null + [(0, own[0][1], "en", "z", 0)]


def test_every_row_has_its_links(scratch, tmp_path):
    rows = several_texts()
    scratch.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_ngram_join"](scratch, str(tmp_path)).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    sets = [set(ngram_join.shingles(r[1]).tolist()) for r in rows]
    close = [[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    want = []
    for r, a, near in zip(rows, sets, close):
        same = least(q[0] for q, b in zip(rows, sets) if a == b)
        # Classes here are no deeper than one link.
        want.append((r[0], same, least(q[0] for q, n in zip(rows, near) if n), sum(near) - 1))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {w[0] for w in want if w[3]} == {*range(6), *range(10, 16), None}


def test_other_texts_of_an_id_stay(scratch):
    rows = several_texts()
    kept = ngram_join.keep_one(scratch.createDataFrame(rows, SCHEMA)).collect()
    texts = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in kept)
    assert texts[1:] == sorted((r[0], r[1]) for r in rows[:12])
    assert texts[0][0] == -1 and texts[0][1] in (prose(200, 90), prose(200, 90) + " end")
    assert [r["source"] for r in kept if r["text"] == prose(40, 90)] == ["a"]


def test_long_texts_come_in_small_batches(scratch):
    from termlake.llm import batches

    df = scratch.range(48).coalesce(1).selectExpr("repeat(cast(id as string), 400000) AS text")
    rows = batches.map_rows(df, "size bigint", lambda: lambda batch: [(batch.nbytes,)])
    # 48 texts of 0.4 MB or more were one batch.
    assert max(r["size"] for r in rows.collect()) < 2 * batches.BATCH_BYTES
