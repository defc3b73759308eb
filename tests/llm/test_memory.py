"""What tasks leave behind in idle workers, and what line dedup broadcasts."""

import pyarrow as pa
import pytest

from termlake.llm import batches, bpe, line_chunks, ngram_join
from termlake.llm.queries import byte_bpe

WORDS = [f"zyx{i}wv" for i in range(300)]


@pytest.mark.parametrize("module, call", [(bpe, lambda df: bpe.round_trip(df, byte_bpe())), (ngram_join, ngram_join.prepared)])
def test_words_go_with_their_task(scratch, monkeypatch, module, call):
    makes = []
    monkeypatch.setattr(module, "map_rows", lambda df, schema, make: makes.append(make))
    call(scratch.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    text = pa.array([" ".join(WORDS)])
    ids = pa.array([1], pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, text] if module is bpe else [ids, ids, text], names=["a", "b", "c"][: 2 + (module is ngram_join)])
    assert len(list(makes[0]()(batch))) == 1
    # An idle worker keeps what modules hold.
    left = [v for v in vars(module).values() if isinstance(v, dict)] + [bpe.load(byte_bpe()).cache]
    assert not any(w in held for held in left for w in ("zyx0wv", " zyx7wv"))


def test_a_task_gives_its_memory_back(scratch, monkeypatch):
    given = []
    monkeypatch.setattr(batches, "give_back", lambda: given.append(1))

    class Rows:
        sparkSession = scratch

        def mapInArrow(self, run, schema):
            return run

    run = batches.map_rows(Rows(), "n bigint", lambda: lambda b: [(x,) for x in b.column(0).to_pylist()])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3], pa.int64())], names=["n"])
    assert sum(b.num_rows for b in run(iter([batch, batch]))) == 6 and given == [1]
    assert list(run(iter([]))) == [] and given == [1, 1]


def test_many_repeated_chunks_are_not_broadcast(scratch, monkeypatch):
    limits, small = [], line_chunks.broadcast_if_small

    def watched(df, **own):
        if "body" in df.columns:
            limits.append(own.get("max_bytes"))
        return small(df, **own)

    monkeypatch.setattr(line_chunks, "broadcast_if_small", watched)
    lines = ["\n".join(f"line {i} of passage {k} goes on for some more words" for i in range(9)) for k in range(3)]
    df = scratch.createDataFrame([(d, lines[d % 3] + f"\nend {d}") for d in range(9)], "doc_id bigint, text string")
    want = sorted((r["doc_id"], r["text"], r["_n_removed"]) for r in line_chunks.dedup_lines(df).collect())
    assert sum(r[2] for r in want) > 0
    assert limits and max(x if x else 1 << 40 for x in limits) <= 8 << 20
    monkeypatch.setattr(line_chunks, "GROUP_BYTES", 0)
    assert sorted((r["doc_id"], r["text"], r["_n_removed"]) for r in line_chunks.dedup_lines(df).collect()) == want
