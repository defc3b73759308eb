"""Removal of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

A string of ``LENGTH`` bytes that starts twice anywhere is removed wherever it is.

Dealing out. The string's anchor is its k-gram of least hash, so equal strings
have equal anchors at the same place. Each anchor owns a run of consecutive
string starts; the bytes these span are a segment. Segments are grouped by anchor:
an anchor seen once needs no further look, and segments equal as a whole are
counted, not compared. What is left, different segments of one anchor, goes to
tasks by anchor.

In a task the Burrows-Wheeler transform of the segments is walked breadth first:
starting from the interval of all suffixes, intervals are extended backward by
one byte; the first time an extended interval ends at a place, the common prefix
of the two suffixes there is one longer than the level before. Common prefixes thus
come up by increasing value, and the walk stops at ``LENGTH``: places still open
share at least that much.

Anchors with many different segments (the edges of a passage that a third of all
documents contain) are dealt again by the bytes common to a shorter run of
starts, until a group is small or its segments are single strings, which are counted.

What moves. Runs of anchors that no other run has are left out before anything else is
moved. A text is shuffled only where it may have segments to compare or bytes to lose;
a bitmap of text names, bounded in size, tells the rest apart in place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stage
from .batches import map_rows, texts_of

LENGTH = 400
GRAM = 32
PIECE = 1 << 22  # string starts looked at together; a longer text is taken in pieces
GROUP = 256  # most different segments of one anchor in a task
BUCKET_BYTES = 1 << 20  # bytes of segments looked at together
RUNS = 4096  # most runs of a text in a row
BITS = 16  # bits of the bitmap for each text named in it
MOST_BITS = 1 << 29  # largest bitmap (64 MB); beyond, it lets more texts pass
CELL = 47  # string starts per cell when segments without a partner are left out
SPLIT = 8  # parts that a run of starts is cut into when dealt again

_BITS = 23
_MASK = np.int64((1 << _BITS) - 1)
_TABLE = np.random.default_rng(23).integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def digest(data: bytes) -> int:
    return int.from_bytes(hashlib.md5(data).digest()[:8], "little", signed=True)


def segment_digest(data: bytes, lead: int) -> int:
    """Equal for segments of equal bytes that lie alike about their anchor."""
    return digest(lead.to_bytes(4, "little", signed=True) + data)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every start, by doubling."""
    h, width, base = _TABLE[data], 1, _BASE
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64), width * 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchor_runs(data: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """``(anchor hash, anchor place, first start, last start)`` of the runs that cover all string starts, in order."""
    runs = []
    window = length - GRAM + 1
    for base in range(0, len(data) - length + 1, PIECE):
        part = data[base : base + PIECE + length - 1]
        h = gram_hashes(part)
        n = len(part) - length + 1
        # High bits of the hash, then the place: a minimum is the leftmost least gram.
        keys = ((h >> np.uint64(_BITS + 1)).astype(np.int64) << _BITS) | np.arange(len(h))
        pad = -len(keys) % window
        grid = np.concatenate([keys, np.full(pad, np.iinfo(np.int64).max)]).reshape(-1, window)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        at = np.minimum(back[:n], ahead[window - 1 : window - 1 + n]) & _MASK
        cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
        first = np.r_[0, cuts]
        last = np.r_[cuts, n] - 1
        own = at[first]
        runs += zip(h[own].view(np.int64).tolist(), (own + base).tolist(), (first + base).tolist(), (last + base).tolist())
    return runs


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols, by doubling ranks.

    The first ranks are of as many symbols as fit a machine word. From then on
    only suffixes that still share their rank are sorted again.
    """
    n = len(text)
    bits = max(1, int(text.max() + 1).bit_length())
    width = max(1, min(depth, 62 // bits))
    keys = np.zeros(n, np.int64)
    for k in range(width):
        keys <<= bits
        keys[: max(0, n - k)] |= text[k:] + 1
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    head = np.r_[True, ranked[1:] != ranked[:-1]]
    rank = np.empty(n, np.int64)
    while True:
        # A rank is the place where its suffixes begin, so ranks of others stay as they are.
        begin = np.flatnonzero(head)
        rank[order] = np.repeat(begin, np.diff(np.r_[begin, n]))
        if width >= depth:
            return order
        tied = np.flatnonzero(~(head & np.r_[head[1:], True]))
        if not len(tied):
            return order
        own = order[tied]
        later = own + width
        second = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        keys = rank[own] * (n + 1) + second
        sort = np.argsort(keys, kind="stable")
        order[tied] = own[sort]
        keys = keys[sort]
        # Tied places hold whole groups, so the order of groups is kept.
        head[tied] = np.r_[True, keys[1:] != keys[:-1]]
        width *= 2


def open_places(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Places between neighbours of the suffix order with a common prefix of ``length`` or more.

    ``result[r]`` is about suffixes ``order[r - 1]`` and ``order[r]``.
    """
    n = len(text)
    bwt = text[order - 1]  # the symbol before suffix 0 is the last one
    symbols = int(text.max()) + 1
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)  # where the suffix longer by one symbol stands
    step[by_symbol] = np.arange(n)
    is_open = np.ones(n + 1, bool)
    is_open[0] = is_open[n] = False
    begin, end = np.array([0]), np.array([n])
    for _ in range(length):
        # All members of all intervals, named by interval.
        sizes = end - begin
        owner = np.repeat(np.arange(len(sizes)), sizes)
        member = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        symbol = bwt[member]
        # Extensions by one symbol: members are consecutive there, in the order they have here.
        sort = np.argsort(owner * symbols + symbol, kind="stable")
        s, o, m = symbol[sort], owner[sort], member[sort]
        head = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (o[1:] != o[:-1])])
        tail = np.r_[head[1:], len(s)] - 1
        new_begin, new_end = step[m[head]], step[m[tail]] + 1
        fresh = is_open[new_end]
        is_open[new_end] = False
        begin, end = new_begin[fresh], new_end[fresh]
        # The interval up to the end of the order has its place from the start.
        if not len(begin):
            break
    return is_open[:n]


def repeated_starts(segments: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each segment the runs ``(first, last)`` of starts of strings that start twice or more."""
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes + 1)
    text = np.zeros(ends[-1], np.int64)
    data = np.frombuffer(b"\0".join([*segments, b""]), np.uint8)
    # Every segment ends with a symbol of its own, below all bytes.
    text[:] = data.astype(np.int64) + len(segments)
    text[ends - 1] = np.arange(len(segments))
    order = suffix_array(text, length)
    shared = open_places(text, order, length)
    twice = shared | np.r_[shared[1:], False]
    marked = np.zeros(len(text), bool)
    marked[order[twice]] = True
    found = []
    for begin, size in zip((ends - 1 - sizes).tolist(), sizes.tolist()):
        own = marked[begin : begin + max(0, size - length + 1)]
        edge = np.flatnonzero(np.diff(np.r_[0, own.astype(np.int8), 0]))
        found.append(list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())))
    return found


def occurrences(texts: DataFrame) -> DataFrame:
    """``(tid, runs)`` for each row of a column ``text`` that has ``LENGTH`` bytes or more; several, if it has over ``RUNS`` runs.

    ``lead``: bytes from the first start to the anchor.
    """

    def make():
        def run(batch: pa.RecordBatch):
            for text in texts_of(batch.column(0)):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) >= LENGTH:
                    tid = hashlib.md5(raw).digest()
                    runs = anchor_runs(np.frombuffer(raw, np.uint8))
                    for i in range(0, len(runs), RUNS):
                        yield tid, [
                            (anchor, segment_digest(raw[first : last + LENGTH], at - first), first, last, at - first)
                            for anchor, at, first, last in runs[i : i + RUNS]
                        ]

        return run

    return map_rows(texts.select("text"), "tid binary, runs array<struct<anchor:bigint,seg:bigint,first:int,last:int,lead:int>>", make)


def shared_occurrences(docs: DataFrame) -> DataFrame:
    """``(tid, first, anchor, seg, last, lead, n)``: the runs of each different text whose anchor starts twice or more, and how many texts are equal."""
    bags = stage(occurrences(docs), "repeats-occurrences")
    anchors = bags.select(F.explode("runs.anchor").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    anchors = stage(anchors.where("n > 1").select("anchor"), "repeats-anchors")
    rows = bags.select("tid", F.inline("runs")).join(anchors, "anchor", "left_semi")
    # The place names the rest; equal texts are counted in each task before they meet.
    shared = rows.groupBy("tid", "first").agg(F.count(F.lit(1)).alias("n"), *[F.any_value(c).alias(c) for c in ("anchor", "seg", "last", "lead")])
    return stage(shared, "repeats-shared")


def may_be_in(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``tid`` is none of ``named``.

    A broadcast bitmap, so rows stay where they are; of the others, about one in ``BITS`` is true.
    """
    bits = min(MOST_BITS, max(1 << 15, BITS * named.count()))
    place = F.pmod(F.xxhash64("tid"), F.lit(bits))
    marks = named.select(F.bitmap_bucket_number(place).alias("_block"), F.bitmap_bit_position(place).alias("at"))
    marks = marks.groupBy("_block").agg(F.bitmap_construct_agg("at").alias("_marks"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_marks", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    found = rows.withColumn("_block", F.bitmap_bucket_number(place)).join(F.broadcast(marks), "_block", "left")
    return found.withColumn("_maybe", maybe).drop("_block", "_marks")


_RUNS = "anchor bigint, seg bigint, runs array<struct<first:int,last:int>>"


def _bucket(part: pd.DataFrame) -> pd.DataFrame:
    """One task's groups; segments that occur more than once are wholly repeated."""
    part = part.sort_values(["anchor", "seg"], kind="stable")
    anchors, segments = part["anchor"].tolist(), [bytes(b) for b in part["bytes"]]
    seen: dict[int, int] = {}
    paired = set()
    for i, (anchor, lead, data) in enumerate(zip(anchors, part["lead"].tolist(), segments)):
        for cell, core in cores_of(lead, data):
            other = seen.setdefault(hash((anchor, cell, core)), i)
            if other != i:
                paired |= {other, i}
    walked = sorted(paired)
    found = dict(zip(walked, repeated_starts([segments[i] for i in walked]))) if walked else {}
    runs = [
        [{"first": 0, "last": len(b) - LENGTH}] if n > 1 else [{"first": a, "last": z} for a, z in found.get(i, [])]
        for i, (b, n) in enumerate(zip(segments, part["n"]))
    ]
    out = pd.DataFrame({"anchor": part["anchor"], "seg": part["seg"], "runs": runs})
    return out[out["runs"].map(len) > 0]


def cells_of(lead: int, starts: int, width: int) -> list[tuple[int, int]]:
    """Cells of ``width`` string starts that a segment touches, with the start of each in the segment.

    Cells are counted from the anchor, so equal strings of one anchor fall into
    equal cells. All strings of a cell have ``[begin + width - 1, begin + LENGTH)``
    of the segment in common, whether the segment has all of them or not.
    """
    return [(cell, cell * width + lead) for cell in range(-lead // width, (starts - 1 - lead) // width + 1)]


def cores_of(lead: int, data: bytes) -> list[tuple[int, bytes]]:
    """Cells of a segment and the bytes common to all strings of each.

    Two segments with an equal string have some cell and its bytes in common; most
    segments that only share their anchor don't, and need no comparison.
    """
    return [(cell, data[begin + CELL - 1 : begin + LENGTH]) for cell, begin in cells_of(lead, len(data) - LENGTH + 1, CELL)]


def _with_partner(segments: DataFrame) -> DataFrame:
    """Segments that have a cell in common with another one of their anchor, for anchors too large for one task."""

    def make():
        def run(batch: pa.RecordBatch):
            for anchor, seg, lead, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "seg", "lead", "bytes"))):
                for cell, core in cores_of(lead, data):
                    yield anchor, seg, digest(b"%d,%d:" % (anchor, cell) + core)

        return run

    cores = stage(map_rows(segments.select("anchor", "seg", "lead", "bytes"), "anchor bigint, seg bigint, core bigint", make), "repeats-cores")
    twice = cores.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core")
    twice = broadcast_if_small(stage(twice, "repeats-cores-twice"))
    kept = cores.join(twice, "core", "left_semi").select("anchor", "seg").distinct()
    return segments.join(broadcast_if_small(stage(kept, "repeats-partnered")), ["anchor", "seg"], "left_semi")


def _whole(df: DataFrame) -> DataFrame:
    run = F.struct(F.lit(0).alias("first"), (F.col("size") - LENGTH).cast("int").alias("last"))
    return df.select("anchor", "seg", F.array(run).alias("runs"))


def _compare(segments: DataFrame, weight: int, level: int) -> DataFrame:
    """Runs of repeated starts for segments ``(anchor, seg, n, lead, bytes)`` of ``weight`` bytes, anchors of at most ``GROUP``."""
    spark = segments.sparkSession
    buckets = max(1, -(-weight // BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    tasks = min(buckets, 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = segments.select("anchor", "seg", "n", "lead", "bytes", bucket).repartition(int(tasks), "bucket")
    return stage(dealt.groupBy("bucket").applyInPandas(_bucket, _RUNS), f"repeats-runs-{level}")


def _deal(segments: DataFrame, level: int) -> DataFrame:
    """Runs of repeated starts for different segments ``(anchor, seg, n, size, lead, bytes)`` of anchors with several."""
    counts = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("size").alias("weight"))
    counts = stage(counts, f"repeats-counts-{level}")
    many = counts.where(F.col("kinds") > GROUP).select("anchor")
    few = counts.where(F.col("kinds") <= GROUP)
    weight = few.agg(F.sum("weight")).first()[0] or 0
    done = _compare(segments.join(broadcast_if_small(many), "anchor", "left_anti"), weight, level)
    if many.isEmpty():
        return done

    width = -(-(LENGTH - GRAM + 1) // SPLIT ** (level + 1))

    def make():
        def run(batch: pa.RecordBatch):
            for anchor, seg, n, lead, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "seg", "n", "lead", "bytes"))):
                starts = len(data) - LENGTH + 1
                for cell, begin in cells_of(lead, starts, width):
                    first, last = max(0, begin), min(begin + width, starts) - 1
                    core = digest(b"%d,%d,%d:" % (level, anchor, cell) + data[begin + width - 1 : begin + LENGTH])
                    part = data[first : last + LENGTH]
                    yield anchor, seg, first, core, segment_digest(part, lead - first), n, len(part), lead - first, part

        return run

    schema = "anchor bigint, seg bigint, at int, core bigint, part bigint, n bigint, size int, lead int, bytes binary"
    split = stage(map_rows(segments.join(broadcast_if_small(many), "anchor", "left_semi"), schema, make), f"repeats-split-{level}")
    kinds = split.groupBy(F.col("core").alias("anchor"), F.col("part").alias("seg")).agg(
        F.sum("n").alias("n"), *[F.any_value(c).alias(c) for c in ("size", "lead", "bytes")]
    )
    found = _resolve(stage(kinds, f"repeats-kinds-{level}"), level + 1).withColumnsRenamed({"anchor": "core", "seg": "part"})
    moved = F.transform("runs", lambda r: F.struct((r["first"] + F.col("at")).alias("first"), (r["last"] + F.col("at")).alias("last")))
    parts = split.select("anchor", "seg", "at", "core", "part").join(found, ["core", "part"]).select("anchor", "seg", moved.alias("runs"))
    # A segment has at most a few parts, so its lists are short.
    joined = parts.groupBy("anchor", "seg").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return done.unionByName(stage(joined, f"repeats-joined-{level}"))


def _resolve(segments: DataFrame, level: int) -> DataFrame:
    """As :func:`_deal`, for anchors of one segment too: these only need its count."""
    # Written first, so that Spark can cut the join at large anchors.
    kinds = stage(segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")), f"repeats-sizes-{level}")
    tagged = stage(segments.join(kinds, "anchor"), f"repeats-tagged-{level}")
    alone = _whole(tagged.where("kinds = 1 and n > 1"))
    several = tagged.where("kinds > 1").drop("kinds")
    if several.isEmpty():
        return alone
    return alone.unionByName(_deal(several, level))


def _texts(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and each text's bytes and name ``(raw, tid)``."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(*columns, raw.alias("raw"), F.unhex(F.md5(raw)).alias("tid"))


def covered(docs: DataFrame) -> DataFrame:
    """``(tid, spans)``: byte spans to remove from each different text, as sorted ``(begin, end)`` that don't touch.

    ``tid`` is the MD5 of the text. Texts without such spans are left out.
    """
    occ = shared_occurrences(docs)
    kinds = occ.groupBy("anchor", "seg").agg(
        F.sum("n").alias("n"), F.min(F.struct("tid", "first", "last", "lead")).alias("place")
    ).withColumn("size", F.col("place.last") - F.col("place.first") + LENGTH)
    kinds = stage(kinds, "repeats-kinds")
    anchors = stage(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")), "repeats-sizes")
    kinds = stage(kinds.join(anchors, "anchor"), "repeats-sized")
    alone = _whole(kinds.where("kinds = 1"))
    several = kinds.where("kinds > 1")

    # Bytes of the different segments of shared anchors, each read at one place.
    wanted = several.groupBy("place.tid").agg(
        F.collect_list(F.struct("anchor", "seg", "n", "kinds", F.col("place.first").alias("first"), F.col("place.last").alias("last"), F.col("place.lead").alias("lead"))).alias("wanted")
    )
    wanted = stage(wanted, "repeats-wanted")
    # Of equal texts one is enough.
    texts = may_be_in(_texts(docs).where(F.octet_length("raw") >= LENGTH), wanted).where("_maybe")
    sources = texts.groupBy("tid").agg(F.any_value("raw").alias("raw")).join(wanted, "tid")

    def make():
        def run(batch: pa.RecordBatch):
            for raw, items in zip(batch.column("raw").to_pylist(), batch.column("wanted").to_pylist()):
                for w in items:
                    data = raw[w["first"] : w["last"] + LENGTH]
                    yield w["anchor"], w["seg"], w["n"], w["kinds"], len(data), w["lead"], data

        return run

    # Neighbours of a text overlap by nearly a string, which this compression finds.
    cut = map_rows(sources, "anchor bigint, seg bigint, n bigint, kinds bigint, size int, lead int, bytes binary", make)
    segments = stage(cut, "repeats-segments", compression="zstd")
    few = F.col("kinds") <= GROUP
    weight = several.where(few).agg(F.sum("size")).first()[0] or 0
    runs = alone.unionByName(_compare(segments.where(few), weight, 0))
    many = segments.where(~few).drop("kinds")
    if not many.isEmpty():
        compared = stage(_with_partner(many), "repeats-compared")
        counted = many.where("n > 1").join(broadcast_if_small(compared.select("anchor", "seg")), ["anchor", "seg"], "left_anti")
        runs = runs.unionByName(_whole(counted)).unionByName(_deal(compared, 0))

    # Runs of starts become spans of bytes; a text's spans are at most as many as its runs.
    spans = F.transform("runs", lambda r: F.struct((F.col("first") + r["first"]).alias("begin"), (F.col("first") + r["last"] + LENGTH).alias("end")))
    placed = occ.select("tid", "anchor", "seg", "first").join(runs, ["anchor", "seg"]).select("tid", spans.alias("spans"))
    placed = placed.groupBy("tid").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))

    def merge():
        def run(batch: pa.RecordBatch):
            for tid, own in zip(batch.column("tid").to_pylist(), batch.column("spans").to_pylist()):
                yield tid, _merge(own)

        return run

    return stage(map_rows(placed, "tid binary, spans array<struct<begin:int,end:int>>", merge), "repeats-spans")


def _merge(spans: list[dict]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for s in spans:
        if merged and s["begin"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s["end"])
        else:
            merged.append([s["begin"], s["end"]])
    return [(a, b) for a, b in merged]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, removed, kept)`` per row: the merged byte spans removed, and the bytes left.

    Null texts count as empty; rows with equal texts (repeated rows too) are
    each other's repeats; texts under ``LENGTH`` bytes stay whole. Kept bytes need
    not be valid UTF-8, so they are binary.
    """
    spans = covered(docs.select("text"))
    rows = may_be_in(_texts(docs, "doc_id"), spans)
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    whole = rows.where("not _maybe").select("doc_id", F.octet_length("raw").cast("bigint").alias("n_bytes"), none.alias("removed"), F.col("raw").alias("kept"))

    def make():
        def run(batch: pa.RecordBatch):
            for doc, raw, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "raw", "spans"))):
                own, kept, at = own or [], [], 0
                for s in own:
                    kept.append(raw[at : s["begin"]])
                    at = s["end"]
                kept.append(raw[at:])
                yield doc, len(raw), own, b"".join(kept)

        return run

    cut = rows.where("_maybe").drop("_maybe").join(spans, "tid", "left")
    return whole.unionByName(map_rows(cut, "doc_id bigint, n_bytes bigint, removed array<struct<begin:bigint,end:bigint>>, kept binary", make))
