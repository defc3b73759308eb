"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and components.

A document's set is its distinct 5-word shingles (words are runs without
white space, A-Z lower-cased), each hashed to 64 bits in the row. Rows with the
same set are one node. Only digests of a set are written (its name and its band
keys); the sets of nodes that share a bucket are made again from their texts. For every set a SuperMinHash signature of
``M`` values is made: each element walks a random permutation of the slots,
drawn one swap at a time from a stream seeded by the element, and offers slot
``p[j]`` the value ``j + r``; a slot keeps its least offer. Levels go in order
for all elements of a batch of sets at once, and a set stops as soon as no slot
holds a value above the level, which is SuperMinHash's early stop. The
signatures are correlated across slots, so an estimate has less variance than
with independent hashes.

Signatures are cut into ``BANDS`` bands of ``ROWS`` values; sets with an equal
band meet in a bucket. A bucket is cut into blocks by the hash of the set so that
a task never holds more than a bounded number of sets, and every pair of blocks
meets in one task. There, a pair is taken up only in the first band it shares,
only when the sizes allow the threshold, and only when a union-find over the
links found in the task doesn't connect it yet; then it is verified on the full
sets. Each task returns the links it kept (a forest), never all pairs, and the
components of all links are found by written rounds of joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stage
from .batches import bound_batches
from .components import components

# Fixed values of the contract.
SHINGLE = 5
NUM, DEN = 85, 100
SPACE = "[\\x20\\x09-\\x0D]+"
# Lower-casing is ``pc.ascii_lower``; the tables name what it does.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

M = 128
ROWS = 4
BANDS = M // ROWS
# Bands of the first wave; the rest only meet across its components.
WAVE_BANDS = 2
# Sets of one batch whose signatures are made together, and elements handled at once.
SIG_SETS = 256
SIG_ELEMENTS = 1 << 16
# Two blocks of a bucket.
GROUP = ("key", "bi", "bj")
# A block of a bucket holds at most about this many sets and shingles.
BLOCK_SETS = 2048
BLOCK_SHINGLES = 4_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_LOW = np.uint64(0xFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def signatures(sets: list[np.ndarray], m: int = M) -> np.ndarray:
    """SuperMinHash signatures ``(len(sets), m)`` as int64: level j and 32 random bits, ``(j << 32) + r``.

    An element's stream at level j is ``mix(element ^ mix(j))``: its high 32
    bits are r, its low 32 bits pick the swap partner k in [j, m). An empty set
    has all slots at the largest int64.
    """
    top = np.iinfo(np.int64).max
    h = np.full((len(sets), m), top, dtype=np.int64)
    if not sets:
        return h
    lens = np.array([len(s) for s in sets], dtype=np.int64)
    owner_all = np.repeat(np.arange(len(sets)), lens)
    elems_all = np.concatenate([np.asarray(s, dtype=np.int64) for s in sets]).view(np.uint64) if lens.sum() else np.zeros(0, np.uint64)
    level_keys = [_mix(np.array([j], dtype=np.uint64))[0] for j in range(m)]
    flat = h.reshape(-1)
    for start in range(0, len(elems_all), SIG_ELEMENTS):
        elems = elems_all[start : start + SIG_ELEMENTS]
        owner = owner_all[start : start + SIG_ELEMENTS]
        perm = np.tile(np.arange(m, dtype=np.int16), (len(elems), 1))
        live = np.arange(len(elems))
        for j in range(m):
            # Early stop: a set is done when every slot holds less than level j.
            done = h.max(axis=1) < (j << 32)
            live = live[~done[owner[live]]]
            if live.size == 0:
                break
            x = _mix(elems[live] ^ level_keys[j])
            r = (x >> np.uint64(32)).astype(np.int64)
            k = j + ((x & _LOW) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
            at_j = perm[live, j].copy()
            at_k = perm[live, k]
            perm[live, j] = at_k
            perm[live, k] = at_j
            np.minimum.at(flat, owner[live] * m + at_k.astype(np.int64), (j << 32) + r)
    return h


_POSITION = [_mix(np.array([1000 + k], np.uint64))[0] for k in range(SHINGLE)]
_NAME = [_mix(np.array([2000 + k], np.uint64))[0] for k in range(2)]


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)``: for each text the sorted distinct 64-bit hashes of its shingles, as unsigned integers.

    Fewer than five words give the whole word sequence as one shingle; no words,
    or a null, give the empty set. A distinct word is hashed once, stirred by its
    place in the shingle; a shingle's hash stirs the sum of its words.
    """
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    pieces = pc.split_pattern_regex(low, pattern=SPACE)
    flat, owner = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    keep = pc.greater(pc.binary_length(flat), 0)
    owner = owner.filter(keep).to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(flat.filter(keep))
    code = coded.indices.to_numpy()
    names = np.array(coded.dictionary.cast(pa.binary()).to_pylist(), dtype=object)
    word = pd.util.hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64)
    placed = [_mix(word ^ p) for p in _POSITION]
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    with np.errstate(over="ignore"):
        n = max(0, len(code) - SHINGLE + 1)
        inside = owner[:n] == owner[len(owner) - n :]
        grams = sum((placed[k][code[k : k + n]][inside] for k in range(1, SHINGLE)), placed[0][code[:n]][inside])
        rows = [owner[:n][inside]]
        found = [_mix(grams)]
        for size in range(1, SHINGLE):
            short = np.flatnonzero(counts == size)
            at = first[short]
            found.append(_mix(sum((placed[k][code[at + k]] for k in range(size)), np.uint64(size))))
            rows.append(short)
    row, value = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    row, value = row[order], value[order]
    ends = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
    for a, b in zip(ends[:-1], ends[1:]):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    row, value = row[new], value[new]
    return value, np.searchsorted(row, np.arange(len(texts) + 1))


def set_names(values: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """128-bit name of each set, from two sums of its stirred hashes and its size; None for the empty set."""
    sizes = np.diff(offsets)
    with np.errstate(over="ignore"):
        sums = [np.r_[np.uint64(0), np.cumsum(_mix(values ^ k), dtype=np.uint64)] for k in _NAME]
        both = np.stack([_mix(t[offsets[1:]] - t[offsets[:-1]] + sizes.astype(np.uint64)) for t in sums], axis=1)
    return [pair.tobytes() if n else None for pair, n in zip(both, sizes.tolist())]


def band_keys(sig: np.ndarray) -> np.ndarray:
    """``(sets, BANDS)``: a 64-bit hash of each band, its number mixed in."""
    parts = sig.reshape(len(sig), BANDS, ROWS).view(np.uint64)
    keys = np.broadcast_to(_mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(sig), BANDS))
    for k in range(ROWS):
        keys = _mix(keys ^ parts[:, :, k])
    return keys.view(np.int64)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, th, n_shingles, node, keys)`` of texts ``(doc_id, th, t)``; without words no node and no keys."""
    for batch in batches:
        for start in range(0, batch.num_rows, SIG_SETS):
            part = batch.slice(start, SIG_SETS)
            values, offsets = shingle_sets(part.column("t"))
            sizes = np.diff(offsets)
            full = np.flatnonzero(sizes)
            sig = signatures([values[offsets[i] : offsets[i + 1]].view(np.int64) for i in full])
            ends = np.r_[0, np.cumsum(np.where(sizes > 0, BANDS, 0))].astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(band_keys(sig).reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array(sizes.astype(np.int64)), pa.array(set_names(values, offsets), pa.binary()), keys],
                names=["doc_id", "th", "n_shingles", "node", "keys"],
            )


def _named_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, s)`` of texts ``(t)``."""
    for batch in batches:
        for start in range(0, batch.num_rows, SIG_SETS):
            values, offsets = shingle_sets(batch.column("t").slice(start, SIG_SETS))
            sets = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(set_names(values, offsets), pa.binary()), sets], names=["node", "s"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``GROUP``, cut so that no group lies in two tables; at most one group waits for its end."""
    held: list[pa.RecordBatch] = []

    def group(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(c)[i].as_py() for c in GROUP)

    for batch in batches:
        if not batch.num_rows:
            continue
        last = group(batch, batch.num_rows - 1)
        if held and group(held[-1], 0) == last:
            held.append(batch)
            continue
        other = np.zeros(batch.num_rows, bool)
        for c, own in zip(GROUP, last):
            other |= batch.column(c).to_numpy() != own
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        done = [*held, batch.slice(0, cut)]
        held = [batch.slice(cut)]
        if sum(x.num_rows for x in done):
            yield pa.Table.from_batches(done)
    if held:
        yield pa.Table.from_batches(held)


def _lists(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    lists = table.column(column).combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    return pc.list_flatten(lists).to_numpy(), np.r_[0, np.cumsum(sizes)]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links ``(a, b)`` of block pairs of buckets, as forests; rows are sorted by ``GROUP`` and ``nid``."""
    for table in _whole_groups(batches):
        key, lo, hi, band, nodes, comps, sizes, blocks = (
            table.column(c).to_numpy() for c in (*GROUP, "band", "nid", "comp", "n", "block")
        )
        keys, key_ends = _lists(table, "keys")
        values, ends = _lists(table, "s")
        new = np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]), True]
        cuts, ends = np.flatnonzero(new).tolist(), ends.tolist()
        out_a: list[int] = []
        out_b: list[int] = []
        for x, y in zip(cuts, cuts[1:]):
            # Each member carries the keys of the bands before the bucket's.
            earlier = keys[key_ends[x] : key_ends[y]].reshape(y - x, int(band[x]))
            sets = [values[ends[i] : ends[i + 1]] for i in range(x, y)]
            across = blocks[x:y] if lo[x] != hi[x] else None
            for i, j in _links_in_block(comps[x:y].tolist(), sizes[x:y], earlier, sets, across):
                out_a.append(int(nodes[x + i]))
                out_b.append(int(nodes[x + j]))
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _links_in_block(
    comps: list[int], sizes: np.ndarray, keys: np.ndarray, sets: list[np.ndarray], blocks: np.ndarray | None
) -> Iterator[tuple[int, int]]:
    """Verified links of one block pair of one bucket, as a forest; members are in the order of their ids.

    Members of one component of an earlier wave start joined in the union-find:
    they are connected already, so no pair of them is checked. With ``blocks``
    only pairs across blocks are.
    """
    parent = list(range(len(comps)))
    first: dict[int, int] = {}
    for i, c in enumerate(comps):
        parent[i] = first.setdefault(c, i)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(1, len(comps)):
        # Sizes must allow 100 |I| >= 85 |U|, and the pair must not share an earlier band.
        small, big = np.minimum(sizes[:i], sizes[i]), np.maximum(sizes[:i], sizes[i])
        fits = DEN * small >= NUM * big
        if blocks is not None:
            fits &= blocks[:i] != blocks[i]
        near = np.flatnonzero(fits)
        if near.size:
            near = near[~(keys[near] == keys[i]).any(axis=1)]
        for j in near.tolist():
            a, b = find(i), find(j)
            if a == b:
                continue
            both = np.concatenate([sets[i], sets[j]])
            both.sort()
            inter = int(np.count_nonzero(both[1:] == both[:-1]))
            if DEN * inter >= NUM * (len(both) - inter):
                parent[max(a, b)] = min(a, b)
                yield i, j


def _release(df: DataFrame) -> None:
    """Let the driver collect plans that are written out, so the cleaner deletes their shuffle files."""
    df.sparkSession.sparkContext._jvm.System.gc()


def _sets_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(nid, s)`` for ``wanted(nid, th, node)``: sets made again from the texts with a wanted hash."""
    hashes = broadcast_if_small(wanted.select("th").distinct())
    again = texts.join(hashes, "th", "left_semi").select("t").mapInArrow(_named_sets, "node binary, s array<bigint>")
    # Copies of a text give its set again; one is enough.
    return again.join(broadcast_if_small(wanted.select("nid", "node")), "node").groupBy("nid").agg(F.any_value("s").alias("s"))


def _wave_links(nodes: DataFrame, texts: DataFrame, lo: int, hi: int, joined: DataFrame | None) -> DataFrame:
    """Verified links (a forest per task) of bands ``lo`` to ``hi - 1``, written.

    ``nodes`` holds ``nid, n, th, node, keys``. With ``joined`` (``id, comp`` of the components of earlier waves), a bucket
    whose members all lie in one component is skipped, and members of one
    component are not compared again.
    """
    narrow = nodes.select("nid", "n", F.slice("keys", lo + 1, hi - lo).alias("keys"))
    if joined is None:
        narrow = narrow.withColumn("comp", F.col("nid"))
    else:
        comp = broadcast_if_small(joined.select(F.col("id").alias("nid"), "comp"))
        narrow = narrow.join(comp, "nid", "left").withColumn("comp", F.coalesce("comp", "nid"))
    # A key has its band's number mixed in, so it names the bucket alone.
    bands = narrow.select("nid", "n", "comp", F.posexplode("keys").alias("band", "key")).withColumn("band", F.col("band") + lo)
    buckets = bands.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("mass"), F.min("comp").alias("c0"), F.max("comp").alias("c1")
    )
    buckets = buckets.where((F.col("size") > 1) & (F.col("c0") < F.col("c1")))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_SETS), F.ceil(F.col("mass") / BLOCK_SHINGLES)).cast("int")
    # Few buckets are left as a rule: the rows of all bands then stay where they are read.
    buckets = broadcast_if_small(stage(buckets.select("key", blocks.alias("blocks")), f"smh-buckets{lo}"))
    busy = bands.join(buckets, "key").withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
    # Every pair of blocks of a bucket meets in one group: a member of block a joins (a, c) and (c, a).
    partners = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda c: F.struct(F.least(F.col("block"), c).alias("bi"), F.greatest(F.col("block"), c).alias("bj")))
    busy = stage(busy.select("band", "key", "nid", "comp", "block", F.inline(partners)), f"smh-busy{lo}")
    _release(busy)
    wanted = nodes.join(broadcast_if_small(busy.select("nid").distinct()), "nid", "left_semi")
    wanted = stage(wanted, f"smh-wanted{lo}")
    # Each member carries only the keys of the bands before its own.
    full = busy.join(_sets_of(texts, wanted), "nid").join(broadcast_if_small(wanted.select("nid", "n", "keys")), "nid")
    full = full.withColumn("keys", F.slice("keys", F.lit(1), F.col("band")))
    # Most buckets hold two or three sets: groups are walked in sorted rows, as a call for each would cost more than its work.
    dealt = full.repartition(*GROUP).sortWithinPartitions(*GROUP, "nid")
    links = stage(dealt.mapInArrow(_links, "a bigint, b bigint"), f"smh-links{lo}")
    _release(links)
    return links


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    * Two sets are linked when ``100 |I| >= 85 |U|``, confirmed on the full sets
      of 64-bit shingle hashes (two different shingles of a text share a hash with
      probability about n^2 / 2^65). Equal sets are always linked.
      Sets are named by a 128-bit hash and their first row; two different sets
      share a name with probability about 2^-128 a pair.
    * ``component_id`` is the smallest doc_id reachable, the row's own included;
      null when every reachable row has a null doc_id. ``kept`` is
      ``doc_id <=> component_id`` (null-safe), so repeated rows of the smallest
      id are all kept.
    * A row without words (null, empty or only white space) has an empty set, is
      linked with nothing: its component_id is its own doc_id and it is kept.
    * A pair at the threshold fails to share a band with probability
      (1 - 0.85^4)^32 < 1e-10; every candidate pair is verified exactly.
    * Empty tables give no rows; extra columns are ignored.
    """
    text_ = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = bound_batches(documents).select(F.col(key).alias("doc_id"), F.xxhash64(text_).alias("th"), text_.alias("t"))
    kind = documents.schema[key].dataType.simpleString()
    rows = texts.mapInArrow(_digests, f"doc_id {kind}, th bigint, n_shingles bigint, node binary, keys array<bigint>")
    rows = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "smh-rows")
    # A node is named by its first row: only names are shuffled.
    reps = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("rid").alias("nid"))
    reps = stage(reps, "smh-reps")
    nodes = rows.join(broadcast_if_small(reps.select(F.col("nid").alias("rid"))), "rid", "left_semi")
    nodes = stage(nodes.select(F.col("rid").alias("nid"), F.col("n_shingles").alias("n"), "th", "node", "keys"), "smh-nodes")
    _release(nodes)
    texts = texts.select("th", "t")
    first = _wave_links(nodes, texts, 0, WAVE_BANDS, None)
    joined = stage(components(first), "smh-comp1")
    second = _wave_links(nodes, texts, WAVE_BANDS, BANDS, joined)
    links = first.unionByName(second)
    comps = components(links)
    ids = rows.select("doc_id", "node").where(F.col("node").isNotNull()).join(reps, "node")
    named = ids.join(comps.withColumnRenamed("id", "nid"), "nid", "left").select("doc_id", "node", F.coalesce("comp", "nid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_node = named.select("node", "comp").distinct().join(least, "comp").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
