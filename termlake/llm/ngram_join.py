"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; equal sets form one class. Classes
that agree in a band of MinHash values are linked, and the connected parts of
that graph are the candidate clusters: all partners lie in one cluster. A
cluster is cut into blocks, and each two blocks meet in a task of bounded size.
There the MinHash values of all pairs are compared a few at a time; a pair goes
as soon as the posterior probability that its similarity reaches the threshold
is below the tolerance, and the rest is verified on the exact sets. A task
returns counts of links and a spanning forest, never the pairs.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stage
from .batches import map_rows, texts_of
from .components import components

WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-9  # posterior below which a pair is dropped
ROWS, BANDS = 4, 36  # a pair at the threshold shares no band with probability (1 - 0.8**4)**36, 6e-9
STEP = 16  # MinHash values compared at a time
VALUES = ROWS * BANDS
BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 19
CACHED_WORDS = 150_000

WORD = re.compile(r"\w+")
_RNG = np.random.default_rng(17)
_MULTIPLY = _RNG.integers(1, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_MIX = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) | 1 for k in range(WORDS)], np.uint64)


class _Words(dict):
    """Cache word -> 64-bit hash."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(text: str, cache: _Words | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text; ``cache`` keeps words for the next one.

    Words are runs of letters, digits and underscores in lower case. A text of
    fewer words is one shingle, one without words has none.
    """
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    hashed = _Words() if cache is None else cache
    h = np.fromiter(map(hashed.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - WORDS + 1)
    parts = [h[k : k + n] * _MIX[k] for k in range(min(WORDS, len(h)))]
    return np.unique(_stir(sum(parts[1:], parts[0])))


def min_hashes(s: np.ndarray) -> np.ndarray:
    """``VALUES`` MinHash values of a non-empty set."""
    best = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(s), 2048):
        part = s[start : start + 2048]
        for k in range(0, VALUES, 24):
            mixed = part[None, :] * _MULTIPLY[k : k + 24, None] + _ADD[k : k + 24, None]
            mixed ^= mixed >> np.uint64(31)
            best[k : k + 24] = np.minimum(best[k : k + 24], (mixed * np.uint64(0x9E3779B97F4A7C15)).min(axis=1))
    return best


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band, the band's number mixed in."""
    rows = values.reshape(BANDS, ROWS)
    mixed = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        mixed = _stir(mixed * _MIX[k] + rows[:, k])
    return mixed.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of compared values the matches below which a pair is dropped.

    With a uniform prior the similarity after m of n matches follows
    Beta(m + 1, n - m + 1), and reaches t with probability P(Bin(n + 1, t) <= m).
    """
    table = {}
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        table[n] = m
    return table


def linked_pairs(sets_a: list[np.ndarray], sets_b: list[np.ndarray], same: bool, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """Index pairs of sets with Jaccard of at least ``threshold``; with ``same`` each pair of one list once."""
    least = least_matches(threshold, tolerance)
    sig_a = np.stack([min_hashes(s) for s in sets_a])
    sig_b = sig_a if same else np.stack([min_hashes(s) for s in sets_b])
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    small, large = np.minimum(size_a[:, None], size_b), np.maximum(size_a[:, None], size_b)
    alive = small >= threshold * large - 1e-9
    if same:
        alive &= np.arange(len(sets_a))[:, None] < np.arange(len(sets_b))
    i, j = np.nonzero(alive)
    matches = np.zeros(len(i), np.int32)
    for start in range(0, VALUES, STEP):
        matches += (sig_a[i, start : start + STEP] == sig_b[j, start : start + STEP]).sum(axis=1, dtype=np.int32)
        keep = matches >= least[start + STEP]
        i, j, matches = i[keep], j[keep], matches[keep]
        if not len(i):
            break
    good = np.zeros(len(i), bool)
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = sets_a[x], sets_b[y]
        both = np.concatenate([a, b])
        both.sort(kind="stable")
        shared = int((both[1:] == both[:-1]).sum())
        good[k] = shared >= threshold * (len(a) + len(b) - shared) - 1e-9
    return np.stack([i[good], j[good]], axis=1)


def set_key(s: np.ndarray, text: str) -> bytes:
    """Digest that names a shingle set; texts without words are named by the text itself."""
    return hashlib.md5(s.tobytes() if len(s) else b"\0" + text.encode("utf-8", "surrogatepass")).digest()


def _version():
    """Tells the texts of an id apart; null counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("version")


def prepared(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, key, n, bands)``: a hash of the text, a digest of the shingle set, its size, and band hashes.

    Texts without words have no bands.
    """

    def make():
        words = _Words()

        def run(batch: pa.RecordBatch):
            for doc, version, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
                s = shingles(text, words)
                yield doc, version, set_key(s, text), len(s), bands(min_hashes(s)).tolist() if len(s) else []

        return run

    return map_rows(docs.select("doc_id", _version(), "text"), "doc_id bigint, version bigint, key binary, n int, bands array<bigint>", make)


_PAIR = "rep bigint, links bigint, other bigint"


def _compare(threshold: float, tolerance: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        one, two = part["i"].iloc[0], part["j"].iloc[0]
        part = part.sort_values("rep", kind="stable")
        a = part if one == two else part[part["block"] == one]
        b = part if one == two else part[part["block"] == two]
        if not len(a) or not len(b):
            return pd.DataFrame({"rep": [], "links": [], "other": []})
        sets_a = [np.frombuffer(s, np.uint64) for s in a["shingles"]]
        sets_b = sets_a if one == two else [np.frombuffer(s, np.uint64) for s in b["shingles"]]
        pairs = linked_pairs(sets_a, sets_b, one == two, threshold, tolerance)
        if not len(pairs):
            return pd.DataFrame({"rep": [], "links": [], "other": []})
        ids_a, ids_b = a["rep"].to_numpy(), b["rep"].to_numpy()
        left, right = ids_a[pairs[:, 0]], ids_b[pairs[:, 1]]
        ends = np.concatenate([left, right])
        weight = np.concatenate([b["size"].to_numpy()[pairs[:, 1]], a["size"].to_numpy()[pairs[:, 0]]])
        ids, at = np.unique(ends, return_inverse=True)
        links = np.bincount(at, weight).astype(np.int64)
        # A spanning forest of the links: the smallest id reachable inside the task.
        root = np.arange(len(ids))
        x, y = at[: len(left)], at[len(left) :]
        while True:
            low = np.minimum(root[x], root[y])
            new = root.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"rep": ids, "links": links, "other": ids[root]})

    return run


def _place():
    """Order of rows; those without an id come last."""
    return F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("doc_id"), F.col("version").alias("version"))


def linked(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, version, key, n, class, copy_id, class_id, n_links)``.

    ``version`` is a hash of the text, ``key`` and ``n`` digest and size of its
    shingle set, ``class`` a number of the class that holds in this table alone.
    """
    rows = stage(prepared(docs), "ngram-docs")
    sets = rows.groupBy("key").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("size"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))
    # A set's number is written once with it, so it is no hash that two sets could share.
    sets = stage(sets.withColumn("rep", F.monotonically_increasing_id()), "ngram-sets")
    hashed = sets.select("rep", F.explode("bands").alias("band"))
    shared = hashed.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("band", "low")
    edges = hashed.join(shared, "band").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct()
    clusters = stage(components(edges), "ngram-clusters")

    chosen = sets.select("key", "first", "rep", "size", "n").join(clusters, sets["rep"] == clusters["id"]).drop("id")
    blocks = clusters.join(sets.select("rep", "n"), clusters["id"] == F.col("rep")).groupBy("comp").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    chosen = stage(chosen.join(blocks, "comp").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "ngram-chosen")

    def make():
        words = _Words()

        def run(batch: pa.RecordBatch):
            for text in texts_of(batch.column(0)):
                s = shingles(text, words)
                yield set_key(s, text), s.tobytes()

        return run

    # One text of each set is read again; the key found with it tells whose set it is.
    wanted = chosen.select(F.col("first.doc_id").alias("_id"), F.col("first.version").alias("_version"))
    texts = docs.select("doc_id", _version(), "text")
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["_id"]) & (texts["version"] == wanted["_version"]), "left_semi")
    found = map_rows(texts.select("text"), "key binary, shingles binary", make)
    ready = stage(chosen.drop("first").join(found, "key").drop("key").dropDuplicates(["rep"]), "ngram-shingles")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("p")
    met = ready.select("comp", "rep", "size", "block", "shingles", partner)
    met = met.withColumns({"i": F.least("block", "p"), "j": F.greatest("block", "p")}).drop("p")
    counted = stage(met.groupBy("comp", "i", "j").applyInPandas(_compare(threshold, tolerance), _PAIR), "ngram-links")

    links = counted.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(counted.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = sets.select("key", "rep", "size", F.col("first.doc_id").alias("copy_id"))
    named = named.join(links, "rep", "left").join(classes.withColumnRenamed("id", "rep"), "rep", "left")
    named = stage(named.select("key", "copy_id", F.coalesce("comp", "rep").alias("class"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("comp").isNotNull().alias("joined")), "ngram-named")
    # Only classes of several sets need a look at the others for their smallest id.
    least = named.where("joined").groupBy("class").agg(F.min("copy_id").alias("least"))
    named = named.join(least, "class", "left").withColumn("class_id", F.when(F.col("joined"), F.col("least")).otherwise(F.col("copy_id")))
    return rows.select("doc_id", "version", "key", "n").join(named.drop("joined", "least"), "key").select(
        "doc_id", "version", "key", "n", "class", "copy_id", "class_id", "n_links"
    )


def near_duplicate_rows(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, copy_id, class_id, n_links)``.

    ``copy_id`` is the smallest doc_id with the same shingle set, ``class_id`` the
    smallest of all rows connected by links, ``n_links`` the number of other rows
    whose set has a Jaccard of at least ``threshold``, copies included.
    Documents without words link only to equal texts. Null texts count as empty;
    repeated rows are copies of each other. Each text of an id is linked by
    itself, and so are rows without an id; where no row of a set or class has an
    id, its ``copy_id`` or ``class_id`` is null.
    """
    return linked(docs, threshold, tolerance).select("doc_id", "copy_id", "class_id", "n_links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """A view of ``near_duplicate_rows`` by id: rows with an id, and of an id with several shingle sets those of one.

    That is the set with the smallest digest; its links and classes count all rows with an id.
    """
    rows = stage(linked(docs.where(F.col("doc_id").isNotNull()), threshold, tolerance), "ngram-linked")
    ends = rows.groupBy("doc_id").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    if not ends.where("least <> most").isEmpty():
        rows = rows.join(ends.select("doc_id", "least"), "doc_id").where("key = least")
    return rows.select("doc_id", "copy_id", "class_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate class, columns as they were.

    The smallest doc_id stays, any other before a row without an id. Rows are
    named by id and text, so other texts of an id stay if their class has no
    smaller one. Of rows equal in both one stays, the first by its JSON form.
    Rows with neither id nor words all stay.
    """
    rows = stage(linked(docs), "ngram-linked")
    nothing = F.col("doc_id").isNull() & (F.col("n") == 0)
    first = rows.where(~nothing).groupBy("class").agg(F.min(_place()).alias("f")).select(F.col("f.doc_id").alias("_id"), F.col("f.version").alias("_version"))
    several = rows.where(~nothing).groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).agg((F.count(F.lit(1)) > 1).alias("_several"))
    first = first.join(several, first["_id"].eqNullSafe(several["_id"]) & (first["_version"] == several["_version"])).select(first["_id"], first["_version"], "_several")
    bare = rows.where(nothing).select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.lit(False).alias("_several")).distinct()
    kept = stage(first.unionByName(bare), "ngram-kept")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "doc_id", "text", _version())
    whole = whole.join(broadcast_if_small(kept), whole["doc_id"].eqNullSafe(kept["_id"]) & (whole["version"] == kept["_version"]))
    rest = whole.where(~F.col("_several")).select("_row")
    if not kept.where("_several").isEmpty():
        again = whole.where("_several").groupBy("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        rest = rest.unionByName(again.agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row"))
    return rest.select("_row.*")
