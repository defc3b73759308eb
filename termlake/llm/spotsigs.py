"""SpotSigs fingerprints in built-in functions: chains of content words after common words.

A spot signature is a common word (the anchor) and the next ``CHAIN`` content
words after it. Every word is an anchor or a content word, so the k-th anchor at
place i has i - k content words before it, and its chain is a slice of the
content words: no loop looks ahead. The fingerprint is the sorted set of short
hashes of the signatures; two fingerprints are alike by Jaccard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stage
from .line_chunks import bind

CHAIN = 2
LEAST_SPOTS = 5  # with fewer spots, all words are signatures too
HEX = 8  # digits of a signature's hash
# Common words of English, French, German and Spanish, by language.
ANCHORS = (
    "the of and to in a is that it for was on as with be by at this are an from "
    "de la le et les des un une du en que est qui dans pour par sur au avec ce il "
    "der die das und den von zu mit ein eine dem ist im nicht auf es sich auch "
    "el los las y del se por con una para al lo como su"
).split()

EDGES = 255  # quantiles of the ids
BLOCK_ROWS = 500


def signatures(text: Column) -> Column:
    """Distinct signatures of a text as strings.

    Texts with few spots have all their words instead, those without a word the
    text itself; null and empty texts have none.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def parts(w: Column) -> Column:
        anchors = F.filter(F.transform(w, lambda x, i: F.when(x.isin(ANCHORS), F.struct(i.alias("at"), x.alias("word")))), lambda a: a.isNotNull())
        return F.struct(w.alias("words"), F.filter(w, lambda x: ~x.isin(ANCHORS)).alias("content"), anchors.alias("anchors"))

    def spots(b: Column) -> Column:
        def spot(a: Column, k: Column) -> Column:
            chain = F.slice(b["content"], a["at"] - k + 1, CHAIN)
            return F.when(a["at"] - k + CHAIN <= F.size(b["content"]), F.concat_ws(" ", a["word"], F.array_join(chain, " ")))

        found = F.array_distinct(F.filter(F.transform(b["anchors"], spot), lambda s: s.isNotNull()))
        return F.struct(b["words"].alias("words"), found.alias("spots"))

    def choose(b: Column) -> Column:
        few = F.when(F.size(b["words"]) > 0, F.array_distinct(F.concat(b["spots"], b["words"]))).otherwise(F.array(text))
        return F.when(F.size(b["spots"]) >= LEAST_SPOTS, b["spots"]).otherwise(few)

    found = bind(bind(bind(words, parts), spots), choose)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(found)


def hashes(text: Column) -> Column:
    """Sorted distinct hashes of the signatures, ``HEX`` digits each."""
    found = F.transform(signatures(text), lambda s: F.substring(F.md5(s.cast("binary")), 1, HEX))
    return F.array_sort(F.array_distinct(found))


def fingerprint(text: Column) -> Column:
    """The hashes of a text run together."""
    return F.array_join(hashes(text), "")


def hashes_of(print_: Column) -> Column:
    """The hashes of a fingerprint, in order."""
    return F.regexp_extract_all(print_, F.lit(f".{{{HEX}}}"), F.lit(0))


def set_likeness(a: Column, b: Column) -> Column:
    """Jaccard of two arrays of distinct hashes; 1 for two empty ones."""
    n = F.size(a) + F.size(b)
    return F.when(n == 0, F.lit(1.0)).otherwise(bind(F.size(F.array_intersect(a, b)), lambda shared: shared / (n - shared)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two fingerprints."""
    return set_likeness(hashes_of(a), hashes_of(b))


def with_next(docs: DataFrame, columns: list[str], made: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` with ``_next_*`` for ``columns`` of the next row by descending id, after the last the first.

    ``docs`` has ``doc_id`` and ``_hash``. Columns in ``made`` are added to the rows on the way,
    after the few guests below were looked up, so their cost is paid once a row.

    Null ids come last; equal ids are ordered by the hash of their text. Ids are
    cut into blocks: quantiles, and equal steps between two of them. Each row is
    moved once, with its block; the first row of the block below is added to a
    block as a guest that only serves as the last row's successor.
    """
    n = docs.count()
    if n == 0:
        return docs.withColumns(made).withColumns({f"_next_{c}": F.col(c) for c in columns})
    steps = max(1, math.ceil(n / (BLOCK_ROWS * (EDGES + 1))))
    cuts = min(EDGES, max(0, n // BLOCK_ROWS))
    shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
    low, high, edges = docs.agg(
        F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", shares, 10_000) if cuts else F.lit(None).cast("array<bigint>")
    ).first()
    bounds = sorted({e for e in edges or [] if e is not None})
    starts = [low if low is not None else 0, *bounds]
    widths = [max(1, b - a) for a, b in zip(starts, [*bounds, (high if high is not None else 0) + 1])]
    place = F.size(F.filter(F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>"), lambda e: F.col("doc_id") >= e))
    step = F.floor(
        (F.col("doc_id") - F.element_at(F.array(*map(F.lit, starts)), place + 1)) * F.lit(float(steps)) / F.element_at(F.array(*map(F.lit, widths)), place + 1)
    )
    # Null ids, ordered by hash, fill blocks of their own below all others.
    nulls = F.floor((F.col("_hash").cast("double") / float(1 << 64) + 0.5) * F.lit(float(cuts + 1))) - (cuts + 2)
    blocked = docs.withColumn("_block", F.when(F.col("doc_id").isNull(), nulls).otherwise(place * F.lit(steps) + F.least(step, F.lit(steps - 1))).cast("bigint"))

    order_key = F.struct(F.col("doc_id"), F.col("_hash"))
    tops = stage(blocked.groupBy("_block").agg(F.max(order_key).alias("top")), "spot-blocks")
    # One row per block: ordering them is small work whatever the table.
    above = F.lead("_block").over(W.partitionBy(F.lit(0)).orderBy("_block"))
    ring = tops.withColumn("_to", above)
    last = ring.agg(F.min("_block")).first()[0]
    ring = ring.withColumn("_to", F.coalesce("_to", F.lit(last))).select(
        F.col("_to"), F.col("top.doc_id").alias("_id"), F.col("top._hash").alias("_h")
    )
    guests = blocked.join(
        broadcast_if_small(ring), blocked["doc_id"].eqNullSafe(F.col("_id")) & (blocked["_hash"] == F.col("_h"))
    ).withColumn("_block", F.col("_to")).drop("_to", "_id", "_h")
    both = blocked.withColumn("_guest", F.lit(False)).unionByName(guests.withColumn("_guest", F.lit(True))).withColumns(made)
    w = W.partitionBy("_block").orderBy(F.col("_guest"), F.col("doc_id").desc_nulls_last(), F.col("_hash").desc())
    for c in columns:
        both = both.withColumn(f"_next_{c}", F.lead(c).over(w))
    return both.where(~F.col("_guest")).drop("_guest", "_block")


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    Edited: the last third of the code points replaced by as many first ones of
    the next document by descending id. Null texts count as empty.
    """
    ready = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ready = ready.withColumn("_hash", F.xxhash64("text"))
    paired = with_next(ready, ["text", "_own"], {"_own": hashes(F.col("text"))})
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("_next_text"), F.lit(1), third))
    built = paired.withColumn("n_chars", n.cast("bigint")).withColumn("edited", edited)
    built = built.withColumn("_edited", hashes(F.col("edited")))
    return built.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.array_join("_own", "").alias("fingerprint"), F.array_join("_edited", "").alias("edited_fingerprint"),
        set_likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        set_likeness(F.col("_own"), F.col("_next__own")).alias("near_next"),
    )


def similar_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Near duplicates: ``(class_id, doc_id)`` membership, and pairs of classes ``(a, b, likeness)``.

    A class is the documents of one fingerprint, named by the smallest id; those
    with an empty one are in none. Sets are partitioned by length so that
    partners lie in the same or the next partition. Only the first hashes of a
    set, enough that partners share one, are joined; a pair is kept at its first
    shared hash and compared only if the lengths allow the threshold.
    """
    prints = docs.select("doc_id", fingerprint(F.col("text")).alias("fingerprint")).where("fingerprint != ''")
    prints = stage(prints, "spot-prints")
    sets = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"))
    members = prints.join(sets, "fingerprint").select("class_id", "doc_id")
    n = F.length("fingerprint") / HEX
    sets = stage(sets.withColumn("n", n.cast("int")).withColumn("part", F.floor(F.log(n) / F.lit(-math.log(threshold))).cast("int")), "spot-sets")
    head = sets.withColumn("keep", (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))
    head = head.select("class_id", "n", "part", "fingerprint", F.slice(hashes_of(F.col("fingerprint")), F.lit(1), F.col("keep")).alias("head"))
    left = head.select(*[F.col(c).alias(f"{c}_a") for c in ("class_id", "n", "part", "fingerprint", "head")], F.explode("head").alias("h"))
    right = head.select(*[F.col(c).alias(f"{c}_b") for c in ("class_id", "n", "part", "fingerprint", "head")], F.explode("head").alias("h"))
    near = (F.col("part_b") - F.col("part_a")).isin(0, 1) & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("class_id_a") < F.col("class_id_b"))))
    fits = F.col("n_a") >= F.col("n_b") * threshold - 1e-9
    pairs = left.join(right, "h").where(near & fits & (F.array_min(F.array_intersect("head_a", "head_b")) == F.col("h")))
    pairs = pairs.select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b"), likeness(F.col("fingerprint_a"), F.col("fingerprint_b")).alias("likeness"))
    return members, pairs.where(F.col("likeness") >= threshold)
