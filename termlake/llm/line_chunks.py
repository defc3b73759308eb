"""Line dedup by content-defined chunks, in built-in functions only.

Every line has a hash; a rolling hash over the last ``REACH`` lines closes a chunk
where it falls on one of ``1/MEAN_LINES`` of its values. Boundaries depend on nearby
lines alone, so a passage is cut alike wherever it stands. Chunks of two or more
lines whose hash occurs again are compared byte by byte; of equal ones the first,
by document and place, stays and the others are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, stage

REACH = 2
MEAN_LINES = 3
LEAST_LINES = 2
LEAST_BYTES = 40  # shorter chunks are too common to mean a copy
GROUP_BYTES = 4 << 20  # most bytes of repeated chunks that are broadcast

# Line hashes are below 2**28 and the factor is small, so no product overflows.
FACTOR = 31


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("bigint")


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once.

    Spark puts an expression into a lambda as it stands and would compute it for
    every element; a lambda's own variable is a plain read.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def chunks(text: Column) -> Column:
    """Array of ``(pos, lines, body)`` that joined by newlines give the text back.

    ``pos`` counts from 0. Null text has none; the empty text has one empty line.
    """

    def ends(hashes: Column) -> Column:
        """Numbers of the closing lines, counted from 1, and of the last line."""

        def close(h: Column, i: Column) -> Column:
            rolled = h
            for back in range(1, REACH):
                rolled = rolled * FACTOR + F.when(i >= back, F.element_at(hashes, F.greatest(i - back + 1, F.lit(1)))).otherwise(0)
            return F.when(F.pmod(F.shiftrightunsigned(rolled, 4), F.lit(MEAN_LINES)) == 0, i + 1)

        found = F.filter(F.transform(hashes, close), lambda e: e.isNotNull())
        return F.array_distinct(F.concat(found, F.array(F.size(hashes))))

    def cut(b: Column) -> Column:
        def chunk(e: Column, k: Column) -> Column:
            before = F.when(k > 0, F.element_at(b["ends"], F.greatest(k, F.lit(1)))).otherwise(0)
            body = F.array_join(F.slice(b["lines"], before + 1, e - before), "\n")
            return F.struct(k.alias("pos"), (e - before).alias("lines"), body.alias("body"))

        return F.transform(b["ends"], chunk)

    hashed = bind(F.split(text, "\n", -1), lambda x: F.struct(x.alias("lines"), F.transform(x, line_hash).alias("hashes")))
    ended = bind(hashed, lambda b: F.struct(b["lines"].alias("lines"), ends(b["hashes"]).alias("ends")))
    none = F.array().cast("array<struct<pos:int,lines:int,body:string>>")
    return F.when(text.isNotNull(), bind(ended, cut)).otherwise(none)


def comparable(chunk: Column) -> Column:
    return (chunk["lines"] >= LEAST_LINES) & (F.octet_length(chunk["body"]) >= LEAST_BYTES)


def _place() -> Column:
    """Order of chunks over the corpus; a null id comes first."""
    return F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col("version").alias("v"), F.col("pos").alias("p"))


def repeated(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, pos)`` of all chunks to remove, from ``(doc_id, text)``.

    First only hashes are counted. Bodies travel for repeated hashes alone, and
    equal ones are merged in each task before they do; the place of the first
    equal chunk follows from a minimum. Rows equal in doc_id and text are one
    document, so a repeated row doesn't make its own chunks copies; rows that
    share only the doc_id are told apart by ``version``, a hash of the text.
    """
    worth = F.filter(chunks(F.col("text")), comparable)
    found = docs.select("doc_id", F.xxhash64("text").alias("version"), F.explode(worth).alias("c"))
    found = found.select("doc_id", "version", "c.pos", "c.body").withColumn("key", F.xxhash64("body"))
    ends = [F.min(_place()).alias("first"), F.max(_place()).alias("last")]
    keys = stage(found.groupBy("key").agg(*ends).where("first != last").select("key"), "line-keys")
    # Measured small, the repeated hashes go to the texts; else chunks are shuffled by hash.
    again = stage(found.join(broadcast_if_small(keys), "key", "left_semi"), "line-chunks")
    groups = again.groupBy("key", "body").agg(*ends).where("first != last").select("key", "body", "first")
    # Bodies are long: every executor and the driver would hold each, so only few are broadcast.
    groups = broadcast_if_small(stage(groups, "line-groups"), max_bytes=GROUP_BYTES)
    return again.join(groups, ["key", "body"]).where(_place() != F.col("first")).select("doc_id", "version", "pos").distinct()


def removals(docs: DataFrame) -> DataFrame:
    """``(_id, _version, _gone)`` per document with something to remove: the chunk numbers."""
    gone = repeated(docs).groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
    return stage(gone.agg(F.collect_list("pos").alias("_gone")), "line-removals")


def _kept_text(text: Column, gone: Column) -> Column:
    def rest(c: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(c) - 1), gone)
        return F.array_join(F.transform(kept, lambda k: F.element_at(c, k + 1)["body"]), "\n")

    return bind(chunks(text), rest)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the new ``text``, all other columns as they were, and ``_n_removed`` chunks.

    Documents without repeats keep their text, null included. A text whose chunks
    all go becomes empty.
    """
    gone = broadcast_if_small(removals(docs.select("doc_id", "text")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "doc_id", "text")
    same = rows["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(rows["text"]) == gone["_version"])
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(_kept_text(F.col("text"), F.col("_gone")))
    columns = [text.alias(c) if c == "text" else F.col(f"_row.{c}").alias(c) for c in docs.columns if c != "_n_removed"]
    return rows.join(gone, same, "left").select(*columns, F.coalesce(F.size("_gone"), F.lit(0)).alias("_n_removed"))
