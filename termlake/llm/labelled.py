"""Labelled rows for training: a split by id and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 20


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def sample(labels: DataFrame, column: str, usable: Column, bound: int) -> DataFrame:
    """At most ``bound`` rows ``(doc_id, label)`` of each label, drawn by a hash of the id.

    One label per id: of several the largest. The draw aims a little below the
    bound, so the limit that guarantees it has nothing to cut as a rule.
    """
    rows = labels.where(usable & F.col(column).isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = None
    for label, n in sorted(counts.items()):
        share = min(1.0, 0.97 * bound / n) if n > bound else 1.0
        part = rows.where((F.col("label") == label) & (F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)) < int(share * _PARTS)))
        part = part.limit(bound) if n > bound else part
        drawn = part if drawn is None else drawn.unionByName(part)
    return rows.limit(0) if drawn is None else drawn
