"""Joins, ranks and top-k that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, broadcast_if_small, stage

# At most this many keys can each hold 1/HOT_KEYS of the rows.
HOT_KEYS = 10_000
HOT_KEY_BYTES = 256
# Numbers of hits are told apart up to this one when the broadcast part of a lookup is chosen.
HOT_HITS = 1_024
# Spark prunes each task's rows before a ranking shuffle up to this rank.
GROUP_LIMIT = 1_000
SALTS = 1_024


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group with their rank.

    Every task keeps only its own first k rows of a group before the shuffle;
    beyond Spark's limit for that, groups are first cut within salted parts.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    if k > GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        local = W.partitionBy(*by, "_salt").orderBy(*order)
        df = salted.withColumn("_rank", F.row_number().over(local)).where(F.col("_rank") <= k).drop("_rank", "_salt")
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def join_by_frequency(facts: DataFrame, lookup: DataFrame, key: str, hits: str) -> DataFrame:
    """Left join to a ``lookup`` unique on ``key`` that knows how many fact rows
    each key has (``hits``).

    A lookup measured to be small is broadcast. Otherwise the frequent keys, of
    which there are at most ``HOT_KEYS`` by counting, are broadcast and their
    fact rows are not moved at all; only the rest is shuffled by key, and no key
    in it holds more than ``1/HOT_KEYS`` of the rows. Fact rows with a null key
    stay where they are.
    """
    size = lookup.agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum(hits).alias("rows"),
        F.sum(F.octet_length(key) + 32).alias("bytes"),
    ).first()
    if size["keys"] <= BROADCAST_MAX_ROWS and (size["bytes"] or 0) <= BROADCAST_MAX_BYTES:
        return facts.join(F.broadcast(lookup), key, "left")
    return split_join(facts, lookup, key, hits, size["rows"])


def split_join(facts: DataFrame, lookup: DataFrame, key: str, hits: str, total: int) -> DataFrame:
    """The large case of :func:`join_by_frequency`."""
    values = [c for c in lookup.columns if c != key]
    often = (F.col(hits) * HOT_KEYS >= total) & (F.octet_length(key) <= HOT_KEY_BYTES)
    floor = hot_floor(lookup, key, hits)
    hot = lookup.where(often if floor is None else often | (F.col(hits) >= floor))
    tagged = facts.join(F.broadcast(hot), key, "left")
    settled = tagged.where(F.col(hits).isNotNull() | F.col(key).isNull())
    cold = tagged.where(F.col(hits).isNull() & F.col(key).isNotNull()).drop(*values).join(lookup, key, "left")
    return settled.unionByName(cold)


def hot_floor(lookup: DataFrame, key: str, hits: str, least: int = 1) -> int | None:
    """Smallest number of hits, ``least`` at least, from which on all keys together may be broadcast.

    None where even the keys of ``HOT_HITS`` hits are too many.
    """
    at = F.least(F.col(hits), F.lit(HOT_HITS)).alias("at")
    sizes = lookup.where(F.col(hits) >= least).groupBy(at).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(key) + 32).alias("b"))
    rows, volume, floor = 0, 0, None
    found = sorted(sizes.collect(), key=lambda r: -r["at"])
    for r in found:
        rows, volume = rows + r["n"], volume + (r["b"] or 0)
        if rows > BROADCAST_MAX_ROWS or volume > BROADCAST_MAX_BYTES:
            return floor
        floor = r["at"]
    return least


def range_blocks(df: DataFrame, by: list[str], order: list[str], label: str) -> DataFrame:
    """Stage ``df`` in blocks that follow ``(by, order)``; adds ``_block``.

    Range partitioning on the whole sort key cuts a large group into many
    blocks. Staging fixes the cut, so a re-run task cannot move a row.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(n, *by, *order).withColumn("_block", F.spark_partition_id())
    return stage(cut, label)


def block_offsets(blocks: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the same group in earlier blocks, as ``_before`` per (group, block)."""
    counts = blocks.groupBy(*by, "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    if not by:
        earlier = W.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def ranked(df: DataFrame, by: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """Exact ``row_number`` per group (or overall) with no group in one task.

    ``order`` must be unique within a group. Rows are numbered within their
    block; what precedes a block is one small row per (group, block).
    """
    blocks = range_blocks(df, by, order, "ranked")
    local = blocks.withColumn("_local", F.row_number().over(W.partitionBy(*by, "_block").orderBy(*order)))
    # Staged and measured, so that the rows are not shuffled to meet their block.
    offsets = stage(block_offsets(blocks, by).drop("_n"), "offsets")
    joined = local.join(broadcast_if_small(offsets), [*by, "_block"])
    return joined.withColumn(rank, F.col("_before") + F.col("_local")).select(*df.columns, rank)
