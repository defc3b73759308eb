"""Per-host pacing of a table of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .keys import range_blocks


def host_throttle(
    requests: DataFrame,
    min_interval: float = 1.0,
    host_col: str = "host",
    ts_col: str = "ts",
    tie_col: str | None = None,
    delays: DataFrame | None = None,
) -> DataFrame:
    """Adds ``send_us`` and ``wait_us``: when each request may be sent, in
    microseconds, with at least the interval between two requests to a host.

    ``ts_col`` is a timestamp, or a number of seconds. ``delays(host,
    crawl_delay)`` replaces the interval where it is set and not 0.

    With requests i = 0, 1, ... of a host at times t_i and interval m, request i
    goes out at ``i*m + max(t_j - j*m for j <= i)``. Both i and the running
    maximum are prefix values, so they are computed within range blocks and
    completed by one small row per (host, block): a host with a third of all
    requests is spread over many tasks.
    """
    rows = requests.withColumn("_t", _micros(requests, ts_col))
    if delays is not None:
        table = delays.select(F.col("host").alias(host_col), F.nullif("crawl_delay", F.lit(0.0)).alias("_delay"))
        rows = rows.join(broadcast_if_small(table), host_col, "left")
    else:
        rows = rows.withColumn("_delay", F.lit(None).cast("double"))
    interval = F.coalesce("_delay", F.lit(float(min_interval)))
    rows = rows.withColumn("_m", F.round(interval * 1_000_000).cast("bigint")).drop("_delay")

    if tie_col is None:
        # Lets equal times be cut into several blocks.
        rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    order = ["_t", tie_col or "_tie"]
    blocks = range_blocks(rows, [host_col], order, "requests")
    inside = W.partitionBy(host_col, "_block").orderBy(*order)
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = blocks.withColumn("_i", (F.row_number().over(inside) - 1).cast("bigint"))
    local = local.withColumn("_peak", F.max(F.col("_t") - F.col("_i") * F.col("_m")).over(so_far))

    per_block = local.groupBy(host_col, "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_peak").alias("_top"), F.max("_m").alias("_bm")
    )
    earlier = W.partitionBy(host_col).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    per_block = per_block.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("bigint")))
    per_block = per_block.withColumn(
        "_carried", F.max(F.col("_top") - F.col("_before") * F.col("_bm")).over(earlier)
    ).select(host_col, "_block", "_before", "_carried")

    joined = local.join(per_block, [host_col, "_block"])
    peak = F.greatest("_carried", F.col("_peak") - F.col("_before") * F.col("_m"))
    send = (F.col("_before") + F.col("_i")) * F.col("_m") + peak
    sent = joined.withColumn("send_us", send).withColumn("wait_us", F.col("send_us") - F.col("_t"))
    return sent.select(*requests.columns, "send_us", "wait_us")


def _micros(requests: DataFrame, ts_col: str) -> Column:
    kind = requests.schema[ts_col].dataType.simpleString()
    if kind == "timestamp":
        return F.unix_micros(ts_col)
    if kind == "timestamp_ntz":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(ts_col))
    return F.round(F.col(ts_col) * 1_000_000).cast("bigint")
