"""Breadth-first expansion over a table of links.

A crawl reads ``graph(url, links)``, one narrow row per page of the crawled
host; page texts are joined only once, at the end. Every level is staged, so
the lineage does not grow.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html, urls
from ..session import broadcast_if_small
from .keys import ranked

# Up to this cap a level is ranked by one top-n; a larger one by range blocks.
SMALL_CAP = 1_000


def link_graph(pages: DataFrame, parser: str = "html") -> DataFrame:
    """``(url, key, links)``: fragment-free URL, which page stands for it, and
    its distinct ``http`` links without fragments, in page order.

    Of several pages with the same URL the lowest ``page_id`` stands (the lowest
    hash of the HTML when there is no such column).
    """
    key = F.col("page_id") if "page_id" in pages.columns else F.xxhash64("html")
    keyed = pages.select("url", key.alias("key"), "html")
    linked = html.extract(keyed, want=("links",), parser=parser)
    clean = F.array_distinct(F.transform(F.filter("links", urls.is_http), urls.strip_fragment))
    rows = linked.select(urls.strip_fragment(F.col("url")).alias("url"), "key", clean.alias("links"))
    return rows.groupBy("url").agg(F.min("key").alias("key"), F.min_by("links", "key").alias("links"))


def visited_anti(frontier: DataFrame, visited: DataFrame) -> DataFrame:
    """Frontier URLs that were not visited before."""
    return frontier.join(visited.select("url"), "url", "left_anti")


def frontier_fetch(frontier: DataFrame, graph: DataFrame) -> DataFrame:
    """Frontier rows whose page exists, with its links."""
    return graph.join(broadcast_if_small(frontier), "url")


def discovered(fetched: DataFrame, same_root: bool | None = None) -> DataFrame:
    """``(url, parent_pos, link_pos)``: links of fetched pages.

    With ``same_root`` (whether ports are stripped) only links to the page's own host root.
    """
    rows = fetched.select(F.col("url").alias("_from"), F.col("pos").alias("parent_pos"), F.posexplode("links").alias("link_pos", "url"))
    if same_root is not None:
        rows = rows.where(urls.host_root(F.col("url"), same_root) == urls.host_root(F.col("_from"), same_root))
    return rows.drop("_from")


def dedupe_links(links: DataFrame) -> DataFrame:
    """First occurrence of each link; a page has each of its links once.

    Numbers only in the aggregation buffers, so tasks combine by hash before
    the shuffle and a link found on most pages costs one row per task.
    """
    return links.groupBy("url").agg(
        F.min("parent_pos").alias("parent_pos"), F.min_by("link_pos", "parent_pos").alias("link_pos")
    )


def unseen_links(links: DataFrame, visited: DataFrame, depth: int) -> DataFrame:
    """Drops links to pages that were visited before their parent's turn ended.

    For links already reduced to their first occurrence: if that one is dropped,
    so are all later ones.

    A page of the same level that comes later is still a new link here; the
    next level drops it.
    """
    seen = visited.select("url", F.col("depth").alias("_d"), F.col("pos").alias("_p"))
    joined = links.join(seen, "url", "left")
    before = (F.col("_d") < depth) | (F.col("_p") <= F.col("parent_pos"))
    return joined.where(F.col("_d").isNull() | ~before).drop("_d", "_p")


def depth_link_cap(links: DataFrame, cap: int | None) -> DataFrame:
    """``(url, pos)``: the first ``cap`` links in discovery order; None: all of them."""
    order = ["parent_pos", "link_pos"]
    if cap is None:
        return ranked(links, [], order, "pos").select("url", (F.col("pos") - 1).cast("bigint").alias("pos"))
    if cap <= SMALL_CAP:
        first = links.orderBy(*order).limit(cap)
        listed = first.agg(F.sort_array(F.collect_list(F.struct(*order, "url"))).alias("l"))
        return listed.select(F.posexplode("l").alias("pos", "_l")).select(
            F.col("_l.url").alias("url"), F.col("pos").cast("bigint").alias("pos")
        )
    numbered = ranked(links, [], order, "pos").where(F.col("pos") <= cap)
    return numbered.select("url", (F.col("pos") - 1).cast("bigint").alias("pos"))


def accumulate_pages(levels: Iterable[DataFrame]) -> DataFrame:
    """All levels in one table."""
    out = None
    for level in levels:
        out = level if out is None else out.unionByName(level)
    return out


def crawl_stats(visited: DataFrame, frontier: DataFrame) -> DataFrame:
    """``(depth, processed, next_links)`` per level of a finished crawl."""
    done = visited.select("depth", F.col("fetched").cast("int").alias("_p"), F.lit(0).alias("_l"))
    # A link found at one depth waits in the frontier of the next.
    found = frontier.select((F.col("depth") - 1).alias("depth"), F.lit(0).alias("_p"), F.lit(1).alias("_l"))
    return done.unionByName(found).groupBy("depth").agg(
        F.sum("_p").alias("processed"), F.sum("_l").alias("next_links")
    )
