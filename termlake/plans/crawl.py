"""Crawling a table of pages, and indexing what was found."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html, urls
from ..operators import frontier as fr
from ..operators.robots import DEFAULT_AGENT, compile_rules, robots_filter
from ..session import broadcast_if_small, stage
from ..sources.pages import read_pages
from .index import Index, build_index

DEFAULT_MAX_DEPTH = 2
REGROUP = 8  # after so many levels the visited URLs are written as one table


@dataclass
class Crawl:
    """``visited(url, depth, pos, fetched, key)``, ``frontier(url, depth)`` of the
    links found, and ``pages(url, title, text, depth, pos)``."""

    visited: DataFrame
    frontier: DataFrame
    pages: DataFrame


def crawl_closure(
    pages: DataFrame,
    seeds: str | Iterable[str] | DataFrame,
    max_depth: int | None = DEFAULT_MAX_DEPTH,
    allowed_domains: Iterable[str] | None = None,
    robots: DataFrame | None = None,
    robots_mode: str = "allow-on-error",
    ignore_robots: bool = False,
    max_links_per_depth: int | None = None,
    agent: str = DEFAULT_AGENT,
    strip_port: bool = True,
    parser: str = "html",
) -> Crawl:
    """Breadth-first crawl of ``pages(url, html)`` from ``seeds``.

    A list of seeds crawls the host root of the first one only. A table
    ``(url, pos)`` crawls every seed's own host root; links between roots are
    not followed, and ``pos`` orders the seeds. A URL that a filter rejects is not
    visited; one without a page is visited but gives no result. ``max_depth=None``
    goes on until nothing new is found; there is no cap on links unless one is given.
    """
    if max_depth is not None and max_depth < 0:
        raise ValueError("max_depth must not be negative")
    spark = pages.sparkSession
    domains = None if allowed_domains is None else list(allowed_domains)
    if isinstance(seeds, DataFrame):
        roots = seeds.select(urls.host_root(F.col("url"), strip_port).alias("_root")).distinct()
        roots = broadcast_if_small(stage(roots, "roots"))
        first = seeds.where(urls.is_http(F.col("url"))).select("url", F.col("pos").cast("bigint").alias("pos"))

        def on_roots(df: DataFrame) -> DataFrame:
            keyed = df.withColumn("_root", urls.host_root(F.col("url"), strip_port))
            return keyed.join(roots, "_root", "left_semi").drop("_root")
    else:
        listed = [seeds] if isinstance(seeds, str) else list(seeds or [])
        root = urls.plain_root(listed[0], strip_port) if listed else ""
        rows = [(s, i) for i, s in enumerate(listed) if isinstance(s, str) and s.startswith("http")]
        first = spark.createDataFrame(rows, "url string, pos bigint")

        def on_roots(df: DataFrame) -> DataFrame:
            return df.where(urls.same_root(F.col("url"), root, strip_port))

    def in_scope(df: DataFrame) -> DataFrame:
        return on_roots(df.where(urls.in_domains(F.col("url"), domains)))

    rules = None
    if robots is not None and robots_mode != "allow-on-error" and not ignore_robots:
        # Compiled once, for the hosts that can be asked about.
        hosts = first.select(urls.netloc(F.col("url")).alias("host"))
        hosts = hosts.union(read_pages(pages).where(urls.is_http(F.col("url"))).transform(in_scope).select(urls.netloc(F.col("url"))))
        rules = stage(compile_rules(robots.join(hosts.distinct(), "host", "left_semi"), agent), "robots")

    def permitted(df: DataFrame) -> DataFrame:
        if ignore_robots:
            return df
        return robots_filter(df, robots, robots_mode, agent, compiled=rules).where("allowed").drop("allowed")

    # One pass over the pages; later levels read only URLs and links.
    usable = in_scope(read_pages(pages).where(urls.is_http(F.col("url"))))
    graph = stage(fr.link_graph(usable, parser), "links")

    frontier = permitted(first.where(urls.in_domains(F.col("url"), domains)))
    frontier = frontier.select(urls.strip_fragment(F.col("url")).alias("url"), "pos")
    frontier = frontier.groupBy("url").agg(F.min("pos").alias("pos"))

    seen: list[DataFrame] = []
    found = [spark.createDataFrame([], "url string, depth int")]
    depth = 0
    while True:
        todo = fr.visited_anti(frontier, fr.accumulate_pages(seen)) if seen else frontier
        todo = stage(permitted(in_scope(todo)), f"todo{depth}")
        if todo.isEmpty():
            break
        # The frontier is broadcast when small, so the graph is read in place.
        hit = stage(fr.frontier_fetch(todo, graph), f"level{depth}")
        missed = todo.join(hit.select("url"), "url", "left_anti")
        at = F.lit(depth).alias("depth")
        got = hit.select("url", at, "pos", F.lit(True).alias("fetched"), "key")
        seen.append(got.unionByName(missed.select("url", at, "pos", F.lit(False).alias("fetched"), F.lit(None).cast(hit.schema["key"].dataType).alias("key"))))
        if depth == max_depth:
            break
        links = fr.discovered(hit, same_root=None if not isinstance(seeds, DataFrame) else strip_port)
        fresh = fr.unseen_links(fr.dedupe_links(in_scope(links)), fr.accumulate_pages(seen), depth)
        frontier = stage(fr.depth_link_cap(fresh, max_links_per_depth), f"frontier{depth}")
        depth += 1
        found.append(frontier.select("url", F.lit(depth).alias("depth")))
        if len(seen) % REGROUP == 0:
            seen = [stage(fr.accumulate_pages(seen), "visited")]
    none = graph.select("url", F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("pos"), F.lit(False).alias("fetched"), "key").limit(0)
    visited = fr.accumulate_pages(seen or [none])
    return Crawl(visited, fr.accumulate_pages(found), _texts(usable, visited, parser))


def _texts(usable: DataFrame, visited: DataFrame, parser: str) -> DataFrame:
    """Title and text of the fetched pages; HTML is parsed for these only."""
    key = F.col("page_id") if "page_id" in usable.columns else F.xxhash64("html")
    keyed = usable.select(urls.strip_fragment(F.col("url")).alias("url"), key.alias("key"), "html")
    wanted = visited.where("fetched").select("url", "key", "depth", "pos")
    found = keyed.join(broadcast_if_small(wanted), ["url", "key"])
    if "page_id" not in usable.columns:
        found = found.dropDuplicates(["url"])
    return html.extract(found, want=("title", "text"), parser=parser).drop("key")


def crawl_and_index(
    pages: DataFrame,
    seeds: str | Iterable[str] | DataFrame,
    out_dir: str | None = None,
    max_depth: int | None = 0,
    allowed_domains: Iterable[str] | None = None,
    **how,
) -> tuple[DataFrame, Index]:
    """Crawl, then index. Returns the pages and the index, written to ``out_dir``.

    An empty list of domains means no domain filter.
    """
    domains = None if allowed_domains is None else (list(allowed_domains) or None)
    crawl = crawl_closure(pages, seeds, max_depth=max_depth, allowed_domains=domains, **how)
    found = stage(crawl.pages, "found")
    return found, build_index(found, out_dir, unique_ids=True)
