import random

import pytest
from pyspark.sql import functions as F

from termlake.functions.html import read_page
from termlake.operators import frontier as fr
from termlake.operators import pacing, robots
from termlake.plans import crawl
from termlake.sources.pages import read_pages

PAGE = "page_id long, url string, html string"


def page(pid, url, *links, title="T"):
    anchors = "".join(f'<a href="{x}">l</a>' for x in links)
    return pid, url, f"<html><head><title>{title}</title></head><body>text {pid} {anchors}</body></html>"


def distances(pages, seeds):
    """Fewest links from a seed to each URL of the seeds' host, by relaxing an edge list."""
    edges = set()
    for _, url, html in pages:
        edges |= {(url.split("#")[0], x.split("#")[0]) for x in read_page(url, html)[2] if x.startswith("http://a.org/")} if html else set()
    best = dict.fromkeys(seeds, 0)
    for _ in range(len(pages) + 1):
        for a, b in edges:
            if a in best:
                best[b] = min(best.get(b, 10**9), best[a] + 1)
    return best


def web(n=60, seed=1):
    rng = random.Random(seed)
    urls = [f"http://a.org/{i}" for i in range(n)] + [f"http://b.org/{i}" for i in range(5)]
    pages = []
    for i, u in enumerate(urls):
        links = [rng.choice(urls) for _ in range(rng.randint(0, 6))]
        links += [f"/gone{i}", f"{rng.choice(urls)}#x", "mailto:x@a.org", u]
        pages.append(page(i, u + ("#f" if i % 7 == 0 else ""), *links, title=f"T{i}"))
    pages.append((900, "http://a.org/3", "<title>later copy</title>"))
    pages.append((901, "http://a.org/empty", ""))
    return pages


@pytest.mark.parametrize("depth", [0, 2, None])
def test_depths_are_shortest_distances(spark, depth):
    pages = web()[:-2]
    got = crawl.crawl_closure(spark.createDataFrame(pages, PAGE), ["http://a.org/0", "http://a.org/5"], depth)
    want = distances(pages, ["http://a.org/0", "http://a.org/5"])
    assert {r["url"]: r["depth"] for r in got.visited.collect()} == {u: d for u, d in want.items() if depth is None or d <= depth}


def test_crawl_keeps_to_the_first_seed_and_the_first_page_of_a_url(spark):
    seeds = ["http://a.org/0#s", "ftp://a.org/1", "http://b.org/0", "http://a.org/empty"]
    got = crawl.crawl_closure(spark.createDataFrame(web(), PAGE), seeds, None)
    assert all(r["url"].startswith("http://a.org/") for r in got.visited.collect())
    titles = {r["url"]: r["title"] for r in got.pages.collect()}
    assert titles["http://a.org/3"] == "T3" and "http://a.org/empty" not in titles
    assert {r["url"]: r["fetched"] for r in got.visited.collect()}["http://a.org/empty"] is False


def test_cap_takes_links_in_page_order(spark):
    rows = [page(1, "http://a.org/", "/x", "/y", "/z"), page(2, "http://a.org/x", "/y", "/p"), page(3, "http://a.org/y", "/q", "/r")]
    pages = spark.createDataFrame(rows, PAGE)

    def levels(cap):
        got = crawl.crawl_closure(pages, "http://a.org/", 2, max_links_per_depth=cap)
        return sorted((r["depth"], r["url"].rpartition("/")[2]) for r in got.visited.collect())

    assert levels(1) == [(0, ""), (1, "x"), (2, "y")]
    # y is found again while its own turn is still to come, and takes a place.
    assert levels(2) == [(0, ""), (1, "x"), (1, "y"), (2, "p")]
    assert levels(None) == [(0, ""), (1, "x"), (1, "y"), (1, "z"), (2, "p"), (2, "q"), (2, "r")]


def test_no_cap_equals_a_large_cap(spark):
    pages = spark.createDataFrame(web(), PAGE)
    runs = [crawl.crawl_closure(pages, "http://a.org/0", 3, max_links_per_depth=cap) for cap in (None, 10**6, 900)]
    visited = [sorted(tuple(r) for r in x.visited.select("url", "depth", "pos").collect()) for x in runs]
    stats = [sorted(tuple(r) for r in fr.crawl_stats(x.visited, x.frontier).collect()) for x in runs]
    assert visited[0] == visited[1] == visited[2] and stats[0] == stats[1] == stats[2]


def test_a_table_of_seeds_crawls_each_root(spark):
    rows = [page(1, "http://a.org/", "http://b.org/x", "/y"), page(2, "http://u@a.org:80/y"), page(3, "http://b.org/"), page(4, "http://b.org/x")]
    pages = spark.createDataFrame([(*r[:2], r[2].replace("/y", "http://u@a.org:80/y")) for r in rows], PAGE)
    seeds = spark.createDataFrame([("http://a.org/", 1), ("http://b.org/", 2)], "url string, pos long")
    got = crawl.crawl_closure(pages, seeds, None)
    assert {r["url"]: r["depth"] for r in got.visited.collect()} == {"http://a.org/": 0, "http://b.org/": 0, "http://u@a.org:80/y": 1}


def test_small_levels_leave_the_graph_in_place(spark):
    graph = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("url"), F.col("id").alias("key"), F.array().cast("array<string>").alias("links"))
    plan = fr.frontier_fetch(spark.createDataFrame([("u1", 0)], "url string, pos long"), graph)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_caps_are_ranked_in_blocks(spark, monkeypatch):
    pages = spark.createDataFrame(web(), PAGE)
    want = {r["url"] for r in crawl.crawl_closure(pages, "http://a.org/0", 2, max_links_per_depth=6).visited.collect()}
    monkeypatch.setattr(fr, "SMALL_CAP", 2)
    got = {r["url"] for r in crawl.crawl_closure(pages, "http://a.org/0", 2, max_links_per_depth=6).visited.collect()}
    assert got == want


def test_crawl_filters(spark):
    pages = spark.createDataFrame(
        [page(1, "http://a.org/", "/x", "/y"), page(2, "http://a.org/x"), page(3, "http://a.org/y")], PAGE
    )
    rules = spark.createDataFrame([("a.org", "User-agent: *\nDisallow: /x")], "host string, body string")

    def found(**how):
        return {r["url"] for r in crawl.crawl_closure(pages, "http://a.org/", **{"max_depth": 1, **how}).pages.collect()}

    assert found() == {"http://a.org/", "http://a.org/x", "http://a.org/y"}
    assert found(robots=rules, robots_mode="strict") == {"http://a.org/", "http://a.org/y"}
    assert len(found(robots=rules)) == 3 and len(found(robots=rules, robots_mode="strict", ignore_robots=True)) == 3
    assert found(robots_mode="block-on-error") == set()
    assert found(allowed_domains=["org"]) == found() and found(allowed_domains=["b.org"]) == set()
    assert found(allowed_domains=[]) == set()
    with pytest.raises(ValueError):
        crawl.crawl_closure(pages, "http://a.org/", -1)
    assert found(max_depth=9) == found()


def test_crawl_and_index_writes_documents(spark, tmp_path):
    url = "https://harbour.example/ferries"
    html = "<html><head><title>Ferries</title></head><body>Boats leave before noon.</body></html>"
    pages = spark.createDataFrame([(1, url, html)], PAGE)
    out = str(tmp_path / "job")
    found, ix = crawl.crawl_and_index(pages, url, out, max_depth=0, allowed_domains=[])
    assert [(r["url"], r["title"]) for r in found.collect()] == [(url, "Ferries")]
    doc = spark.read.json(f"{out}/docs").first()
    assert doc["url"] == url and doc["text"] == "Ferries Boats leave before noon."
    record = spark.read.json(f"{out}/tfidf_index").first()
    assert record["url"] == url and record["tfidf"]["noon"] == pytest.approx(0.2 * 0.693147, abs=1e-6)
    assert ix.n_docs == 1


def test_crawl_stats(spark):
    pages = spark.createDataFrame([page(1, "http://a.org/", "/x", "/gone"), page(2, "http://a.org/x", "/z")], PAGE)
    done = crawl.crawl_closure(pages, "http://a.org/", 2)
    rows = {r["depth"]: (r["processed"], r["next_links"]) for r in fr.crawl_stats(done.visited, done.frontier).collect()}
    assert rows == {0: (1, 2), 1: (1, 1), 2: (0, 0)}


def test_usable_pages(spark):
    rows = [(1, "x", 200, "text/html; charset=utf-8"), (2, "", 200, "text/html"), (3, "x", 404, "text/html"), (4, "x", 204, "image/png"), (5, None, 200, "text/html")]
    df = spark.createDataFrame(rows, "page_id long, html string, status int, content_type string")
    assert [r["page_id"] for r in read_pages(df).collect()] == [1]


ROBOTS = [
    ("open.org", "User-agent: *\nDisallow:"),
    ("closed.org", "User-agent: *\nDisallow: /"),
    ("own.org", "User-agent: Termlake\nDisallow: /\n\nUser-agent: *\nAllow: /"),
    ("all.org", "User-agent: termlake\nUser-agent: *\nUser-agent: mozilla\nDisallow: /a # c\nAllow: /"),
    ("order.org", "User-agent: *\nAllow: /a/b\nDisallow: /a\nUser-agent: *\nDisallow: /"),
    ("blank.org", "  \n "),
    ("null.org", None),
    ("norules.org", "Crawl-delay: abc\ncrawl-delay: 2.5 s\nCrawl-Delay: 9"),
]


def test_robots(spark):
    table = spark.createDataFrame(ROBOTS, "host string, body string")
    cases = {
        "http://open.org/x": True,
        "http://closed.org/x": False,
        "http://own.org/x": True,
        "http://all.org/a/1": False,
        "http://all.org/b": True,
        "http://order.org/a/b": True,
        "http://order.org/a/c": False,
        "http://order.org/z?q=1": True,
        "http://blank.org/": False,
        "http://null.org/": False,
        "http://norules.org/": True,
        "http://unknown.org/": False,
    }
    links = spark.createDataFrame([(u,) for u in cases], "url string")
    for mode in ("strict", "block-on-error"):
        got = {r["url"]: r["allowed"] for r in robots.robots_filter(links, table, mode).collect()}
        assert got == cases
    assert all(r["allowed"] for r in robots.robots_filter(links, table).collect())
    delays = {r["host"]: r["crawl_delay"] for r in robots.crawl_delay(table).collect()}
    assert delays["norules.org"] == 2.5 and delays["open.org"] is None and delays["null.org"] is None
    with pytest.raises(ValueError):
        robots.robots_filter(links, table, "sometimes")


def test_escapes_and_wildcards_in_robots_paths(spark):
    body = "User-agent: *\nDisallow: /a%20b\nDisallow: /*.pdf$\nDisallow: /x*y"
    table = spark.createDataFrame([("a.org", body)], "host string, body string")
    paths = ["/a b", "/a%20b/c", "/d.pdf", "/d.pdf?x", "/x12y3", "/*.pdf$", "/100%", "/a+b"]
    links = spark.createDataFrame([(f"http://a.org{p}",) for p in paths], "url string")

    def denied(**how):
        got = robots.robots_filter(links, table, "strict", **how).where("not allowed")
        return {r["url"].removeprefix("http://a.org") for r in got.collect()}

    assert denied() == {"/a b", "/a%20b/c", "/*.pdf$"}
    assert denied(wildcards=True) == {"/a b", "/a%20b/c", "/d.pdf", "/x12y3"}


def test_robots_bodies_need_an_order(spark):
    two = [("a.org", "User-agent: *\nDisallow: /", 1), ("a.org", "user-agent: *\nAllow: /", 2), ("b.org", None, 1)]
    table = spark.createDataFrame(two, "host string, body string, order int")
    links = spark.createDataFrame([("http://a.org/x",)], "url string")
    assert robots.robots_filter(links, table, "strict").first()["allowed"]
    with pytest.raises(Exception, match="several robots bodies"):
        robots.robots_filter(links, table.drop("order"), "strict").collect()


def test_robots_rules_rows(spark):
    table = spark.createDataFrame(ROBOTS[3:4], "host string, body string")
    rows = {(r["grp"], r["agent"], r["allow"], r["prefix"]) for r in robots.robots_rules(table).collect()}
    assert rows == {(1, a, ok, p) for a in ("termlake", "*", "mozilla") for ok, p in ((False, "/a"), (True, "/"))}


def test_two_requests_two_seconds_apart(spark):
    df = spark.createDataFrame([("example.org", 100.0), ("example.org", 101.0)], "host string, ts double")
    waits = sorted(r["wait_us"] for r in pacing.host_throttle(df, 2.0).collect())
    assert waits == [0, 1_000_000]


def test_pacing_equals_the_sequential_rule(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"h{rng.randint(0, 4)}", rng.randint(0, 900), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "host string, ts long, i long").withColumn("ts", F.timestamp_seconds("ts"))
    delays = spark.createDataFrame([("h1", 3.0), ("h2", 0.0), ("h3", None)], "host string, crawl_delay double")
    got = {r["i"]: r["wait_us"] for r in pacing.host_throttle(df, 1.0, tie_col="i", delays=delays).collect()}
    last = {}
    for host, ts, i in sorted(rows, key=lambda r: (r[1], r[2])):
        gap = 3.0 if host == "h1" else 1.0
        send = max(ts, last.get(host, -1e9) + gap)
        last[host] = send
        assert got[i] == round((send - ts) * 1e6), (host, ts, i)


def test_large_tables_are_not_broadcast(spark, monkeypatch):
    table = spark.createDataFrame(ROBOTS, "host string, body string")
    links = spark.createDataFrame([(f"http://{h}/a",) for h, _ in ROBOTS for _ in range(3)], "url string")
    pages = spark.createDataFrame(web(), PAGE)

    def run():
        allowed = sorted(map(tuple, robots.robots_filter(links, table, "strict").collect()))
        texts = sorted(map(tuple, crawl.crawl_closure(pages, "http://a.org/0", 2).pages.collect()))
        return allowed, texts

    want = run()
    for module in (robots, crawl, pacing):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df: df)
    assert run() == want
