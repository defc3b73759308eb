import random
import re
import uuid
from collections import Counter
from urllib.parse import urlparse

from pyspark.sql import functions as F

from termlake.functions import html, scores, urls
from termlake.functions import tokens as tk
from termlake.functions.numbers import to_float

URLS = [
    "https://harbour.example/ferries",
    "http://EN.Example.org:8080/a/b;p=1/c;q?x=1&y=2#frag",
    "https://example.org",
    "https://example.org?q=1",
    "https://example.org/ä b|c?#",
    "http://notexample.org/x#a#b",
    "ftp://sub.example.org/x",
]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_url_columns(spark):
    def path(u):
        p = urlparse(u)
        return (p.path or "/") + ("?" + p.query if p.query else "")

    assert column(spark, URLS, urls.strip_fragment) == [u.split("#", 1)[0] for u in URLS]
    assert column(spark, URLS, urls.host) == [urlparse(u).netloc.lower() for u in URLS]
    hosts = ["harbour.example", "EN.Example.org", "example.org", "example.org", "example.org", "notexample.org", "sub.example.org"]
    assert column(spark, URLS, urls.host_root) == hosts
    odd = ["http://me:pw@a.org:80/x", "http://a.org:/", "no url"]
    assert column(spark, odd, urls.host_root) == [urls.plain_root(u) for u in odd] == ["a.org", "a.org", ""]
    assert column(spark, URLS, urls.path) == [path(u) for u in URLS]
    assert column(spark, URLS, urls.doc_id) == [str(uuid.uuid5(uuid.NAMESPACE_URL, u)) for u in URLS]
    assert column(spark, URLS, urls.is_http) == [u.startswith("http") for u in URLS]
    assert column(spark, URLS[1:2], lambda c: urls.host_root(c, strip_port=False)) == ["EN.Example.org:8080"]


def test_known_page_id(spark):
    assert column(spark, URLS[:1], urls.doc_id) == ["18eb4376-04cf-524b-a238-537a97e795fc"]


def test_domains(spark):
    want = [False, False, True, True, True, False, True]
    for names in (["example.org"], ["example.org"] + [f"d{i}.net" for i in range(30)]):
        assert column(spark, URLS, lambda c: urls.in_domains(c, names)) == want
    assert column(spark, URLS, lambda c: urls.in_domains(c, None)) == [True] * len(URLS)
    assert column(spark, URLS, lambda c: urls.in_domains(c, [])) == [False] * len(URLS)


def test_same_root_counts_unreadable_as_equal(spark):
    assert column(spark, ["https://a.org/x", "https://b.org/x", None], lambda c: urls.same_root(c, "a.org")) == [
        True,
        False,
        True,
    ]


TEXTS = ["Can't stop, won't_stop 42x7!", None, "", "Łódź İstanbul ①② é a b", "ΑΒΓ abc-ABC", "  '' _ "]


def test_tokenizers(spark):
    def words(t):
        return [x.lower() for x in re.split(r"[^\w']+", t or "") if x]

    assert column(spark, TEXTS, tk.lex_alpha) == [re.findall("[a-z]+", (t or "").lower()) for t in TEXTS]
    assert column(spark, TEXTS, tk.lex_alnum) == [re.findall("[a-z0-9]+", (t or "").lower()) for t in TEXTS]
    assert column(spark, TEXTS, tk.tokenize_word) == [words(t) for t in TEXTS]


def test_count_tokens_matches_counter(spark):
    rng = random.Random(7)
    rows = [[rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(n)] for n in (0, 1, 2, 50, 700)]
    got = column(spark, rows, tk.count_tokens, "array<string>")
    for tokens, counts in zip(rows, got):
        assert {c["term"]: c["cnt"] for c in counts} == dict(Counter(tokens))


def test_collapse_ws_is_python_whitespace(spark):
    odd = ["a \t\x0b\x1c\x1f\x85\xa0    　 b", "​x᠎", "  "]
    assert column(spark, odd, html.collapse_ws) == [re.sub(r"\s+", " ", x).strip() for x in odd]


def test_to_float_is_pythons_float(spark):
    texts = ["1", " 2.5 ", "-3e2", ".5", "5.", "1d", "1f", "0x10", "", "abc", "inf", "1e", None]
    want = [1.0, 2.5, -300.0, 0.5, 5.0, None, None, None, None, None, float("inf"), None, None]
    assert column(spark, texts, to_float) == want


PAGE = (
    "<!DOCTYPE html><html><head><title> A &amp;\n B </title><style>p{}</style>"
    "<script>var a='<a href=\"/no\">';</script></head><body><noscript><a href='/no'>n</noscript>"
    "<!-- <a href='/no'> --><p>One<b>two</b>&copy; x</p>"
    "<a href='/p?a=1&amp;b=2'>l</a> <a name=q>no</a><a href=#f>f</a><a href=//h.org/z>h</a></body></html>"
)


def test_both_readers_agree_on_ordinary_markup(spark):
    pages = spark.createDataFrame([("http://x.org/d/e#q", PAGE)], "url string, html string")
    for parser in ("html", "native"):
        row = html.extract(pages, parser=parser).first()
        assert row["text"] == "A & B One two © x l no f h", parser
        assert row["title"] == "A &\n B", parser
        assert row["links"] == ["http://x.org/p?a=1&b=2", "http://x.org/d/e#f", "http://h.org/z"], parser


def test_parser_copes_with_odd_markup():
    text, title, links = html.read_page(
        "http://x.org/a/b",
        "<title>T<b>u </b></title>a < b &#233;&eacute;<a title='>' href='../c'>l</a><a href>e</a><p>A&am",
    )
    assert (text, title) == ("T u a < b éé l e A&am", "Tu")
    assert links == ["http://x.org/c", "http://x.org/a/b"]


def test_cosine_guards_zero_norms(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0), (1.0, 2.0, 0.5)], "d double, a double, b double")
    assert [r[0] for r in df.select(scores.cosine(F.col("d"), F.col("a"), F.col("b"))).collect()] == [0.0, 1.0]


def test_reader_travels_without_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = tmp_path / "reader.pkl"
    blob.write_bytes(cloudpickle.dumps(html.read_page))
    code = (
        "import pickle; f = pickle.load(open('reader.pkl', 'rb'));"
        "print(f('http://x.org/', '<title>t</title><a href=y>z</a>'))"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert out.stdout.strip().endswith("('t z', 't', ['http://x.org/y'])"), out.stderr


def test_unclosed_tags_take_linear_time():
    import time

    def seconds(n):
        begun = time.perf_counter()
        text, _, _ = html.read_page("http://a.org/", "<p>x" * n)
        assert len(text) == 2 * n - 1
        return time.perf_counter() - begun

    seconds(1_000)
    assert seconds(32_000) < 40 * max(seconds(2_000), 0.005)


def test_only_wanted_fields_are_read(spark):
    pages = spark.createDataFrame([("http://a.org/", "<title>T</title><a href='/x'>y</a>"), ("u", None)], "url string, html string")
    rows = html.extract(pages, want=("title",)).collect()
    assert [(r["url"], r["title"]) for r in rows] == [("http://a.org/", "T"), ("u", None)]
    assert html.read_page("http://a.org/", "<a href='/x'>y</a>", ("links", "text")) == (["http://a.org/x"], "y")


def test_pages_are_parsed_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(html, "SLICE_ROWS", 7)
    rows = [(i, f"https://a.org/{i}", None if i % 5 == 0 else f'<title>t{i}</title><a href="/{i}">x{i}</a>') for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    sizes = [b.num_rows for b in html._parse_batches(1, ["page_id", "text"], ("text",))(iter([pages.toArrow().to_batches()[0]]))]
    assert sizes == [7, 7, 7, 7, 2]
    got = {r["page_id"]: (r["title"], r["text"], r["links"]) for r in html.extract(pages).collect()}
    assert got[1] == ("t1", "t1 x1", ["https://a.org/1"]) and got[5] == (None, None, None) and len(got) == 30
