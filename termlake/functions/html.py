"""Text, title and links of HTML pages.

Two readers give the same fields. ``html`` (the default) runs the standard
library's parser over Arrow batches and copes with any markup. ``native`` uses
built-in expressions only; it is meant for ordinary markup, knows the entities
listed here, and leaves relative links other than ``/path``, ``//host`` and
``#fragment`` as they are written. On the pages measured so far the parser was
also the faster of the two, see the README.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import urls

KINDS = {"text": "string", "title": "string", "links": "array<string>"}
# Pages that the parser takes from a batch at a time.
SLICE_ROWS = 128

# What Python's \s matches, written as a Java character class.
WHITESPACE = r"[\s\x1c-\x1f\x{85}\p{Z}]"

# The entities decoded natively (the ampersand comes last).
ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": "\u00a0",
    "copy": "©",
    "middot": "·",
    "amp": "&",
}

DROPPED = (
    r"(?is)<!--.*?-->|<!doctype[^>]*>"
    r"|<script\b[^>]*>.*?</script\s*>"
    r"|<style\b[^>]*>.*?</style\s*>"
    r"|<noscript\b[^>]*>.*?</noscript\s*>"
)
TAG = r"</?[A-Za-z][^>]*>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
ANCHOR = r"(?is)<a\s[^>]*>"
HREF = r"(?is)[\s\"'/]href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def collapse_ws(text: Column) -> Column:
    """Whitespace runs become one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, WHITESPACE + "+", " "))


def decode_entities(text: Column) -> Column:
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return text


def drop_hidden(html: Column) -> Column:
    """HTML without comments, doctype, script, style and noscript elements."""
    return F.regexp_replace(html, DROPPED, " ")


def _text(shown: Column) -> Column:
    return collapse_ws(decode_entities(F.regexp_replace(shown, TAG, " ")))


def _title(shown: Column) -> Column:
    title = decode_entities(F.regexp_extract(shown, TITLE, 1))
    return F.regexp_replace(title, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def _hrefs(shown: Column) -> Column:
    tags = F.filter(
        F.regexp_extract_all(shown, F.lit(ANCHOR), F.lit(0)),
        lambda t: F.rlike(t, F.lit(r"(?is)[\s\"'/]href[\s=>/]")),
    )
    return F.transform(
        tags,
        lambda t: decode_entities(F.concat(*[F.regexp_extract(t, HREF, g) for g in (1, 2, 3)])),
    )


def _resolve(url: Column, hrefs: Column) -> Column:
    scheme = F.substring_index(url, ":", 1)
    root = F.concat(scheme, F.lit("://"), urls.netloc(url))
    return F.transform(
        hrefs,
        lambda h: F.when(h == "", url)
        .when(F.startswith(h, F.lit("#")), F.concat(urls.strip_fragment(url), h))
        .when(F.startswith(h, F.lit("//")), F.concat(scheme, F.lit(":"), h))
        .when(F.startswith(h, F.lit("/")), F.concat(root, h))
        .otherwise(h),
    )


class _PageReader(HTMLParser):
    """Collects the text nodes, first title and link targets of one page."""

    VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
    HIDDEN = frozenset(("script", "style", "noscript"))
    SPECIAL = frozenset(("template", "rt", "rp"))

    def __init__(self, url: str, links: bool = True, text: bool = True):
        super().__init__(convert_charrefs=True)
        self.url, self.open, self.nodes, self.links = url, [], [], []
        self.title, self.title_at, self.in_node = None, None, False
        self.with_links, self.with_text = links, text
        # How often each tag is open: markup that never closes its tags is read in linear time.
        self.count = Counter()
        self.hidden = self.special = 0

    def _enter(self, tag):
        self.open.append(tag)
        self.count[tag] += 1
        self.hidden += tag in self.HIDDEN
        self.special += tag in self.SPECIAL

    def _leave(self):
        tag = self.open.pop()
        self.count[tag] -= 1
        self.hidden -= tag in self.HIDDEN
        self.special -= tag in self.SPECIAL
        return tag

    def handle_starttag(self, tag, attrs):
        self.in_node = False
        if tag == "a" and not self.hidden and self.with_links:
            href = [v or "" for k, v in attrs if k == "href"]
            if href:
                # A target that cannot be resolved is left out, the page stays.
                try:
                    self.links.append(urljoin(self.url, href[-1]))
                except ValueError:
                    pass
        if tag == "title" and self.title is None and not self.hidden:
            self.title, self.title_at = [], len(self.open)
        if tag not in self.VOID:
            self._enter(tag)

    def handle_endtag(self, tag):
        self.in_node = False
        if self.count[tag]:
            while self._leave() != tag:
                pass
            if self.title_at is not None and len(self.open) <= self.title_at:
                self.title_at = None

    def handle_data(self, data):
        # Neighbouring pieces without markup between them are one text node.
        if self.hidden:
            return
        targets = [self.title] if self.title_at is not None else []
        if self.with_text and not self.special:
            targets.append(self.nodes)
        for nodes in targets:
            if self.in_node and nodes:
                nodes[-1] += data
            else:
                nodes.append(data)
        self.in_node = True

    def handle_comment(self, data):
        self.in_node = False

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.in_node = False
        if data.upper().startswith("CDATA["):
            self.handle_data(data[6:])
            self.in_node = False


def read_page(url: str, html: str, want: tuple[str, ...] = ("text", "title", "links")) -> tuple:
    """The wanted fields of one page by the standard library's parser."""
    reader = _PageReader(url, "links" in want, "text" in want)
    reader.feed(html)
    reader.close()
    fields = {
        "text": lambda: " ".join(" ".join(reader.nodes).split()),
        "title": lambda: "".join(node.strip() for node in reader.title or []),
        "links": lambda: reader.links,
    }
    return tuple(fields[w]() for w in want)


def parse_pages(url: Column, html: Column, want: tuple[str, ...] = ("text", "title", "links")) -> Column:
    """Struct of the wanted fields by the parser; null HTML gives nulls."""

    def batch(url: pd.Series, html: pd.Series) -> pd.DataFrame:
        rows = [(None,) * len(want) if h is None else read_page(u or "", h, want) for u, h in zip(url, html)]
        return pd.DataFrame(rows, columns=list(want))

    return F.pandas_udf(batch, f"struct<{','.join(f'{w}:{KINDS[w]}' for w in want)}>")(url, html)


def _parse_batches(n_kept: int, names: list[str], want: tuple[str, ...]):
    """Pages ``(*kept, url, html)`` to ``(*kept, *want)``, a few at a time: what a worker
    holds beside Spark's batch doesn't grow with the batch."""
    kinds = [pa.list_(pa.string()) if w == "links" else pa.string() for w in want]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                pages = zip(part.column(n_kept).to_pylist(), part.column(n_kept + 1).to_pylist())
                rows = [(None,) * len(want) if h is None else read_page(u or "", h, want) for u, h in pages]
                read = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(part.columns[:n_kept] + read, names=names)

    return run


# Executors need not have this package installed: ship the reader with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def extract(
    pages: DataFrame,
    want: tuple[str, ...] = ("text", "title", "links"),
    url_col: str = "url",
    html_col: str = "html",
    parser: str = "html",
) -> DataFrame:
    """Add the wanted ones of ``text``, ``title`` and ``links``; drops the HTML."""
    if parser not in ("html", "native"):
        raise ValueError(f"unknown parser {parser!r}")
    if unknown := set(want) - {"text", "title", "links"}:
        raise ValueError(f"unknown fields {sorted(unknown)}")
    url, html = F.col(url_col), F.col(html_col)
    kept = [c for c in pages.columns if c != html_col]
    if parser == "html":
        fields = [T.StructField(c, pages.schema[c].dataType) for c in kept]
        fields += [T.StructField(w, T._parse_datatype_string(KINDS[w])) for w in want]
        whole = pages.select(*kept, url.alias("_url"), html.alias("_html"))
        return whole.mapInArrow(_parse_batches(len(kept), kept + list(want), tuple(want)), T.StructType(fields))
    # A projection of its own: each field below reads the cleaned page.
    shown = pages.withColumn("_shown", drop_hidden(html))
    native = {
        "text": lambda: _text(F.col("_shown")),
        "title": lambda: _title(F.col("_shown")),
        "links": lambda: _resolve(url, _hrefs(F.col("_shown"))),
    }
    return shown.select(*kept, *[native[w]().alias(w) for w in want])
