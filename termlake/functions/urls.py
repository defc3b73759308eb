"""URL columns. All of them are built-in expressions, so filters on them stay
next to the scan and below any Python step."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"

# Fixed value: the URL namespace of RFC 4122.
UUID_NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def strip_fragment(url: Column) -> Column:
    """The URL up to its first ``#``."""
    return F.substring_index(url, "#", 1)


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _NETLOC, 1)


def host(url: Column) -> Column:
    """Lower-cased host, port kept."""
    return F.lower(netloc(url))


def host_root(url: Column, strip_port: bool = True) -> Column:
    """Key that keeps a crawl on one host: the host without user info and, by
    default, without the port. No public-suffix list is used."""
    root = F.regexp_replace(netloc(url), r"^.*@", "")
    return F.regexp_replace(root, r":\d*$", "") if strip_port else root


def plain_root(url: str, strip_port: bool = True) -> str:
    """:func:`host_root` of a string."""
    found = re.match(_NETLOC, url)
    root = found.group(1).rpartition("@")[2] if found else ""
    return re.sub(r":\d*$", "", root) if strip_port else root


def path(url: Column) -> Column:
    """Path (``/`` when empty, parameters of the last segment dropped) and query."""
    bare = F.regexp_replace(F.regexp_extract(url, _PATH, 1), r";[^/]*$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return F.concat(
        F.when(bare == "", F.lit("/")).otherwise(bare),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )


def doc_id(url: Column) -> Column:
    """UUID version 5 of the URL."""
    digest = F.sha1(F.concat(F.unhex(F.lit(UUID_NAMESPACE_URL)), F.encode(url, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def is_http(url: Column) -> Column:
    return F.coalesce(F.startswith(url, F.lit("http")), F.lit(False))


def in_domains(url: Column, domains: Iterable[str] | None) -> Column:
    """True where the host is one of ``domains`` or lies below one; None allows all."""
    if domains is None:
        return F.lit(True)
    names = sorted(set(domains))
    if not names:
        return F.lit(False)
    h = host(url)
    if len(names) <= 16:
        hit = F.lit(False)
        for name in names:
            hit = hit | (h == name) | F.endswith(h, F.lit("." + name))
        return hit
    labels = F.split(h, r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return F.exists(tails, lambda t: t.isin(names))


def same_root(url: Column, root: str | Column, strip_port: bool = True) -> Column:
    """True where the URL has the given host root; an unreadable URL counts as equal."""
    return F.coalesce(host_root(url, strip_port) == root, F.lit(True))
