"""Robots files as a table ``(host, body)``.

Rules match by prefix after percent escapes are read, or by wildcards on demand;
the first matching rule in file order decides, and a group is chosen as the first
one naming the agent, else the first one for ``*``.

A robots file sits in one row, so it is read inside that row; only a host with
several rows needs a shuffle, of one body per host and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.numbers import to_float
from ..functions.tokens import bind
from ..session import broadcast_if_small

# The names of the modes.
MODES = ("allow-on-error", "block-on-error", "strict")
DEFAULT_AGENT = "termlake/0.1"
# Agents tried after the crawler's own.
FALLBACK_AGENTS = ("*", "Mozilla/5.0")
_NEWLINE = r"\r\n|\r|\n"


def one_per_host(robots: DataFrame) -> DataFrame:
    """One body for each host.

    Of several the last one by the column ``order`` counts, as a later fetch
    replaces an earlier one; without that column different bodies for a host are
    an error, as nothing says which holds.
    """
    if "order" in robots.columns:
        return robots.groupBy("host").agg(F.max_by("body", F.struct("order", "body")).alias("body"))
    different = F.count_if(F.col("body").isNull()) > 0, F.min("body") != F.max("body")
    clash = F.coalesce(different[1], F.lit(False)) | (different[0] & F.min("body").isNotNull())
    message = F.concat(F.lit("several robots bodies and no order for "), F.first("host"))
    return robots.groupBy("host").agg(F.when(clash, F.raise_error(message)).otherwise(F.max("body")).alias("body"))


def _lines(body: Column) -> Column:
    """``array<struct<key, value, pos>>`` of the lines that have a colon."""
    lines = F.transform(
        F.split(F.coalesce(body, F.lit("")), _NEWLINE),
        lambda line, i: F.struct(line.alias("line"), i.alias("pos")),
    )
    return F.transform(
        F.filter(lines, lambda x: F.contains(x["line"], F.lit(":"))),
        lambda x: F.struct(
            F.lower(F.trim(F.regexp_extract(x["line"], r"^\s*([^:]*?)\s*:", 1))).alias("key"),
            F.regexp_extract(x["line"], r"^[^:]*:(.*)$", 1).alias("value"),
            x["pos"].alias("pos"),
        ),
    )


def crawl_delay(robots: DataFrame) -> DataFrame:
    """``(host, crawl_delay)``: first numeric value, whatever the agent; else null."""
    values = F.transform(
        F.filter(_lines(F.col("body")), lambda x: x["key"] == "crawl-delay"),
        lambda x: to_float(F.regexp_extract(x["value"], r"^\s*(\S+)", 1)),
    )
    first = F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))
    return one_per_host(robots).select("host", first.alias("crawl_delay"))


def _parsed(body: Column) -> Column:
    """``struct<agents array<(grp, agent)>, rules array<(grp, allow, prefix, pos)>>``."""

    def directives(lines: Column) -> Column:
        clean = F.transform(
            lines,
            lambda x: F.struct(
                x["key"].alias("key"),
                F.trim(F.regexp_replace(x["value"], r"#.*$|[\t\r]", "")).alias("value"),
                x["pos"].alias("pos"),
            ),
        )
        return F.filter(clean, lambda x: x["key"].isin("user-agent", "allow", "disallow"))

    def grouped(d: Column) -> Column:
        # A group starts at an agent line that does not follow another one.
        starts = F.filter(
            F.transform(
                d,
                lambda x, i: F.when(
                    (x["key"] == "user-agent")
                    & ((i == 0) | (F.coalesce(F.get(d, i - 1)["key"], F.lit("")) != "user-agent")),
                    x["pos"],
                ),
            ),
            lambda p: p.isNotNull(),
        )
        return bind(
            starts,
            lambda s: F.transform(
                d,
                lambda x: F.struct(
                    F.size(F.filter(s, lambda p: p <= x["pos"])).alias("grp"),
                    x["key"].alias("key"),
                    x["value"].alias("value"),
                    x["pos"].alias("pos"),
                ),
            ),
        )

    def split(g: Column) -> Column:
        agents = F.transform(
            F.filter(g, lambda x: x["key"] == "user-agent"),
            lambda x: F.struct(x["grp"].alias("grp"), F.lower(x["value"]).alias("agent")),
        )
        # An empty Disallow allows everything.
        rules = F.transform(
            F.filter(g, lambda x: (x["key"] != "user-agent") & (x["grp"] > 0)),
            lambda x: F.struct(
                x["grp"].alias("grp"),
                ((x["key"] == "allow") | (x["value"] == "")).alias("allow"),
                x["value"].alias("prefix"),
                x["pos"].alias("pos"),
            ),
        )
        return F.struct(agents.alias("agents"), rules.alias("rules"))

    return bind(_lines(body), lambda raw: bind(directives(raw), lambda d: bind(grouped(d), split)))


def unescaped(path: Column) -> Column:
    """A path with its percent escapes read, so ``/a%20b`` equals ``/a b``; malformed ones stay."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def as_pattern(prefix: Column) -> Column:
    """Rule path with ``*`` and a last ``$`` as a regular expression."""
    bare = F.regexp_replace(prefix, r"\$$", "")
    pieces = F.replace(bare, F.lit("*"), F.lit(r"\E.*\Q"))
    end = F.when(F.endswith(prefix, F.lit("$")), F.lit("$")).otherwise(F.lit(""))
    return F.concat(F.lit(r"(?s)^\Q"), pieces, F.lit(r"\E"), end)


def robots_rules(robots: DataFrame) -> DataFrame:
    """``(host, grp, agent, allow, prefix, pos)``, one row per agent and rule of a group."""
    parsed = one_per_host(robots).select("host", _parsed(F.col("body")).alias("p"))
    rules = parsed.select("host", F.col("p.agents").alias("agents"), F.explode_outer("p.rules").alias("r")).where(F.col("r").isNotNull())
    own = F.filter("agents", lambda a: a["grp"] == F.col("r.grp"))
    named = rules.select("host", F.explode(own).alias("a"), "r")
    return named.select(
        "host", F.col("r.grp").alias("grp"), F.col("a.agent").alias("agent"),
        F.col("r.allow").alias("allow"), F.col("r.prefix").alias("prefix"), F.col("r.pos").alias("pos"),
    )


def compile_rules(robots: DataFrame, agent: str = DEFAULT_AGENT) -> DataFrame:
    """``(host, readable, rule_sets)``: per tried agent the rules of its group."""
    parsed = one_per_host(robots).select("host", "body", _parsed(F.col("body")).alias("p"))

    def rules_for(name: str) -> Column:
        token = name.split("/")[0].lower()
        agents = F.col("p.agents")
        own = F.filter(
            agents, lambda a: (a["agent"] != "*") & (a["agent"] != "") & F.contains(F.lit(token), a["agent"])
        )
        default = F.filter(agents, lambda a: a["agent"] == "*")
        grp = F.coalesce(
            F.array_min(F.transform(own, lambda a: a["grp"])),
            F.array_min(F.transform(default, lambda a: a["grp"])),
        )
        # No group: null, which filters every rule out and so allows.
        return bind(grp, lambda g: F.filter(F.col("p.rules"), lambda r: r["grp"] == g))

    readable = F.coalesce(F.trim(F.regexp_replace("body", r"\s+", " ")) != "", F.lit(False))
    sets = F.array(*[rules_for(name) for name in (agent, *FALLBACK_AGENTS)])
    return parsed.select("host", readable.alias("readable"), sets.alias("rule_sets"))


def robots_filter(
    links: DataFrame,
    robots: DataFrame | None,
    mode: str = "allow-on-error",
    agent: str = DEFAULT_AGENT,
    url_col: str = "url",
    compiled: DataFrame | None = None,
    wildcards: bool = False,
) -> DataFrame:
    """Adds ``allowed``. ``wildcards``: in rule paths ``*`` stands for anything and a last ``$`` for the end. ``compiled``: the rules by :func:`compile_rules`, if at hand. In ``allow-on-error`` nothing is ever denied, so that
    mode reads no rules; the two others are equal."""
    if mode not in MODES:
        raise ValueError(f"unknown robots mode {mode!r}; one of {', '.join(MODES)}")
    if mode == "allow-on-error":
        return links.withColumn("allowed", F.lit(True))
    if robots is None:
        return links.withColumn("allowed", F.lit(False))
    # One row per host joins each URL once; adaptive execution splits hot hosts
    # when the table is too large to broadcast.
    rules = compile_rules(robots, agent) if compiled is None else compiled
    rules = rules.withColumnRenamed("host", "_host")
    joined = links.withColumn("_host", urls.netloc(F.col(url_col))).join(broadcast_if_small(rules), "_host", "left")
    joined = joined.withColumn("_path", unescaped(urls.path(F.col(url_col))))
    path = F.col("_path")

    def permits(rules: Column) -> Column:
        if wildcards:
            match = F.filter(rules, lambda r: F.rlike(path, as_pattern(unescaped(r["prefix"]))))
        else:
            match = F.filter(rules, lambda r: F.startswith(path, unescaped(r["prefix"])))
        return F.coalesce(F.get(match, F.lit(0))["allow"], F.lit(True))

    allowed = F.coalesce(F.col("readable") & F.exists("rule_sets", permits), F.lit(False))
    return joined.withColumn("allowed", allowed).select(*links.columns, "allowed")
