"""One query per operator, over whole tables, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, line_chunks, mixing, ngram_join, quality_net, quality_rules, repeats, spotsigs, toxicity, warc, whitening, lemp, superminhash

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


MIX_SHARE, MIX_POWER, MIX_SEED = 0.5, 0.5, 7


@query
def op1_mixing(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"), MIX_SHARE, MIX_POWER, seed=MIX_SEED)
    return mixed.withColumns({c: F.round(c, 9) for c in ("weight", "probability")})


@query
def op2_toxicity(spark, sf):
    return toxicity.toxicity_table(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_bpe(spark, sf):
    return bpe.round_trip(table(spark, sf, "documents"), byte_bpe())


@query
def op4_quality_rules(spark, sf):
    return quality_rules.quality_table(table(spark, sf, "documents"))


@query
def op5_ngram_join(spark, sf):
    return ngram_join.near_duplicate_rows(table(spark, sf, "documents"))


@query
def op6_repeats(spark, sf):
    done = repeats.remove_repeats(table(spark, sf, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["begin"])
    return done.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_line_chunks(spark, sf):
    done = line_chunks.dedup_lines(table(spark, sf, "documents"))
    return done.select(
        "doc_id", F.col("_n_removed").alias("n_removed"), F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


@query
def op8_warc(spark, sf):
    members = warc.archive_pages(table(spark, sf, "pages"), min_bytes=0)
    return warc.read_archives(members, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "intact"
    )


@query
def op9_quality_net(spark, sf):
    return quality_net.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_spotsigs(spark, sf):
    prints = spotsigs.fingerprint_table(table(spark, sf, "documents"))
    return prints.withColumns({c: F.round(c, 9) for c in ("near_edited", "near_next")})


@query
def op11_lemp(spark, sf):
    return lemp.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=lemp.K)


@query
def op12_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"), k=whitening.COMPONENTS)


@query
def op13_superminhash(spark, sf):
    return superminhash.near_duplicates(table(spark, sf, "documents"))


# Base32 by hand: hex digits to bits, bits in fives to letters.
ORACLE["op8_warc"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, url, strlen(html) AS payload_bytes, sha1(html) AS hex,
         min(page_id) OVER (PARTITION BY sha1(html)) AS first_id
  FROM p),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    substr('0000000100100011010001010110011110001001101010111100110111101111',
           4 * (strpos('0123456789abcdef', substr(hex, i, 1)) - 1) + 1, 4)), '') AS bits
  FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
         + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
         + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to,
       url, true AS intact
FROM b"""


def _mixing_sql() -> str:
    """The rounds of raking and the halvings written out as one CTE each."""
    spaces = "translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')"
    parts = [
        f"""w AS (SELECT doc_id, source, lang, list_filter(string_split({spaces}, ' '), lambda x: x <> '') AS words FROM documents)""",
        f"""d AS (SELECT doc_id, source, lang, CAST(len(words) AS BIGINT) AS n_tokens,
          CAST(CAST('0x' || substr(md5(coalesce(list_max(list_transform(words, lambda x: struct_pack(n := length(x), w := x))).w, '')), 1, 8) AS BIGINT)
               % {mixing.TOPICS} AS INT) AS topic FROM w)""",
        "c0 AS (SELECT source, lang, topic, sum(n_tokens) AS mass, CAST(sum(n_tokens) AS DOUBLE) AS fit FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    for m in mixing.MARGINS:
        parts.append(
            f"g_{m} AS (SELECT {m}, pow(sum(mass), {MIX_POWER}) / sum(pow(sum(mass), {MIX_POWER})) OVER () * sum(sum(mass)) OVER () AS target FROM c0 GROUP BY {m})"
        )
    k = 0
    for _ in range(mixing.ROUNDS):
        for m in mixing.MARGINS:
            parts.append(
                f"c{k + 1} AS MATERIALIZED (SELECT c.* REPLACE (fit * target / sum(fit) OVER (PARTITION BY c.{m}) AS fit) FROM c{k} c JOIN g_{m} g ON c.{m} IS NOT DISTINCT FROM g.{m})"
            )
            k += 1
    parts.append(f"f AS MATERIALIZED (SELECT *, fit / mass AS weight FROM c{k})")
    parts.append(f"h0 AS (SELECT ln({MIX_SHARE} / max(weight)) - 1 AS low, ln(1 / min(weight)) AS high, {MIX_SHARE} * sum(mass) AS budget FROM f)")
    for i in range(mixing.CALIBRATION):
        kept = f"(SELECT sum(mass * least(1, weight * exp((low + high) / 2))) FROM f) <= budget"
        parts.append(
            f"h{i + 1} AS MATERIALIZED (SELECT CASE WHEN {kept} THEN (low + high) / 2 ELSE low END AS low, CASE WHEN {kept} THEN high ELSE (low + high) / 2 END AS high, budget FROM h{i})"
        )
    last = f"(SELECT exp((low + high) / 2) FROM h{mixing.CALIBRATION})"
    parts.append(f"p AS (SELECT source, lang, topic, weight, least(1, weight * {last}) AS probability FROM f)")
    draw = f"CAST('0x' || substr(md5('{MIX_SEED}:' || doc_id), 1, 12) AS BIGINT) / pow(2, 48)"
    return (
        "WITH "
        + ", ".join(parts)
        + f""" SELECT d.doc_id, d.source, d.lang, d.topic, n_tokens,
        round(CASE WHEN n_tokens = 0 THEN 0 ELSE coalesce(weight, 0) END, 9) AS weight,
        round(CASE WHEN n_tokens = 0 THEN 0 ELSE coalesce(probability, 0) END, 9) AS probability,
        {draw} < CASE WHEN n_tokens = 0 THEN 0 ELSE coalesce(probability, 0) END AS sampled
        FROM d LEFT JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic"""
    )


ORACLE["op1_mixing"] = _mixing_sql()


ORACLE["op7_line_chunks"] = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS n, len(ls) AS total FROM d),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM l),
r AS (
  SELECT *, n = total OR ((h * {line_chunks.FACTOR} + coalesce(lag(h) OVER w, 0)) >> 4) % {line_chunks.MEAN_LINES} = 0 AS closes
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
c AS (
  SELECT *, coalesce(sum(CAST(closes AS INT)) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM r),
k AS (SELECT doc_id, pos, count(*) AS lines, string_agg(line, chr(10) ORDER BY n) AS body FROM c GROUP BY ALL),
f AS (SELECT *, lines >= {line_chunks.LEAST_LINES} AND strlen(body) >= {line_chunks.LEAST_BYTES} AS worth FROM k),
m AS (SELECT *, worth AND row_number() OVER (PARTITION BY body, worth ORDER BY doc_id, pos) > 1 AS gone FROM f),
t AS (
  SELECT doc_id, CAST(sum(CAST(gone AS INT)) AS INT) AS n_removed,
         coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM m GROUP BY doc_id)
SELECT doc_id, n_removed, CAST(length(text) AS INT) AS n_chars, sha256(text) AS text_sha256 FROM t"""


def _spots_sql(name: str, source: str) -> str:
    """CTEs that end in ``{name}(doc_id, hashes)`` for ``source(doc_id, text)``."""
    anchors = ", ".join(f"'{a}'" for a in spotsigs.ANCHORS)
    chain = " || ' ' || ".join(f"content[a.at - k + {i}]" for i in range(1, spotsigs.CHAIN + 1))
    return f"""
    {name}_w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words FROM {source}),
    {name}_p AS (
      SELECT *, list_filter(words, lambda x: x NOT IN ({anchors})) AS content,
             list_filter(list_transform(words, lambda x, i: CASE WHEN x IN ({anchors}) THEN struct_pack(at := i - 1, word := x) END), lambda a: a IS NOT NULL) AS anchors
      FROM {name}_w),
    {name}_s AS (
      SELECT doc_id, text, words, list_distinct(list_filter(list_transform(anchors, lambda a, k1:
               CASE WHEN a.at - (k1 - 1) + {spotsigs.CHAIN} <= len(content) THEN a.word || ' ' || {chain.replace('- k', '- (k1 - 1)')} END), lambda s: s IS NOT NULL)) AS spots
      FROM {name}_p),
    {name} AS (
      SELECT doc_id, list_sort(list_distinct(list_transform(
        CASE WHEN text = '' THEN [] WHEN len(spots) >= {spotsigs.LEAST_SPOTS} THEN spots
             WHEN len(words) > 0 THEN list_concat(spots, words) ELSE [text] END,
        lambda s: substr(md5(s), 1, {spotsigs.HEX})))) AS hashes
      FROM {name}_s)"""


def _likeness_sql(a: str, b: str) -> str:
    return (
        f"round(CASE WHEN {a} = {b} THEN 1.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE "
        f"CAST(len(list_intersect({a}, {b})) AS DOUBLE) / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END, 9)"
    )


ORACLE["op10_spotsigs"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
e AS (
  SELECT doc_id, text, length(text) AS n, coalesce(lead(doc_id) OVER w, max(doc_id) OVER ()) AS next_id,
         coalesce(lead(text) OVER w, arg_max(text, doc_id) OVER ()) AS next_text
  FROM d WINDOW w AS (ORDER BY doc_id DESC)),
x AS (SELECT doc_id, next_id, n, left(text, n - n // 3) || left(next_text, n // 3) AS text FROM e),
{_spots_sql("own", "d")},
{_spots_sql("changed", "x")}
SELECT x.doc_id, x.n AS n_chars, sha256(x.text) AS edited_sha256,
       array_to_string(own.hashes, '') AS fingerprint, array_to_string(changed.hashes, '') AS edited_fingerprint,
       {_likeness_sql("own.hashes", "changed.hashes")} AS near_edited, {_likeness_sql("own.hashes", "after.hashes")} AS near_next
FROM x JOIN own USING (doc_id) JOIN changed USING (doc_id) JOIN own AS after ON after.doc_id = x.next_id"""


ORACLE["op11_lemp"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{lemp.UPPER}', '{lemp.LOWER}'), '{lemp.TERM}') AS ts
  FROM documents),
st AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS big_n, sum(len(ts)) AS big_l FROM d),
p AS (SELECT rid, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
df AS (SELECT term, count(DISTINCT rid) AS df FROM p GROUP BY term),
it AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (SELECT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''), '{lemp.UPPER}', '{lemp.LOWER}'), '{lemp.TERM}')) AS term FROM it),
qc AS (SELECT item_id, text, term, count(*) AS c FROM q GROUP BY ALL),
qw AS (SELECT item_id, text, term, c * CAST(floor(1000 * ln((2.0 * big_n + 2) / (2.0 * df + 1))) AS BIGINT) AS qv FROM qc JOIN df USING (term), st),
s AS (
  SELECT item_id, text, rid, doc_id,
         sum(qv * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS score
  FROM qw JOIN tf USING (term), st GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, CAST(doc_id AS BIGINT) AS doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {lemp.K}"""
