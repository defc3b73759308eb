"""SQL for DuckDB that gives the same rows as the registered queries."""

from __future__ import annotations

from .queries import DOMAINS, INTERVAL_SECONDS, LEMMAS, LINK_CAP, STOPWORDS, TOP_K

UUID_NS = "6ba7b8119dad11d180b400c04fd430c8"


def _uuid(url: str) -> str:
    h = f"sha1(unhex('{UUID_NS}') || encode({url}))"
    return (
        f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), '5' || substr({h}, 14, 3), "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3), "
        f"substr({h}, 21, 12))"
    )


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


STOP = f"stop(term) AS (VALUES {_values([(w,) for w in STOPWORDS])})"
LEM = f"lem(token, lemma) AS (VALUES {_values(LEMMAS)})"

# Pages

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
HIDDEN = (
    r"<!--.*?-->|<!doctype[^>]*>|<script\b[^>]*>.*?</script\s*>"
    r"|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>"
)


def _entities(x: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        x = f"replace({x}, '{name}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'), ' ')"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


SHOWN = f"shown AS (SELECT page_id, url, regexp_replace(html, '{HIDDEN}', ' ', 'gis') AS h FROM pages WHERE html <> '')"
TEXT = _collapse(_entities("regexp_replace(h, '</?[A-Za-z][^>]*>', ' ', 'g')"))
TITLE = _strip(_entities(r"regexp_extract(h, '<title\b[^>]*>(.*?)</title\s*>', 1, 'is')"))
NETLOC = "regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
SCHEME = "regexp_extract({}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
PATH = (
    "(CASE WHEN regexp_extract({0}, '^[a-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' "
    "ELSE regexp_extract({0}, '^[a-z]+://[^/?#]*([^?#]*)', 1) END "
    r"|| regexp_extract({0}, '^[^?#]*(\?[^#]+)', 1))"
)
STRIP = "split_part({}, '#', 1)"

# Own links of a page: (page_id, pos, href) with pos from 0.
HREFS = (
    "anchors AS (SELECT page_id, url, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS href FROM "
    "(SELECT page_id, url, regexp_extract_all(h, '<a\\s[^>]*href=\"([^\"]*)\"', 1, 'is') AS l FROM shown)), "
    "own AS (SELECT page_id, pos, "
    f"{SCHEME.format('url')} || '://' || {NETLOC.format('url')} || {_entities('href')} AS link FROM anchors)"
)

# Documents

TOK = "tok AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents)"
TC = "tc AS (SELECT id, term, count(*) AS cnt FROM tok GROUP BY id, term)"


def _weights(counts: str = "tc", n: str = "(SELECT count(*) FROM documents)") -> str:
    return (
        f"tot AS (SELECT id, sum(cnt)::BIGINT AS total FROM {counts} GROUP BY id), "
        f"vocab AS (SELECT term, count(*) AS df FROM {counts} GROUP BY term), "
        f"wt AS (SELECT c.id, c.term, c.cnt, t.total, v.df, {n} AS n, "
        f"c.cnt / t.total AS tf, ln(1.0 + {n} / v.df) AS idf, c.cnt / t.total * ln(1.0 + {n} / v.df) AS w "
        f"FROM {counts} c JOIN tot t USING (id) JOIN vocab v USING (term))"
    )


DOC = f"{TOK}, {TC}, {_weights()}"
NORMS = "norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM wt GROUP BY id)"
WORDS = r"[t FOR t IN regexp_split_to_array(text, '[^\p{L}\p{N}_'']+') IF t <> '']"
QTOK = f"qtok AS (SELECT item_id AS qid, lower(unnest({WORDS})) AS term FROM benchmark)"
QVEC = (
    f"{QTOK}, qc AS (SELECT qid, term, count(*) AS c FROM qtok GROUP BY qid, term), "
    "qt AS (SELECT qid, sum(c)::BIGINT AS total FROM qc GROUP BY qid), "
    "qv AS (SELECT qid, term, c / total AS qw FROM qc JOIN qt USING (qid)), "
    "qn AS (SELECT qid, sqrt(sum(qw * qw)) AS qnorm FROM qv GROUP BY qid)"
)
DOTS = (
    "dots AS (SELECT qid, id, sum(w * qw) AS dot, count(*) AS n_overlap FROM wt JOIN qv USING (term) GROUP BY qid, id)"
)
SCORED = (
    f"{NORMS}, {DOTS}, sc AS (SELECT qid, id, n_overlap, dot, CASE WHEN norm > 0 AND qnorm > 0 "
    "THEN dot / (norm * qnorm) ELSE 0.0 END AS score FROM dots JOIN norms USING (id) JOIN qn USING (qid))"
)
RANKED = (
    "hits AS (SELECT qid, id, s AS score, row_number() OVER (PARTITION BY qid ORDER BY s DESC, id) AS rank "
    "FROM (SELECT qid, id, round(score, 6) AS s FROM sc WHERE score > 0))"
)
PAGE_DOC = (
    f"{SHOWN}, pd AS (SELECT {_uuid('url')} AS id, url, {TITLE} AS title, {TEXT} AS text FROM shown), "
    f"tok AS (SELECT id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM pd), {TC}, "
    f"{_weights(n='(SELECT count(*) FROM pd)')}"
)

# Normalized terms of one document set
NORMAL = (
    "kept AS (SELECT id, term FROM tok WHERE length(term) >= 2 AND term NOT IN (SELECT term FROM stop)), "
    "nc AS (SELECT id, coalesce(l.lemma, k.term) AS term, count(*) AS cnt FROM kept k "
    "LEFT JOIN lem l ON l.token = k.term GROUP BY 1, 2)"
)

# Robots

ROBOTS = (
    f"hosts AS (SELECT {NETLOC.format('url')} AS host, count(*) AS n, min({PATH.format('url')}) AS first_path "
    "FROM pages GROUP BY 1), robots AS (SELECT host, CASE (length(host) + n) % 6 "
    "WHEN 0 THEN E'# rules\\nUser-agent: *\\nDisallow: /de\\nAllow: /\\nCrawl-delay: abc\\nCrawl-delay: ' || n || '.5' "
    "WHEN 1 THEN E'User-agent: *\\nDisallow: /' "
    "WHEN 2 THEN E'User-agent: termlake\\nDisallow: /\\n\\nUser-agent: *\\nDisallow:' "
    "WHEN 3 THEN '   ' WHEN 4 THEN NULL "
    "ELSE E'User-agent: alpha\\nUser-agent: *\\nAllow: ' || first_path || "
    "E'\\nDisallow: /en # english\\nDisallow: /fr\\ncrawl-delay: 2 s' END AS body FROM hosts)"
)
LINES = (
    f"{ROBOTS}, raw AS (SELECT host, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM "
    "(SELECT host, string_split(body, E'\\n') AS l FROM robots)), "
    "kv AS (SELECT host, pos, lower(trim(split_part(line, ':', 1))) AS key, "
    "substr(line, strpos(line, ':') + 1) AS rawv FROM raw WHERE strpos(line, ':') > 0)"
)
RULES = (
    f"{LINES}, dir AS (SELECT host, pos, key, trim(regexp_replace(rawv, '#.*$', '')) AS value FROM kv "
    "WHERE key IN ('user-agent', 'allow', 'disallow')), "
    "st AS (SELECT *, CASE WHEN key = 'user-agent' AND coalesce(lag(key) OVER (PARTITION BY host ORDER BY pos), '') "
    "<> 'user-agent' THEN 1 ELSE 0 END AS s FROM dir), "
    "g AS (SELECT *, (sum(s) OVER (PARTITION BY host ORDER BY pos))::INTEGER AS grp FROM st), "
    "agents AS (SELECT host, grp, lower(value) AS agent FROM g WHERE key = 'user-agent'), "
    "rules AS (SELECT host, grp, (key = 'allow' OR value = '') AS allow, value AS prefix, pos FROM g "
    "WHERE key <> 'user-agent' AND grp > 0)"
)
ROBOTS_FILTER = f"""WITH {RULES},
ua(name) AS (VALUES ('termlake'), ('*'), ('mozilla')),
grp_for AS (SELECT r.host, u.name, coalesce(
    (SELECT min(grp) FROM agents a WHERE a.host = r.host AND a.agent NOT IN ('*', '') AND contains(u.name, a.agent)),
    (SELECT min(grp) FROM agents a WHERE a.host = r.host AND a.agent = '*')) AS grp FROM robots r, ua u),
u AS (SELECT page_id, url, {NETLOC.format('url')} AS host, {PATH.format('url')} AS path FROM pages),
m AS (SELECT u.page_id, f.name, arg_min(r.allow, r.pos) AS allow FROM u JOIN grp_for f USING (host)
    LEFT JOIN rules r ON r.host = f.host AND r.grp = f.grp AND starts_with(u.path, r.prefix) GROUP BY 1, 2)
SELECT u.page_id, u.url, (coalesce(trim(rb.body), '') <> '' AND (SELECT bool_or(coalesce(m.allow, true)) FROM m
    WHERE m.page_id = u.page_id)) AS allowed FROM u JOIN robots rb USING (host)"""

# Crawling: all links of the linked pages as (page_id, src, pos, dst)

LINKED = (
    f"{SHOWN}, {HREFS}, places AS (SELECT page_id, url, {NETLOC.format('url')} AS host, "
    f"row_number() OVER (PARTITION BY {NETLOC.format('url')} ORDER BY page_id) AS place FROM pages), "
    "nexts AS (SELECT a.page_id, b.place - a.place * 3 + 1 AS pos, b.url AS link FROM places a JOIN places b "
    "ON a.host = b.host AND b.place BETWEEN a.place * 3 - 1 AND a.place * 3 + 1), "
    "nn AS (SELECT page_id, count(*) AS k FROM nexts GROUP BY 1), "
    "every AS (SELECT page_id, pos, link FROM nexts UNION ALL "
    "SELECT o.page_id, o.pos + coalesce(nn.k, 0), o.link FROM own o LEFT JOIN nn USING (page_id)), "
    f"std AS (SELECT {STRIP.format('url')} AS url, min(page_id) AS page_id FROM pages GROUP BY 1), "
    f"per_page AS (SELECT e.page_id, min(e.pos) AS first_at, {STRIP.format('e.link')} AS dst FROM every e "
    "JOIN std s USING (page_id) WHERE starts_with(e.link, 'http') GROUP BY 1, 3), "
    "links AS (SELECT page_id, dst, row_number() OVER (PARTITION BY page_id ORDER BY first_at) - 1 AS pos FROM per_page)"
)
FIRST = (
    "firsts AS (SELECT dst AS url, page_id AS parent_pos, pos AS link_pos FROM (SELECT *, "
    "row_number() OVER (PARTITION BY dst ORDER BY page_id, pos) AS r FROM links) WHERE r = 1)"
)


def _root(column: str) -> str:
    return f"regexp_replace(regexp_replace({NETLOC.format(column)}, '^.*@', ''), ':\\\\d*$', '')".replace("\\\\", "\\")


# Every host from its first page. ``path`` is the list of link places that leads to
# a URL first, so paths of one depth are in discovery order.
CRAWL = (
    f"{LINKED}, own_links AS (SELECT s.url AS src, l.dst, l.pos FROM links l JOIN std s USING (page_id) "
    f"WHERE {_root('l.dst')} = {_root('s.url')}), "
    f"seeds AS (SELECT {STRIP.format('arg_min(url, page_id)')} AS url, min(page_id) AS pos FROM places GROUP BY host), "
    "reach(url, depth, path) USING KEY (url) AS (SELECT url, 0, [pos] FROM seeds UNION "
    "SELECT o.dst, any_value(r.depth) + 1, min(list_append(r.path, o.pos)) FROM reach r JOIN own_links o ON o.src = r.url "
    "LEFT JOIN recurring.reach k ON k.url = o.dst WHERE k.url IS NULL GROUP BY o.dst), "
    "visited AS (SELECT r.url, r.depth, r.path, s.page_id FROM reach r LEFT JOIN std s USING (url))"
)
CRAWL_TEXT = (
    "fullpage AS (SELECT v.url, v.depth, p.page_id, (SELECT string_agg('<a>next</a>', '' ) FROM nexts n "
    "WHERE n.page_id = p.page_id) AS front FROM visited v JOIN pages p USING (page_id)), "
    f"texts AS (SELECT f.url, f.depth, {TITLE} AS title, "
    f"trim(repeat('next ', coalesce((SELECT k FROM nn WHERE nn.page_id = f.page_id), 0)::BIGINT) || {TEXT}) AS text "
    "FROM fullpage f JOIN shown USING (page_id))"
)
STATS = (
    "done AS (SELECT depth, count(page_id) AS processed FROM visited GROUP BY depth), "
    "nexts_found AS (SELECT v.depth, count(DISTINCT o.dst) AS next_links FROM visited v JOIN own_links o ON o.src = v.url "
    "LEFT JOIN reach k ON k.url = o.dst WHERE v.page_id IS NOT NULL AND (k.depth > v.depth OR k.depth = v.depth AND k.path > v.path) "
    "GROUP BY v.depth) SELECT depth, processed, coalesce(next_links, 0) AS next_links FROM done LEFT JOIN nexts_found USING (depth)"
)

FILES = (
    "tok AS (SELECT page_id::VARCHAR AS id, unnest(regexp_extract_all(lower(html), '[a-z]+')) AS term FROM pages), "
    f"{STOP}, {LEM}, {NORMAL}, {_weights('nc', '(SELECT 2 * count(*) FROM pages)')}"
)

ORACLE: dict[str, str] = {
    "read_pages": "SELECT page_id, url, length(html) AS html_chars FROM pages WHERE html <> ''",
    "html_text": f"WITH {SHOWN} SELECT page_id, {TEXT} AS text FROM shown",
    "html_title": f"WITH {SHOWN} SELECT page_id, {TITLE} AS title FROM shown",
    "html_links": f"WITH {SHOWN}, {HREFS} SELECT page_id, pos, link FROM own",
    "collapse_ws": f"SELECT doc_id, {_collapse('text')} AS text FROM documents",
    "url_strip_fragment": f"SELECT page_id, {STRIP.format('url')} AS url_strip_fragment FROM pages",
    "url_host": f"SELECT page_id, lower({NETLOC.format('url')}) AS url_host FROM pages",
    "url_host_root": f"SELECT page_id, {_root('url')} AS url_host_root FROM pages",
    "url_path": f"SELECT page_id, {PATH.format('url')} AS url_path FROM pages",
    "doc_id": f"SELECT page_id, {_uuid('url')} AS doc_id FROM pages",
    "http_only": "SELECT page_id, url FROM pages WHERE starts_with(url, 'http')",
    "domain_filter": (
        f"WITH d(domain) AS (VALUES {_values([(d,) for d in DOMAINS])}) SELECT page_id, url FROM pages WHERE EXISTS "
        f"(SELECT 1 FROM d WHERE lower({NETLOC.format('url')}) = domain "
        f"OR ends_with(lower({NETLOC.format('url')}), '.' || domain))"
    ),
    "same_root": (
        f"SELECT page_id, url FROM pages WHERE {NETLOC.format('url')} = "
        f"(SELECT {NETLOC.format('url')} FROM pages ORDER BY page_id LIMIT 1)"
    ),
    "lex_alpha": "SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') AS tokens FROM documents",
    "lex_alnum": "SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' ') AS tokens FROM documents",
    "tokenize_word": f"SELECT doc_id, array_to_string([lower(t) FOR t IN {WORDS}], ' ') AS tokens FROM documents",
    "token_min_len": (
        "SELECT doc_id, array_to_string([t FOR t IN regexp_extract_all(lower(text), '[a-z]+') IF length(t) >= 4], ' ') "
        "AS tokens FROM documents"
    ),
    "stopword_anti": f"WITH {TOK}, {TC}, {STOP} SELECT id, term, cnt FROM tc WHERE term NOT IN (SELECT term FROM stop)",
    "lemma_join": (
        f"WITH {TOK}, {LEM} SELECT id, coalesce(lemma, term) AS term, count(*) AS cnt FROM tok "
        "LEFT JOIN lem ON token = term GROUP BY 1, 2"
    ),
    "normalize_tokens": f"WITH {TOK}, {STOP}, {LEM}, {NORMAL} SELECT id, term, cnt FROM nc",
    "term_freq": f"WITH {TOK}, {TC} SELECT id, term, cnt FROM tc",
    "doc_total": "SELECT doc_id AS id, len(regexp_extract_all(lower(text), '[a-z]+')) AS total FROM documents",
    "doc_freq": f"WITH {TOK} SELECT term, count(DISTINCT id) AS df FROM tok GROUP BY term",
    "corpus_size": "SELECT greatest(1, count(*)) AS n FROM documents",
    "vocab_union": f"WITH {TOK} SELECT DISTINCT term FROM tok",
    "tf_rel": f"WITH {DOC} SELECT id, term, tf FROM wt",
    "idf": (
        f"WITH {TOK} SELECT term, round(ln(1.0 + (SELECT count(*) FROM documents) / count(DISTINCT id)), 8) AS idf "
        "FROM tok GROUP BY term"
    ),
    "weight_join": f"WITH {DOC} SELECT id, term, cnt, df, n FROM wt",
    "tfidf": f"WITH {DOC} SELECT id, term, round(w, 8) AS w FROM wt",
    "doc_norm": f"WITH {DOC}, {NORMS} SELECT id, round(norm, 8) AS norm FROM norms",
    "build_index": (
        f"WITH {DOC}, s AS (SELECT id, count(*) AS n_terms, sum(w) AS sum_w FROM wt GROUP BY id) "
        f"SELECT {_uuid(chr(39) + 'doc:' + chr(39) + ' || doc_id')} AS id, 'doc:' || doc_id AS url, source AS title, "
        "coalesce(n_terms, 0) AS n_terms, round(coalesce(sum_w, 0.0), 8) AS sum_w FROM documents LEFT JOIN s ON s.id = doc_id"
    ),
    "vocab_size": f"WITH {TOK} SELECT (SELECT count(*) FROM documents) AS n_docs, count(DISTINCT term) AS n_terms FROM tok",
    "terms_per_doc": (
        "SELECT doc_id AS id, len(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS n_terms FROM documents"
    ),
    "largest_docs": (
        "SELECT doc_id AS id, len(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS n_terms FROM documents "
        "ORDER BY n_terms DESC, id LIMIT 3"
    ),
    "top_terms": (
        f"WITH {DOC}, r AS (SELECT id, term, round(w, 8) AS w FROM wt) SELECT id, "
        "row_number() OVER (PARTITION BY id ORDER BY w DESC, term) AS rank, term, w FROM r QUALIFY rank <= 10"
    ),
    "inspect_index": (
        f"WITH {DOC}, sizes AS (SELECT id, count(*) AS k FROM wt GROUP BY id), "
        "big AS (SELECT id, k, row_number() OVER (ORDER BY k DESC, id) AS r FROM sizes QUALIFY r <= 3), "
        "heavy AS (SELECT id, term, round(w, 6) AS w FROM wt JOIN big USING (id)) "
        "SELECT 'total_docs' AS part, 1 AS rank, NULL AS id, NULL AS url, NULL AS term, "
        "(SELECT count(*) FROM documents)::DOUBLE AS value "
        "UNION ALL SELECT 'vocab_size', 1, NULL, NULL, NULL, (SELECT count(*) FROM vocab)::DOUBLE "
        "UNION ALL SELECT 'n_terms', r, id::VARCHAR, 'doc:' || id, NULL, k::DOUBLE FROM big "
        "UNION ALL SELECT 'top_term', r, id::VARCHAR, 'doc:' || id, term, w FROM (SELECT *, "
        "row_number() OVER (PARTITION BY id ORDER BY w DESC, term) AS r FROM heavy) WHERE r <= 10"
    ),
    "query_vector": f"WITH {QVEC} SELECT qid, term, qw, round(qnorm, 8) AS qnorm FROM qv JOIN qn USING (qid)",
    "postings_match": (
        f"WITH {DOC}, {QVEC} SELECT qid, term, count(*) AS n_docs, round(sum(w), 8) AS sum_w "
        "FROM wt JOIN qv USING (term) GROUP BY qid, term"
    ),
    "overlap_terms": (
        f"WITH {DOC}, {QVEC} SELECT qid, id, string_agg(term, ' ' ORDER BY term) AS terms, count(*) AS n "
        "FROM wt JOIN qv USING (term) GROUP BY qid, id"
    ),
    "dot_product": f"WITH {DOC}, {QVEC}, {DOTS} SELECT qid, id, round(dot, 8) AS dot FROM dots",
    "cosine": f"WITH {DOC}, {QVEC}, {SCORED} SELECT qid, id, round(score, 8) AS score FROM sc",
    "positive_overlap": (
        f"WITH {DOC}, {QVEC}, {SCORED} SELECT qid, count(*) AS n_docs, sum(n_overlap)::BIGINT AS n_overlap "
        "FROM sc WHERE score > 0 GROUP BY qid"
    ),
    "search_topk": f"WITH {DOC}, {QVEC}, {SCORED}, {RANKED} SELECT qid, rank, score, id FROM hits WHERE rank <= {TOP_K}",
    "attach_meta": (
        f"WITH {DOC}, {QVEC}, {SCORED}, {RANKED} SELECT qid, rank, score, id, 'doc:' || id AS url, source AS title "
        "FROM hits JOIN documents ON doc_id = id"
    ),
    "search": (
        f"WITH {PAGE_DOC}, {QVEC}, {SCORED}, {RANKED} SELECT qid, rank, score, id, url, title "
        f"FROM hits JOIN pd USING (id) WHERE rank <= {TOP_K}"
    ),
    "host_throttle": (
        f"WITH r AS (SELECT event_id, user_id, epoch_us(ts) AS t, {int(INTERVAL_SECONDS * 1e6)} AS m, row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events), s AS (SELECT *, i * m + max(t - i * m) OVER "
        "(PARTITION BY user_id ORDER BY i) AS send_us FROM r) "
        "SELECT event_id, user_id, send_us, send_us - t AS wait_us FROM s"
    ),
    "crawl_delay": (
        f"WITH {LINES}, v AS (SELECT host, pos, try_cast(regexp_extract(rawv, '^\\s*(\\S+)', 1) AS DOUBLE) AS d FROM kv "
        "WHERE key = 'crawl-delay') SELECT host, (SELECT arg_min(d, pos) FROM v WHERE v.host = r.host AND d IS NOT NULL) "
        "AS crawl_delay FROM robots r"
    ),
    "robots_rules": f"WITH {RULES} SELECT r.host, grp, agent, allow, prefix, pos FROM rules r JOIN agents a USING (host, grp)",
    "robots_filter": ROBOTS_FILTER,
    "dedupe_links": f"WITH {LINKED}, {FIRST} SELECT url, parent_pos, link_pos FROM firsts",
    "frontier_fetch": (
        f"WITH {LINKED}, {FIRST} SELECT s.url, s.page_id AS key, (SELECT count(*) FROM links l WHERE l.page_id = s.page_id) "
        "AS n_links FROM firsts f JOIN std s USING (url)"
    ),
    "visited_anti": f"WITH {LINKED}, {FIRST} SELECT url FROM firsts WHERE url NOT IN (SELECT url FROM std)",
    "depth_link_cap": (
        f"WITH {LINKED}, {FIRST} SELECT url, row_number() OVER (ORDER BY parent_pos, link_pos) - 1 AS pos FROM firsts "
        f"QUALIFY pos < {LINK_CAP}"
    ),
    "accumulate_pages": f"WITH RECURSIVE {CRAWL} SELECT url, depth, page_id IS NOT NULL AS fetched FROM visited",
    "crawl_closure": f"WITH RECURSIVE {CRAWL}, {CRAWL_TEXT} SELECT url, depth, title, text FROM texts",
    "crawl_stats": f"WITH RECURSIVE {CRAWL}, {STATS}",
    "crawl_and_index": (
        f"WITH RECURSIVE {CRAWL}, {CRAWL_TEXT}, "
        "tok AS (SELECT url AS id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM texts), "
        f"{TC}, {_weights(n='(SELECT count(*) FROM texts)')} SELECT id AS url, term, cnt, round(w, 8) AS w FROM wt"
    ),
    "write_docs": "SELECT doc_id::VARCHAR AS id, 'doc:' || doc_id AS url, source AS title, text FROM documents",
    "read_index": (
        "SELECT doc_id::VARCHAR AS id, CASE lang WHEN 'en' THEN 'u' WHEN 'fr' THEN 'p' WHEN 'de' THEN 'q' ELSE 'v' END "
        "|| doc_id AS url, CASE WHEN lang IN ('en', 'de') THEN source ELSE '' END AS title, "
        "CASE WHEN lang IN ('en', 'de') THEN 3 WHEN lang = 'fr' THEN 1 ELSE 0 END AS n_terms, "
        "CASE WHEN lang IN ('en', 'de', 'fr') THEN n_chars::DOUBLE END AS a, "
        "CASE WHEN lang IN ('en', 'de') THEN 1.5::DOUBLE END AS b, CASE WHEN lang IN ('en', 'de') THEN 1.0::DOUBLE END AS d "
        "FROM documents"
    ),
    "coerce_tfidf": (
        "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END AS n, "
        "regexp_extract(props, '\\d+')::DOUBLE AS k, "
        "CASE WHEN event_type NOT IN ('click', 'view') THEN 1.0::DOUBLE END AS flag FROM events"
    ),
    "read_text_docs": (
        "SELECT page_id::VARCHAR AS id, replace(replace(html || chr(10), chr(13) || chr(10), chr(10)), chr(13), chr(10)) "
        "AS text FROM pages UNION ALL SELECT 'none-' || page_id, '' FROM pages"
    ),
    "search_index": (
        f"WITH {FILES}, {QVEC}, {SCORED}, {RANKED} SELECT qid, rank, score, id, 'p' || id AS url, '' AS title "
        f"FROM hits WHERE rank <= {TOP_K}"
    ),
    "build_index_files": f"WITH {FILES} SELECT id, term, cnt, round(w, 8) AS w FROM wt",
}
_RECORDS = (
    f"WITH {DOC} SELECT id, 'doc:' || id AS url, source AS title, term, round(w, 8) AS w "
    "FROM wt JOIN documents ON doc_id = id"
)
ORACLE["write_index"] = ORACLE["write_index_keyed"] = _RECORDS
