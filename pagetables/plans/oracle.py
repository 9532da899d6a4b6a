"""The registered queries once more as DuckDB SQL on the same tables, for result checks."""

from __future__ import annotations

from pagetables.functions.text import SPACE_CHARS
from pagetables.plans.catalog import ARTICLE_DAY, EVENT_DAY, MARKERS, PHRASES
from pagetables.profile import FILE_EXTENSIONS

_WS = "'" + SPACE_CHARS + "'"
_WORD = r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_URL_CHAR = "[^A-Za-z0-9\\-._~:/?#\\[\\]@!$&''()*+,;=%|]"


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def _unescape(x: str) -> str:
    """In text the semicolon may be missing, as where a title was cut off; in attributes it may not."""
    return f"regexp_replace(regexp_replace({x}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


def _unescape_attribute(x: str) -> str:
    return f"replace(replace({x}, '&quot;', '\"'), '&amp;', '&')"


def _cut(x: str) -> str:
    for marker in MARKERS:
        x = f"split_part({x}, '{marker}', 1)"
    return x


def _clean(x: str) -> str:
    """Cleaned text of newline-joined, already stripped blocks."""
    x = _cut(x)
    keep = " AND ".join([f"length({_strip('l')}) >= 3", *[f"NOT contains(l, '{p}')" for p in PHRASES]])
    return _strip(f"array_to_string(list_filter(string_split({x}, chr(10)), lambda l: {keep}), chr(10))")


def _stripped_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda b: {_strip('b')}), lambda b: b <> '')"


def _words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{_WORD}'))"


def _minutes(x: str) -> str:
    return f"CASE WHEN {x} <> '' THEN CAST(greatest(1, round_even({_words(x)} / 200.0, 0)) AS INTEGER) END"


def _cleaned(relation: str, key: str, blocks: str, columns: str = "") -> str:
    """Content of a relation whose `blocks` list holds stripped texts."""
    return f"SELECT {key}{columns}, {_clean(f'array_to_string({blocks}, chr(10))')} AS content FROM {relation}"


_PARAGRAPHS = (
    "list_filter(list_transform(regexp_extract_all(html, '<p>([^<]+)', 1), "
    f"lambda b: {_strip(_unescape('b'))}), lambda b: b <> '')"
)
_TITLE = f"nullif({_strip(_unescape(chr(114) + 'egexp_extract(html, ' + repr('<h1>([^<]*)</h1>') + ', 1)'))}, '')"
_URL_ID = "nullif(regexp_extract(url, '/([a-z0-9]+)$', 1), '')"

_PAGE_RECORDS = f"""
WITH c AS ({_cleaned('pages', 'page_id', _PARAGRAPHS, f', url, {_TITLE} AS title, {_URL_ID} AS id')})
SELECT page_id, url, title, id, content, {_minutes('content')} AS read_time FROM c"""

_LINKS = f"""
raw_links AS (
  SELECT url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages),
one AS (
  SELECT url AS src_url, origin, unnest(range(len(hrefs))) AS i, hrefs FROM raw_links),
links AS (
  SELECT src_url, CAST(i AS INTEGER) AS pos, {_unescape_attribute('hrefs[i + 1]')} AS href, origin FROM one),
resolved AS (
  SELECT src_url, pos, href, origin || array_to_string(list_transform(string_split(href, ''),
    lambda c: CASE WHEN regexp_matches(c, '{_URL_CHAR}') THEN url_encode(c) ELSE c END), '') AS dst_url FROM links),
routed AS (
  SELECT *, CASE
    WHEN regexp_matches(dst_url, '^[^?#]*\\.(?i:{'|'.join(e.replace('.', chr(92) + '.') for e in FILE_EXTENSIONS)})(?:[?#]|\\z)') THEN NULL
    WHEN regexp_matches(dst_url, '(?:/th)|(?:\\.$)') AND NOT regexp_matches(dst_url, '^https?://(?:[^/?#]*\\.)?example\\.org(?:[/?#]|$)') THEN 1
    WHEN regexp_matches(dst_url, 'example\\.(?:com|net)/[a-z]{{2,6}}$') AND NOT regexp_matches(dst_url, 'on|#') THEN 2
    WHEN regexp_matches(dst_url, 'example\\.org/[a-z]+$') THEN 3
    WHEN contains(dst_url, 'blog') THEN 5 END AS rule_no,
    regexp_matches(dst_url, '^https?://(?:(?:[^/?#]*\\.)?example\\.com|(?:[^/?#]*\\.)?thther\\.example\\.org)(?:[/?#]|$)') AS in_domain
  FROM resolved),
labelled AS (
  SELECT *, CASE rule_no WHEN 1 THEN 'skip' WHEN 2 THEN 'article' WHEN 3 THEN 'category' WHEN 5 THEN 'other' END AS rule,
    CASE rule_no WHEN 1 THEN 'drop' WHEN 2 THEN 'parse' WHEN 3 THEN 'follow' WHEN 5 THEN 'follow' END AS action FROM routed),
distinct_links AS (
  SELECT * FROM labelled
  QUALIFY row_number() OVER (PARTITION BY src_url, dst_url ORDER BY coalesce(rule_no, 99), pos) = 1)"""

_DAY = "strftime(DATE '2026-01-01' + CAST(n_chars % 8 AS INTEGER), '%Y-%m-%d')"

# Facts the pages made from documents are expected to yield, per document.
_DOC_FACTS = f"""
facts AS (
  SELECT *, {_DAY} AS day,
    CASE WHEN source = 'src7' THEN NULL ELSE 'Doc ' || doc_id || ' & ' || lang END AS title,
    CASE WHEN source = 'src13' THEN 'ftp://files.example.com/' ELSE 'https://wiadomosci.example.com/' END || source || '/tekst/d' || doc_id AS url,
    CASE lang WHEN 'en' THEN 'Author ' || source WHEN 'fr' THEN 'First ' || source WHEN 'de' THEN 'Autor ' || source ELSE 'Deep ' || source END AS author,
    lang || ', ' || source AS keywords,
    CASE WHEN lang IN ('en', 'fr') THEN source END AS section,
    CASE lang WHEN 'en' THEN {_DAY} || 'T13:00:00+01:00' END AS date_modified,
    CASE lang WHEN 'en' THEN 'http://img.example.com/' || doc_id WHEN 'fr' THEN 'http://img.example.com/g' || doc_id
      WHEN 'de' THEN 'http://img.example.com/og' || doc_id END AS image_url,
    CASE lang WHEN 'en' THEN 'doc' || doc_id ELSE 'd' || doc_id END AS id,
    date_diff('day', CAST({_DAY} AS DATE), DATE '{ARTICLE_DAY}') BETWEEN 0 AND 3 AS recent,
    {_stripped_lines("regexp_replace(text, '(?s)</?[^ >/]+.*?>', '', 'g')")} AS blocks
  FROM documents),
cleaned AS (
  SELECT *, CASE WHEN len(blocks) > 0 THEN {_clean("array_to_string(blocks, chr(10))")} END AS content FROM facts)"""

_ARTICLES = f"""
WITH {_DOC_FACTS}
SELECT title, url, day AS date, content, author, keywords, section, date_modified, image_url, id, {_minutes('content')} AS read_time
FROM cleaned WHERE recent AND title IS NOT NULL AND url LIKE 'http%'"""

_RECORDS = f"""
records AS (
  SELECT doc_id, CASE WHEN source = 'src7' THEN '' ELSE 'Doc ' || doc_id || ' ' || split_part(text, chr(10), 1) END AS title,
    'https://wiadomosci.example.com/' || source || '/tekst/d' || doc_id AS url, {_DAY} AS date, text AS content,
    CASE toxic WHEN 0 THEN 'Author ' || source WHEN 1 THEN '' END AS author,
    CASE WHEN lang <> 'es' THEN lang || ', ' || source || ',,' || source END AS keywords,
    source AS section, CAST(NULL AS VARCHAR) AS date_modified,
    CASE WHEN lang = 'fr' THEN '' ELSE 'http://img.example.com/' || doc_id END AS image_url,
    CAST(doc_id AS VARCHAR) AS id, CAST(quality AS INTEGER) AS read_time, CAST(NULL AS VARCHAR) AS lead
  FROM documents LEFT JOIN labels USING (doc_id))"""

_FILLED = {
    "lead": "false", "author": "author <> ''", "date_modified": "false", "image_url": "image_url <> ''", "id": "id <> ''",
    "read_time": "read_time IS NOT NULL", "section": "section <> ''",
}
_TRUTHY = {**_FILLED, "read_time": "read_time <> 0", "title": "title <> ''"}


def _completeness(relation: str, tests: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS field, count(*) FILTER (WHERE {test}) AS filled, count(*) AS total FROM {relation}" for name, test in tests.items()
    )
    return f"""
SELECT field, filled, total, total - filled AS empty, filled * 100.0::DOUBLE / total AS pct,
  CASE WHEN filled = total THEN 'ok' WHEN filled * 2 > total THEN 'partial' ELSE 'bad' END AS status FROM ({rows})"""


# Lines that hold a JSON object; broken, blank and list lines are told apart by section.
_GOOD = "section NOT IN ('src5', 'src6', 'src8')"


def _json_text(columns: list[str]) -> str:
    return f"to_json(struct_pack({', '.join(f'{c} := {c}' for c in columns)}))"


_ARTICLE_COLUMNS = ["title", "url", "date", "content", "author", "keywords", "section", "date_modified", "image_url", "id", "read_time"]
_LINE = f"CAST({_json_text(_ARTICLE_COLUMNS)} AS VARCHAR)"


def _missing(field: str) -> str:
    return f"NOT coalesce({_TRUTHY[field]}, false)"


def _samples(fields: tuple[str, ...], chars: int, rows: int = 3) -> str:
    return " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{f}' AS field, count(*) OVER () AS n_missing, CAST(row_number() OVER (ORDER BY doc_id) AS INTEGER) AS sample_no,
          substr(title, 1, {chars}) || '...' AS title FROM records WHERE {_missing(f)}) WHERE sample_no <= {rows}"""
        for f in fields
    )


_TAGS = f"""
tags AS (
  SELECT page_id, i, {_strip(_unescape('names[i + 1]'))} AS raw FROM (
    SELECT page_id, names, unnest(range(len(names))) AS i FROM (
      SELECT page_id, string_split(array_to_string(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1), ', '), ',') AS names FROM pages))),
kept AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS pos, raw AS tag FROM tags WHERE raw <> '')"""

_FETCHES = """
requests AS (
  SELECT event_id, event_type, ts,
    CASE WHEN user_id % 10 = 0 THEN 'https://other.test/u/' ELSE 'https://wiadomosci.example.com/u/' END || user_id AS requested_url,
    CASE event_type WHEN 'click' THEN 403 WHEN 'purchase' THEN 503 ELSE 200 END AS status
  FROM events),
outcomes AS (
  SELECT *, CASE WHEN NOT contains(requested_url, 'example.com') THEN 'passthrough' WHEN event_type = 'error' THEN 'error'
    WHEN event_type = 'signup' THEN 'soft_ban' WHEN status IN (403, 503) THEN 'block' ELSE 'ok' END AS outcome,
    regexp_extract(requested_url, '^https?://([^/]+)', 1) AS host FROM requests),
classified AS (
  SELECT *, CAST(CASE WHEN outcome IN ('error', 'soft_ban', 'block') THEN 504 ELSE status END AS INTEGER) AS effective_status,
    CASE WHEN outcome = 'ok' THEN requested_url || '/final' ELSE requested_url END AS page_url FROM outcomes)"""

_WRITTEN = """CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M')
  WHEN 'signup' THEN strftime(ts, '%Y-%-m-%-d') WHEN 'error' THEN 'not-a-date' ELSE ' ' || strftime(ts, '%Y-%m-%d') END"""

_REJECTS = f"""
WITH {_DOC_FACTS}
SELECT url, title, day AS date, concat_ws(',', CASE WHEN title IS NULL THEN 'title_missing' END,
  CASE WHEN url NOT LIKE 'http%' THEN 'url_scheme' END) AS errors
FROM cleaned WHERE recent AND (title IS NULL OR url NOT LIKE 'http%')"""

ORACLE: dict[str, str] = {
    "page_title": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "page_paragraphs": f"""
WITH b AS (SELECT page_id, {_PARAGRAPHS} AS blocks FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS pos, blocks[i + 1] AS text FROM (SELECT page_id, blocks, unnest(range(len(blocks))) AS i FROM b)""",
    "page_records": _PAGE_RECORDS,
    "page_completeness": f"WITH r AS ({_PAGE_RECORDS}) " + _completeness("r", {
        "title": "title <> ''", "id": "id <> ''", "content": "content <> ''", "read_time": "read_time IS NOT NULL", "lead": "false"}),
    "page_id": f"SELECT page_id, {_URL_ID} AS id FROM pages",
    "page_hosts": """
WITH h AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host FROM pages)
SELECT page_id, host, host = 'example.com' OR host LIKE '%.example.com' OR host = 'thther.example.org' OR host LIKE '%.thther.example.org' AS in_domain,
  contains(url, 'example.com') AS in_scope FROM h""",
    "page_links": f"WITH {_LINKS} SELECT src_url, pos, href, dst_url FROM resolved",
    "page_metadata": """
SELECT doc_id, lang || ', ' || source AS keywords, CASE lang WHEN 'de' THEN 'http://img.example.com/og' || doc_id END AS og_image,
  CASE lang WHEN 'en' THEN 'doc' || doc_id END AS story_id,
  CAST(CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 1 ELSE 0 END AS BIGINT) AS n_scripts FROM documents""",
    "link_routes": f"WITH {_LINKS} SELECT src_url, pos, dst_url, rule, action, in_domain FROM labelled",
    "links_distinct": f"WITH {_LINKS} SELECT src_url, pos, href, dst_url, rule, action, in_domain FROM distinct_links",
    "crawl_edges": f"""
WITH {_LINKS} SELECT src_url AS src, dst_url AS dst, action FROM distinct_links WHERE action IN ('parse', 'follow') AND in_domain""",
    "crawl_reach": """
WITH RECURSIVE walk AS (
  SELECT '/part/' || min(p_partkey) AS url, 0 AS depth FROM part
  UNION
  SELECT e.dst, w.depth + 1 FROM walk w JOIN (
    SELECT DISTINCT '/order/' || l_orderkey AS src, '/part/' || l_partkey AS dst FROM lineitem
    UNION SELECT DISTINCT '/part/' || l_partkey, '/order/' || l_orderkey FROM lineitem) e ON e.src = w.url
  WHERE w.depth < 5),
walked AS (SELECT url, min(depth) AS depth FROM walk GROUP BY url),
leaves AS (
  SELECT '/supplier/' || l_suppkey AS url, min(depth) + 1 AS depth FROM walked JOIN lineitem ON url = '/part/' || l_partkey
  WHERE depth < 5 GROUP BY 1)
SELECT url, CAST(depth AS INTEGER) AS depth FROM (SELECT * FROM walked UNION ALL SELECT * FROM leaves)""",
    "page_reach": f"""
WITH {_LINKS}
SELECT DISTINCT split_part(url, '#', 1) AS url, 0 AS depth FROM pages
UNION ALL SELECT DISTINCT split_part(dst_url, '#', 1), 1 FROM distinct_links
WHERE action IN ('parse', 'follow') AND in_domain AND split_part(dst_url, '#', 1) NOT IN (SELECT split_part(url, '#', 1) FROM pages)""",
    "clean_content": _cleaned("documents", "doc_id", _stripped_lines("text")),
    "read_time": f"SELECT doc_id, CAST({_words('text')} AS BIGINT) AS words, {_minutes('text')} AS read_time FROM documents",
    "text_steps": f"""
SELECT doc_id, {_strip('text')} AS stripped, CASE WHEN lang <> 'de' THEN source END AS nonblank,
  regexp_replace(text, '(?s)</?[^ >/]+.*?>', '', 'g') AS untagged,
  substr(CASE WHEN lang <> 'es' THEN text ELSE 'N/A' END, 1, 55) || '...' AS prefix, lang AS first_value,
  printf('%.1f', (n_chars % 8) * 12.5::DOUBLE) || '%' AS pct_text, 'https://' || source AS no_slash FROM documents""",
    "json_ld": f"""
SELECT doc_id, CASE lang WHEN 'en' THEN {_DAY} || 'T12:00:00+01:00' WHEN 'fr' THEN {_DAY} || 'T08:30:00' END AS "datePublished",
  CASE lang WHEN 'en' THEN {_DAY} || 'T13:00:00+01:00' END AS "dateModified",
  CASE lang WHEN 'en' THEN 'Author ' || source WHEN 'fr' THEN 'First ' || source END AS author,
  CASE WHEN lang IN ('en', 'fr') THEN source END AS "articleSection",
  CASE lang WHEN 'en' THEN 'http://img.example.com/' || doc_id WHEN 'fr' THEN 'http://img.example.com/g' || doc_id END AS image_url FROM documents""",
    "recent_events": f"""
WITH w AS (SELECT event_id, event_type, ts, {_WRITTEN} AS written FROM events),
d AS (SELECT *, CASE WHEN contains(written, 'T') THEN split_part(written, 'T', 1) ELSE substr(written, 1, 10) END AS date_part FROM w)
SELECT event_id, date_part, CASE WHEN event_type IN ('view', 'click', 'signup') THEN strftime(ts, '%Y-%m-%d') END AS day,
  event_type IN ('view', 'click', 'signup') AND date_diff('day', CAST(ts AS DATE), DATE '{EVENT_DAY}') BETWEEN 0 AND 3 AS recent FROM d""",
    "extract_articles": _ARTICLES,
    "rejects": _REJECTS,
    "page_outcomes": f"""
WITH {_DOC_FACTS}, {_PARAGRAPHS and f'given AS (SELECT {_PARAGRAPHS} AS blocks FROM pages)'},
o AS (SELECT CASE WHEN NOT recent THEN 'stale' WHEN title IS NULL OR url NOT LIKE 'http%' THEN 'rejected' ELSE 'accepted' END AS outcome,
  content IS NOT NULL AS has_content FROM cleaned
  UNION ALL SELECT 'stale', len(blocks) > 0 FROM given)
SELECT outcome, count(*) AS n, count(*) FILTER (WHERE has_content) AS with_content FROM o GROUP BY outcome""",
    "valid_records": f"WITH {_RECORDS} SELECT doc_id, {_strip('title')} AS title, url, date FROM records WHERE title <> ''",
    "typed_records": f"""
WITH {_RECORDS} SELECT doc_id, date AS published_on, CAST(NULL AS VARCHAR) AS modified_on,
  CAST(CASE WHEN keywords IS NOT NULL THEN 3 END AS BIGINT) AS n_tags FROM records""",
    "completeness_filled": f"WITH {_RECORDS} " + _completeness("records", _FILLED),
    "completeness_truthy": f"WITH {_RECORDS} " + _completeness("records", {k: v for k, v in _TRUTHY.items() if k not in ("section", "title")}),
    "line_completeness": f"""
WITH {_RECORDS}, parsed AS (SELECT * FROM records WHERE {_GOOD}
  UNION ALL SELECT doc_id, {', '.join('NULL' for _ in range(12))} FROM records WHERE section = 'src8') """ + _completeness("parsed", _FILLED),
    "summary_lines": f"""
WITH {_RECORDS}, n AS (
  SELECT count(*) AS total_lines, count(*) FILTER (WHERE section NOT IN ('src5', 'src6')) AS valid_json,
    count(*) FILTER (WHERE section = 'src8') AS non_object, count(*) FILTER (WHERE {_GOOD} AND title <> '') AS with_title,
    count(*) FILTER (WHERE {_GOOD} AND length(content) > 100) AS with_content,
    count(*) FILTER (WHERE {_GOOD} AND keywords <> '') AS with_keywords FROM records)
SELECT *, with_title * 100.0::DOUBLE / total_lines AS title_pct, with_content * 100.0::DOUBLE / total_lines AS content_pct,
  with_keywords * 100.0::DOUBLE / total_lines AS keywords_pct FROM n""",
    "summary_records": f"""
WITH {_RECORDS}, n AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE title <> '') AS with_title, count(*) FILTER (WHERE length(content) > 100) AS with_content,
    count(*) FILTER (WHERE keywords <> '') AS with_keywords FROM records)
SELECT *, total - with_keywords AS empty_keywords, with_title * 100.0::DOUBLE / total AS title_pct,
  with_content * 100.0::DOUBLE / total AS content_pct, with_keywords * 100.0::DOUBLE / total AS keywords_pct FROM n""",
    "bad_lines": f"WITH {_RECORDS} SELECT '{{bad ' || {_LINE} AS raw, true AS numbered FROM records WHERE section = 'src5'",
    "missing_counts": f"WITH {_RECORDS} " + " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) FILTER (WHERE {_missing(f)}) AS missing, count(*) FILTER (WHERE {_TRUTHY[f]}) AS present FROM records"
        for f in ("lead", "author", "date_modified")),
    "missing_samples": f"WITH {_RECORDS} {_samples(('lead', 'author', 'image_url'), 55)}",
    "missing_partly": f"WITH {_RECORDS.replace('records AS', 'whole AS', 1)}, records AS (SELECT * REPLACE (CASE WHEN doc_id % 397 = 5 THEN '' ELSE id END AS id) FROM whole),"
    f" s AS ({_samples(tuple(_TRUTHY), 60)}), t AS (SELECT count(*) AS total FROM records)"
    """ SELECT DISTINCT field, n_missing, CASE WHEN n_missing <= 3 THEN sample_no END AS sample_no, CASE WHEN n_missing <= 3 THEN title END AS title
FROM s, t WHERE n_missing < total""",
    "keyword_counts": f"WITH {_TAGS} SELECT tag, count(*) AS n FROM kept GROUP BY tag",
    "keyword_top_lines": f"""
WITH {_RECORDS}, p AS (SELECT doc_id, string_split(keywords, ',') AS parts FROM records WHERE keywords <> ''),
o AS (SELECT doc_id, unnest(range(len(parts))) AS i, parts FROM p),
g AS (SELECT {_strip('parts[i + 1]')} AS tag, count(*) AS n, min((doc_id, i)) AS first_seen FROM o GROUP BY 1)
SELECT tag, n FROM g ORDER BY n DESC, first_seen LIMIT 10""",
    "keyword_top_records": f"""
WITH {_TAGS}, g AS (SELECT tag, count(*) AS n, min((page_id, pos)) AS first_seen FROM kept GROUP BY tag)
SELECT tag, n, n * 100.0::DOUBLE / (SELECT count(*) FROM pages) AS pct FROM g ORDER BY n DESC, first_seen LIMIT 15""",
    "keyword_distinct": f"WITH {_TAGS} SELECT count(DISTINCT tag) AS n_tags FROM kept",
    "jsonl_roundtrip": f"WITH {_RECORDS} SELECT {', '.join(_ARTICLE_COLUMNS)} FROM records",
    "jsonl_text": f"WITH {_RECORDS} SELECT doc_id, {_LINE} AS line FROM records",
    "fetch_outcomes": f"""
WITH {_FETCHES} SELECT event_id, outcome, effective_status, page_url, 'CONTENT-ENCODING,X-Kind' AS header_names FROM classified""",
    "fetch_outcome_counts": f"WITH {_FETCHES} SELECT outcome, host, count(*) AS n FROM classified GROUP BY outcome, host",
    "fetch_latest": f"""
WITH {_FETCHES} SELECT requested_url, outcome, effective_status, page_url, count(*) OVER (PARTITION BY requested_url) AS attempts FROM classified
QUALIFY row_number() OVER (PARTITION BY requested_url ORDER BY ts DESC, effective_status DESC, page_url DESC, outcome DESC) = 1""",
    "stream_articles": _ARTICLES,
    "stream_rejects": f"SELECT r.* FROM ({_REJECTS}) AS r JOIN range(2) ON true",
    "article_job": _ARTICLES,
    "pages_json": "SELECT url, md5(html) AS html_md5 FROM pages",
    "pages_parquet": "SELECT url, md5(html) AS html_md5 FROM pages",
    "fetch_log_counts": f"WITH {_FETCHES} SELECT outcome, host, count(*) AS n FROM classified GROUP BY outcome, host",
    "linked_links": """
WITH a AS (SELECT doc_id, unnest([2 * doc_id + 1, 2 * doc_id + 2, doc_id]) AS target, unnest([0, 1, 2]) AS pos, unnest(['card', 'card', 'plain']) AS rule FROM documents)
SELECT 'https://example.com/p' || doc_id AS src_url, pos::INTEGER AS pos,
  ['/p', 'p', '//example.com/p', 'https://example.com/p', './x/../p'][doc_id % 5 + 1] || target AS href,
  'https://example.com/p' || target AS dst_url, rule, CASE rule WHEN 'card' THEN 'follow' ELSE 'parse' END AS action FROM a
UNION ALL SELECT 'https://example.com/p' || doc_id, 3, '?page=2', 'https://example.com/p' || doc_id || '?page=2', 'pagination', 'follow' FROM documents""",
    "linked_reach": """
WITH RECURSIVE walk AS (
  SELECT 0::BIGINT AS id, 0 AS depth
  UNION ALL SELECT 2 * id + k, depth + 1 FROM walk JOIN documents ON doc_id = id, (VALUES (1), (2)) sides(k) WHERE depth < 5)
SELECT 'https://example.com/p' || id AS url, depth FROM walk
UNION ALL SELECT 'https://example.com/p' || id || '?page=2', depth + 1 FROM walk JOIN documents ON doc_id = id WHERE depth < 5""",
    "canonical_reach": """
WITH RECURSIVE walk AS (
  SELECT 0::BIGINT AS id, 0 AS depth
  UNION ALL SELECT 2 * id + k, depth + 1 FROM walk JOIN documents ON doc_id = id, (VALUES (1), (2)) sides(k) WHERE depth < 5)
SELECT 'https://example.com/list?id=' || id || '&v=a+b' AS url, depth FROM walk""",
    "clean_by_rules": f"""
WITH p AS (
  SELECT list(DISTINCT w) AS phrases FROM (
    SELECT regexp_extract(unnest(string_split(text, chr(10))), '^[^ \\t\\r\\f]+ [^ \\t\\r\\f]+ [^ \\t\\r\\f]+', 0) AS w FROM benchmark) WHERE w <> ''),
cut AS (SELECT doc_id, {_cut('text')} AS x FROM documents)
SELECT doc_id, {_strip("array_to_string(list_filter(string_split(x, chr(10)), lambda l: length(" + _strip('l') + ") >= 3 AND len(list_filter(phrases, lambda q: contains(l, q))) = 0), chr(10))")} AS content
FROM cut JOIN p ON true""",
    "article_stages": f"SELECT * REPLACE (title || ' |  Lead of ' || split_part(url, '/', 4) || ' ' AS title) FROM ({_ARTICLES}) WHERE read_time > 1",
    "keyword_runs": f"WITH {_TAGS} SELECT count(DISTINCT tag) AS n_tags, true AS near FROM kept",
    "stream_distinct_urls": f"WITH {_FETCHES} SELECT DISTINCT requested_url FROM requests",
    "stream_outcome_windows": f"""
WITH {_FETCHES}, w AS (SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2024-01-01') AS start, outcome, host FROM classified)
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, outcome, host, count(*) AS n FROM w GROUP BY start, outcome, host""",
}
