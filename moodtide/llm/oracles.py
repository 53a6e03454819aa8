"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = _LOWER.format("coalesce(text, '')")

NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
    list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) END AS s
  FROM w
), e AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM s
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a
), c AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, cast(len(s.s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM windows
), starts AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n
), found AS (
  SELECT r, i, s.n, item_id FROM starts s JOIN windows x ON x.n = s.n AND x.x = array_to_string(s.w[i:i + s.n - 1], ' ')
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, cast(item_id AS VARCHAR) AS item FROM found) GROUP BY 1
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_LINE_KEY = _LOWER.format(r"trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")

LINE_DEDUP = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), e AS (
  SELECT r, doc_id, i, l[i] AS line, {_LINE_KEY} AS k FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM d)
), c AS (
  SELECT k, max(doc_id) AS keeper FROM (SELECT DISTINCT r, doc_id, k FROM e WHERE length(k) >= 20)
  GROUP BY k HAVING count(*) >= 3
), judged AS (
  SELECT r, doc_id, i, line, c.k IS NOT NULL AND c.keeper IS DISTINCT FROM doc_id AS gone FROM e LEFT JOIN c ON e.k = c.k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""


def _fits(host: str, path: str, rule_host: str, rule_path: str) -> str:
    return f"(({host} = '{rule_host}' OR ends_with({host}, '.{rule_host}')) AND starts_with({path}, '{rule_path}'))"


# rules of the query, longest first: host, path, verdict
_RULES = (("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("net", "/", "block"))


def _ruled(host: str, path: str, what: int | None) -> str:
    """CASE over the rules: their verdict (2) or their text (None)."""
    cases = (f"WHEN {_fits(host, path, h, p)} THEN '{v if what else h + p}'" for h, p, v in _RULES)
    return f"CASE {' '.join(cases)} END"


def _host(url: str) -> str:
    return f"coalesce({_LOWER.format(rf"regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1)")}, '')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _node(url: str) -> str:
    rest = rf"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"
    return f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || CASE WHEN starts_with({rest}, '/') THEN {rest} ELSE '/' || {rest} END END"


def _attribute(tag: str, name: str) -> str:
    pattern = rf"""(?is)[\s"''/]{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    value = " || ".join(f"regexp_extract({tag}, '{pattern}', {i})" for i in (1, 2, 3))
    return f"replace({value}, '&amp;', '&')"


def _without_dots(path: str) -> str:
    parts = f"string_split({path}, '/')"
    return rf"""(list_reduce({parts}, lambda acc, part: CASE part WHEN '.' THEN acc
      WHEN '..' THEN regexp_replace(acc, '/[^/]*\z', '') ELSE acc || '/' || part END)
      || CASE WHEN {parts}[-1] IN ('.', '..') THEN '/' ELSE '' END)"""


_CANONICAL = (
    r"""(?is)<link\b[^>]*[\s"''/]rel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"[^>]*"""
    r"""|''(?:[^''>]*\s)?canonical(?:\s[^''>]*)?''[^>]*|canonical(?:[\s/][^>]*)?)>"""
)

URL_FILTER = rf"""
WITH RECURSIVE p AS (
  SELECT page_id, url, regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g') AS h,
    {_host('url')} AS host, {_path('url')} AS path, {_node('url')} AS node FROM pages
), tags AS (
  SELECT *, regexp_extract(h, '{_CANONICAL}', 0) AS canonical,
    regexp_extract(h, '(?is)<meta\b[^>]*[\s"''/]http-equiv\s*=\s*["'']?refresh\b[^>]*>', 0) AS refresh FROM p
), targets AS (
  SELECT url, path, node, {_attribute('canonical', 'href')} AS t FROM tags
  UNION ALL
  SELECT url, path, node, regexp_extract({_attribute('refresh', 'content')}, '(?is)^[\s\d.;,]*url\s*=\s*[''"]?([^''"]+)', 1) FROM tags
), bare AS (
  SELECT * REPLACE (regexp_replace(regexp_replace(t, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z', '', 'g'), '(?s)#.*\z', '') AS t)
  FROM targets WHERE t <> ''
), named AS (
  SELECT * REPLACE (CASE WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?):', 1) || ':' || t ELSE t END AS t),
    regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS site,
    coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') AS folder
  FROM bare WHERE t <> ''
), parts AS (
  SELECT *, regexp_extract(t, '(?s)^([^?]*)', 1) AS own, regexp_extract(t, '(?s)^[^?]*(.*)\z', 1) AS query FROM named
), absolute AS (
  SELECT node AS a, CASE
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://')
    THEN regexp_extract(t, '(?s)^(.*?://[^/?]*)', 1) || {_without_dots(_path('t'))} || query
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE site || {_without_dots("(CASE WHEN own = '' THEN path WHEN starts_with(own, '/') THEN own ELSE folder || own END)")} || query
    END AS target
  FROM parts
), one_way AS (
  SELECT DISTINCT a, {_node('target')} AS b FROM absolute
), edges AS (
  SELECT a, b FROM one_way WHERE a <> b UNION SELECT b, a FROM one_way WHERE a <> b
), reach AS (
  SELECT a AS node, b AS other FROM edges
  UNION
  SELECT reach.node, edges.b FROM reach JOIN edges ON reach.other = edges.a
), said AS (
  SELECT node, {_ruled(_host("('http://' || other)"), _path("('http://' || other)"), 2)} AS v FROM reach
), alias AS (
  SELECT node, CASE WHEN bool_or(v = 'allow') THEN 'allow' WHEN bool_or(v = 'block') THEN 'block' END AS v FROM said GROUP BY 1
)
SELECT page_id, host, path, {_ruled('host', 'path', None)} AS rule,
  coalesce({_ruled('host', 'path', 2)}, alias.v, 'allow') AS verdict
FROM p LEFT JOIN alias ON p.node = alias.node
"""

ORACLES: dict[str, str] = {
    "op1_near_dedup": NEAR_DEDUP,
    "op3_decontamination": DECONTAMINATION,
    "op10_url_filter": URL_FILTER,
    "op12_line_dedup": LINE_DEDUP,
}
