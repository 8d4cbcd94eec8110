"""DuckDB SQL of the queries that SQL can express: op2, op6, op9, op11, op12."""

from __future__ import annotations

from tillroll.llm.decontaminate import SLOP, WINDOW
from tillroll.llm.urls import RULES

_WS = r"[^\x20\x09-\x0D]+"

OP9 = rf"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WS}') AS ws FROM d),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING COUNT(*) > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n
            FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM win JOIN twice USING (doc_id, g)) GROUP BY doc_id),
lines AS (SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '{_WS}') GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(COALESCE(dup, 0) AS BIGINT) AS n_dup_lines, COALESCE(n_lines, 0) AS n_lines,
             CAST(COALESCE(n, 0) AS BIGINT) AS n_repeat_words,
             len(regexp_extract_all(t, '\p{{L}}[^\x20\x09-\x0D]*')) AS n_lettered,
             len(regexp_extract_all(t, '[A-Z]')) AS n_capitals
      FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_dup_lines > 40 * n_lines
            OR 10 * n_lettered < 8 * n_words OR 10 * n_capitals > 4 * word_chars) AS kept
FROM m"""

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP6 = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOW.format("COALESCE(text, '')")}, '{_ITEM}') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all({_LOW.format("COALESCE(text, '')")}, '{_ITEM}') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW}, 0) + 2)) AS i FROM iw WHERE len(ws) > 0)),
size AS (SELECT DISTINCT len(string_split(g, ' ')) AS l FROM win),
grams AS (SELECT doc_id, i, l, array_to_string(ws[i:i + l - 1], ' ') AS g
          FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM dw, size WHERE len(ws) >= l)),
hits AS (SELECT doc_id, item_id, i, l FROM grams JOIN win USING (g)),
words_hit AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, l)) AS k FROM hits) GROUP BY doc_id),
items_of AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits),
found AS (SELECT doc_id, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM items_of GROUP BY doc_id),
pos AS (SELECT doc_id, i AS p, ws[i] AS term FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM dw)),
freq AS (SELECT term, COUNT(*) AS c FROM pos GROUP BY term),
terms AS (SELECT g, term, COUNT(*) OVER (PARTITION BY g) AS need,
                 row_number() OVER (PARTITION BY g ORDER BY COALESCE(c, 0), term) AS r
          FROM (SELECT DISTINCT g, unnest(string_split(g, ' ')) AS term FROM win) LEFT JOIN freq USING (term)),
anchors AS (SELECT g, need, doc_id, p FROM terms JOIN pos USING (term) WHERE r = 1),
second AS (SELECT DISTINCT a.g, a.need, a.doc_id, a.p FROM anchors a JOIN terms t ON t.g = a.g AND t.r = least(2, a.need)
           JOIN pos x ON x.doc_id = a.doc_id AND x.term = t.term AND x.p BETWEEN a.p - {SLOP} AND a.p + {SLOP}),
around AS (SELECT a.g, a.need, a.doc_id, a.p, t.term
           FROM second a JOIN terms t ON t.g = a.g
           JOIN pos x ON x.doc_id = a.doc_id AND x.term = t.term AND x.p BETWEEN a.p - {SLOP} AND a.p + {SLOP}),
near AS (SELECT doc_id, COUNT(DISTINCT item_id) AS n
         FROM (SELECT g, doc_id FROM around GROUP BY g, doc_id, p, need HAVING COUNT(DISTINCT term) = need) JOIN win USING (g)
         GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(COALESCE(h.n, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(f.n, 0) AS BIGINT) AS n_items, sha256(COALESCE(f.ids, '')) AS items_sha256,
       COALESCE(h.n, 0) > 0 AS contaminated, CAST(COALESCE(near.n, 0) AS BIGINT) AS n_near_items
FROM dw LEFT JOIN words_hit h USING (doc_id) LEFT JOIN found f USING (doc_id) LEFT JOIN near USING (doc_id)"""


def _rule_sql(host: str, path: str, column: int) -> str:
    ranked = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r[2]))
    return "CASE " + " ".join(
        f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{v if column else h + p}'"
        for h, p, v in ranked) + " END"


_REST = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"
_HOST = _LOW.format(r"regexp_extract(rest, '^[^/?#]*')")
_NODE = ("CASE WHEN instr({0}, '://') > 0 AND regexp_extract({0}, '^.*?://([^/?#]*)', 1) <> '' THEN "
         + _LOW.format("regexp_extract({0}, '^.*?://([^/?#]*)', 1)")
         + " || regexp_extract({0}, '^.*?://[^/?#]*([^#]*)', 1) END")


def _value(name: str) -> str:
    """An attribute's value in a tag, in either kind of quotes or none."""
    head = rf"(?is)[\s\x22\x27]{name}\s*=\s*"
    forms = (r"\x22([^\x22]*)\x22", r"\x27([^\x27]*)\x27", r"([^\s\x22\x27>]+)")
    return "trim(" + " || ".join(f"regexp_extract(tag, '{head}{f}', 1)" for f in forms) + ")"


OP2 = rf"""
WITH RECURSIVE p AS (SELECT page_id, url, html, {_REST.format("COALESCE(url, '')")} AS rest FROM pages),
own AS (SELECT page_id, url, html, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
               {_NODE.format("url")} AS node FROM p),
tags AS (SELECT node, url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<body.*$', ''), '(?is)<(?:link|meta)\s[^>]*>')) AS tag
         FROM own WHERE node IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')),
aims AS (SELECT node, url, replace(CASE
           WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches({_value("rel")}, '(?i)(^|\s)canonical(\s|$)')
             THEN {_value("href")}
           WHEN regexp_matches(tag, '(?i)^<meta') AND lower({_value("http-equiv")}) = 'refresh'
             THEN trim(regexp_extract({_value("content")}, '(?is)url\s*=\s*(.*)$', 1), chr(34) || chr(39)) END, '&amp;', '&') AS aim FROM tags),
full_aims AS (SELECT node, CASE WHEN aim = '' OR aim IS NULL THEN NULL
           WHEN regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN aim
           WHEN starts_with(aim, '//') THEN regexp_extract(url, '^(.*?)://', 1) || ':' || aim
           WHEN starts_with(aim, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || aim
           WHEN regexp_matches(aim, '^(?:[A-Za-z][A-Za-z0-9+.-]*:|#)') THEN NULL
           ELSE rtrim(regexp_extract(url, '^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1), '/') || '/' || aim END AS aim FROM aims),
edges AS (SELECT node AS a, {_NODE.format("aim")} AS b FROM full_aims WHERE aim IS NOT NULL),
both_ways AS (SELECT a, b FROM edges WHERE b IS NOT NULL UNION SELECT b, a FROM edges WHERE b IS NOT NULL),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
judged AS (SELECT node, {_rule_sql("host", "path", 1)} AS v
           FROM (SELECT b AS node, {_LOW.format("regexp_extract(b, '^[^/?#]*')")} AS host, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path
                 FROM (SELECT DISTINCT b FROM reach))),
alias AS (SELECT r.a AS node, CASE WHEN bool_or(v = 'allow') THEN 'allow' WHEN bool_or(v = 'block') THEN 'block' END AS passed
          FROM reach r JOIN judged j ON j.node = r.b GROUP BY r.a)
SELECT page_id, host, path, {_rule_sql("host", "path", 0)} AS rule,
       COALESCE({_rule_sql("host", "path", 1)}, passed, 'allow') AS verdict,
       CASE WHEN {_rule_sql("host", "path", 0)} IS NOT NULL THEN 'rule' WHEN passed IS NOT NULL THEN 'alias' ELSE 'default' END AS "by"
FROM own LEFT JOIN alias USING (node)"""

OP11 = rf"""
WITH d AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS t,
                  regexp_extract_all(COALESCE(text, ''), '{_WS}') AS ws FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, COALESCE(good, false) AS good, COALESCE(toxic, false) AS toxic,
         CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS mask
  FROM d JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
states AS (SELECT part, mask, good, toxic, COUNT(*) AS n FROM masks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
           FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
gone AS (SELECT *, list_min(list_transform(string_split(mask, ''), lambda c: instr(filter_order, c))) AS stop
         FROM states, orders WHERE mask <> ''
         UNION ALL SELECT *, 6 AS stop FROM states, orders WHERE mask = ''),
steps AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS x, mask, n, good, toxic, stop
          FROM gone, range(1, 6) r(step)),
counted AS (
  SELECT part, filter_order, step, x, CAST(SUM(CASE WHEN stop > step THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(SUM(CASE WHEN stop = step THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(SUM(CASE WHEN stop < step AND instr(mask, x) > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(SUM(CASE WHEN mask = x THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(SUM(CASE WHEN stop = step AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(SUM(CASE WHEN stop = step AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM steps GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counted"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS k, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
                  regexp_extract_all({_LOW.format("COALESCE(text, '')")}, '{_TERM}') AS ts FROM documents),
t AS (SELECT k, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, COUNT(*) AS total FROM t GROUP BY lang, term HAVING COUNT(DISTINCT k) >= 3),
c AS (SELECT lang, source, term, COUNT(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, COUNT(*) AS v, SUM(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
mass AS (SELECT lang, source, SUM(n) AS n FROM c GROUP BY lang, source),
full_rows AS (SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS count,
                1 + (1000000000::HUGEINT * (COALESCE(c.n, 0) + 1)) // (COALESCE(m.n, 0) + l.v) AS p,
                1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS q
         FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN mass m USING (lang, source)
         LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // b.p) AS value
           FROM full_rows a JOIN full_rows b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
           GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(s.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
          FROM full_rows WHERE count > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 200"""

ORACLE_SQL = {"op2_urls": OP2, "op6_decontaminate": OP6, "op9_quality": OP9, "op11_filter_audit": OP11,
              "op12_source_divergence": OP12}
