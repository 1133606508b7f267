"""The SQL (DuckDB) of the queries that SQL can express, over the same tables."""

from __future__ import annotations

_LOW = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(text: str, pattern: str = _SPACE) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {pattern})"


def _low(text: str) -> str:
    return _LOW.format(x=f"coalesce({text}, '')")


LINE_FREQUENCY = f"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_words('text')} AS w FROM documents),
g AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g2 AS (SELECT doc_id, i, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS twice FROM g),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g2 WHERE twice) GROUP BY doc_id),
lines AS (SELECT doc_id, source, text, line, {_words('line')} AS lw, array_to_string({_words(_low('line'))}, ' ') AS norm
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)),
full_ AS (SELECT * FROM lines WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_ GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
frequent AS (SELECT source, norm, first FROM (SELECT source, norm, count(DISTINCT text) AS n, min(doc_id) AS first FROM full_ GROUP BY ALL) f
  JOIN hosts h USING (source) WHERE f.n > greatest(20, 0.02 * h.n)),
gone AS (SELECT doc_id, sum(len(lw)) AS n FROM full_ JOIN frequent USING (source, norm) WHERE doc_id <> first GROUP BY doc_id),
s AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_line_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND NOT (n_line_words > 0 AND (n_words - n_line_words < 10 OR n_words - n_line_words < 0.3 * n_words)) AS kept FROM v"""

SUBSTRING = f"""WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
q AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i+34], ' ') END AS g FROM p),
r AS (SELECT doc_id, i, word, g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 AS twice FROM q),
c AS (SELECT doc_id, i, word, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM r)
SELECT doc_id, count(word)::BIGINT AS n_words, count(word) FILTER (WHERE gone)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) GROUP BY doc_id"""

DECONTAMINATE = f"""WITH d AS (SELECT doc_id, {_words(_low('text'), _ALNUM)} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS k FROM (SELECT item_id, {_words(_low('text'), _ALNUM)} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i+k-1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i+k-1], ' ') AS g FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item_id FROM dw JOIN iw USING (k, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""

ARCHIVES = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to FROM f"""

SUFFIX = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(1, length(h) // 2 + 1)) AS i, h FROM d),
q AS (SELECT doc_id, i, substr(h, 2 * i - 1, 2) AS b, CASE WHEN 2 * i + 198 <= length(h) THEN substr(h, 2 * i - 1, 200) END AS g FROM p),
r AS (SELECT doc_id, i, b, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS later FROM q),
c AS (SELECT doc_id, i, b, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c)
SELECT doc_id, count(b)::BIGINT AS n_bytes, count(b) FILTER (WHERE gone)::BIGINT AS n_removed, count(b) FILTER (WHERE opens)::BIGINT AS n_spans,
  sha256(unhex(coalesce(string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone), ''))) AS kept_sha256
FROM d LEFT JOIN e USING (doc_id) GROUP BY doc_id"""

NEAR = f"""WITH RECURSIVE d AS (SELECT doc_id, {_words(_low('text'))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, len(w) || ' ' || array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM both_ JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(node, seen) AS (SELECT DISTINCT x, x FROM edges UNION SELECT r.node, e.y FROM reach r JOIN edges e ON e.x = r.seen),
least_ AS (SELECT node, min(seen) AS c FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_ ON node = d.doc_id"""

# crc32 of each <doc_id>:<run>, a byte a step, from a table made by its rule
SPELLING = f"""WITH RECURSIVE step8(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step8 WHERE k < 8),
crc AS (SELECT i, v FROM step8 WHERE k = 8),
runs AS (SELECT own, run, hex(encode(own || run)) AS b, count(*) AS c FROM (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS own, unnest(regexp_extract_all({_low('text')}, '[a-z\u00C0-\u00FF]{{7,}}')) AS run FROM documents) GROUP BY ALL),
h(own, run, b, c, k, v) AS (SELECT own, run, b, c, 0, 4294967295::BIGINT FROM runs
  UNION ALL SELECT own, run, b, c, k + 1, xor(h.v >> 8, crc.v) FROM h JOIN crc ON i = xor(h.v & 255, ('0x' || substr(b, 2 * k + 1, 2))::BIGINT)
  WHERE 2 * k < length(b)),
done AS (SELECT run, c, xor(v, 4294967295) AS h FROM h WHERE 2 * k = length(b)),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM done),
v AS (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
spots AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
parts AS (SELECT word, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM spots),
pairs AS (SELECT a.word AS x, b.word AS y FROM parts a JOIN parts b USING (i, l, r) WHERE a.word <> b.word
  UNION SELECT p.word, v.word FROM parts p JOIN v ON v.word = p.l || p.r UNION SELECT v.word, p.word FROM parts p JOIN v ON v.word = p.l || p.r),
closest AS (SELECT x, count(*) AS n_near, max(n) AS m, arg_min(y, (-n, y)) AS y FROM pairs JOIN v ON v.word = y GROUP BY x),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN y END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM v LEFT JOIN closest ON x = word),
walk(word, at_) AS (SELECT word, word FROM f UNION ALL SELECT walk.word, form FROM walk JOIN f ON f.word = at_ WHERE form IS NOT NULL),
ends AS (SELECT walk.word, at_ AS root FROM walk JOIN f ON f.word = at_ WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)"""
