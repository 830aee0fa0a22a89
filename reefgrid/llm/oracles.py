"""DuckDB texts of the queries that SQL can express."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PART = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH RECURSIVE
dw AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS l, array_to_string(ws[p : p + least(10, len(ws)) - 1], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS p FROM bw WHERE len(ws) > 0)
),
lens AS (SELECT DISTINCT l FROM win),
occ AS (
  SELECT doc_id, p, l, array_to_string(ws[p : p + l - 1], ' ') AS phrase
  FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS p FROM dw, lens WHERE len(ws) >= l)
),
hits AS (SELECT o.doc_id, o.p, o.l, w.item_id FROM occ o JOIN win w ON o.phrase = w.phrase AND o.l = w.l),
words AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(w.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(w.n, 0) > 0 AS contaminated
FROM dw d LEFT JOIN words w USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

OP9 = rf"""
WITH RECURSIVE
dw AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_PART}'), []) AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p : p + least(5, len(ws)) - 1], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS p FROM dw WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT k.a, k.b FROM both_ k JOIN n x ON x.doc_id = k.a JOIN n y ON y.doc_id = k.b WHERE 100 * k.k >= 85 * (x.n + y.n - k.k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS r FROM dw UNION SELECT e.a, r.r FROM reach r JOIN edge e ON e.b = r.a),
comp AS (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM dw d JOIN comp c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP3 = """
WITH d AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, i, trim(ls[i], ' ' || chr(9) || chr(13)) AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
bad AS (SELECT line, min(doc_id) AS first_doc FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
gone AS (SELECT l.doc_id, l.i FROM l JOIN bad ON l.line = bad.line AND l.doc_id <> bad.first_doc),
runs AS (SELECT doc_id, count(*) AS n, list(i) AS ids FROM gone GROUP BY doc_id),
kept AS (
  SELECT k.doc_id, string_agg(k.line, chr(10) ORDER BY k.i) AS text
  FROM (SELECT doc_id, i, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)) k
  LEFT JOIN gone g ON g.doc_id = k.doc_id AND g.i = k.i WHERE g.i IS NULL GROUP BY k.doc_id
)
SELECT d.doc_id, CAST(coalesce(len(d.ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM d LEFT JOIN runs r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT *, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 49)) AS p FROM d)),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.p FROM w JOIN f ON w.s = f.s AND f.first_doc < w.doc_id),
part AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
isle AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM part),
span AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM isle GROUP BY doc_id, k),
kept AS (
  SELECT s.doc_id, sum(s.b - s.a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(d.h, 2 * s.before + 1, 2 * (s.a - s.before)), '' ORDER BY s.a) || substr(any_value(d.h), 2 * max(s.b) + 1) AS h
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span) s JOIN d USING (doc_id) GROUP BY s.doc_id
)
SELECT d.doc_id, CAST(length(d.h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_PART}'), []) AS ws FROM documents),
w AS (SELECT doc_id, p, md5(array_to_string(ws[p : p + 49], ' ')) AS s FROM (SELECT *, unnest(range(1, len(ws) - 48)) AS p FROM d)),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.p FROM w JOIN f ON w.s = f.s AND f.first_doc < w.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM hit),
words AS (SELECT doc_id, q, ws[q] AS w FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS q FROM d)),
kept AS (SELECT x.doc_id, count(*) AS n, string_agg(x.w, ' ' ORDER BY x.q) AS t FROM words x
         LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.q = x.q WHERE g.q IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""

ORACLES = {"op8_suffix_array_dedup": OP8, "op10_phrase_automata_dedup": OP10, "op3_line_spread": OP3, "op1_decontaminate": OP1, "op9_minmax_near_dedup": OP9}
