"""DuckDB SQL of the queries that SQL can express, over the raw tables, without indexes, bands or hashes of the
operators' kind. The others (tokenizers, trained models, regular expressions with places, page trees, Bloom
filters) are held to brute force in ``tests/llm``."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

NEAR_DEDUP = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM texts),
shingles AS (SELECT row, doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.row AS ra, b.row AS rb, any_value(a.doc_id) AS a, any_value(b.doc_id) AS b, any_value(a.n) AS na, any_value(b.n) AS nb,
    count(*) AS both_n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY a.row, b.row),
links AS (SELECT DISTINCT a, b FROM shared WHERE 100 * both_n >= 80 * (na + nb - both_n)),
reach AS (SELECT a AS id, b AS r FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r),
smallest AS (SELECT id, min(r) AS r FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.r, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(m.r, s.doc_id)) AS kept
FROM sets s LEFT JOIN smallest m ON m.id = s.doc_id"""

DECONTAMINATION = rf"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: w[i:i + 12])) AS win
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (SELECT row, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM texts, sizes),
hits AS (SELECT p.row, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.win = p.w[p.i:p.i + p.n - 1]),
covered AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS place FROM hits) GROUP BY row),
named AS (SELECT row, list_sort(list(DISTINCT item_id)) AS ids FROM hits GROUP BY row)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(t.w) AS contaminated
FROM texts t LEFT JOIN covered c USING (row) LEFT JOIN named USING (row)"""

SUFFIX_DEDUP = """
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS (
  SELECT row, doc_id, i, array_slice(b, i, i + 49) AS s
  FROM (SELECT row, doc_id, b, unnest(range(1, greatest(octet_length(b) - 48, 1))) AS i FROM texts)),
first AS (SELECT s, min(doc_id) AS doc_id FROM strings GROUP BY s),
hits AS (SELECT x.row, x.i FROM strings x JOIN first f ON f.s = x.s WHERE f.doc_id < x.doc_id),
marked AS (SELECT row, i, CASE WHEN i <= lag(i) OVER (PARTITION BY row ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM hits),
runs AS (SELECT row, i, sum(opens) OVER (PARTITION BY row ORDER BY i) AS run FROM marked),
spans AS (SELECT row, run, min(i) AS a, max(i) + 50 AS z FROM runs GROUP BY row, run),
bounded AS (SELECT row, coalesce(lag(z) OVER (PARTITION BY row ORDER BY a), 1) AS kept_from, a, z FROM spans),
parts AS (
  SELECT t.row, kept_from, array_slice(b, kept_from, a - 1) AS part, a > kept_from AS filled FROM bounded JOIN texts t ON t.row = bounded.row
  UNION ALL
  SELECT t.row, e.z, array_slice(b, e.z, octet_length(b)), octet_length(b) >= e.z
  FROM texts t JOIN (SELECT row, max(z) AS z FROM spans GROUP BY row) e ON e.row = t.row),
kept AS (SELECT row, string_agg(CASE WHEN filled THEN hex(part) ELSE '' END, '' ORDER BY kept_from) AS h FROM parts GROUP BY row),
totals AS (SELECT row, sum(z - a) AS n, count(*) AS spans FROM spans GROUP BY row)
SELECT t.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(CASE WHEN n IS NULL THEN b ELSE unhex(h) END) AS kept_sha256
FROM texts t LEFT JOIN totals ON totals.row = t.row LEFT JOIN kept ON kept.row = t.row"""

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, min(page_id) AS page_id FROM payloads WHERE n >= 100 GROUP BY digest)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN f.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.page_id <> p.page_id THEN f.page_id END AS refers_to
FROM payloads p LEFT JOIN first f USING (digest)"""

LEXICAL_SEARCH = rf"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS t FROM documents),
sized AS (SELECT row, doc_id, t, len(t) AS n FROM texts WHERE len(t) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM sized) GROUP BY row, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark),
wanted AS (SELECT item, item_id, unnest(t) AS term FROM items),
parts AS (
  SELECT w.item, w.item_id, s.row, s.doc_id,
    CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))) AS part
  FROM wanted w JOIN tf USING (term) JOIN df USING (term) JOIN sized s ON s.row = tf.row, total),
scored AS (SELECT item, item_id, row, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY item, item_id, row, doc_id HAVING sum(part) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored QUALIFY rank <= 50"""

ORACLES = {
    "op4_near_dedup": NEAR_DEDUP,
    "op6_decontamination": DECONTAMINATION,
    "op8_suffix_dedup": SUFFIX_DEDUP,
    "op9_warc": WARC,
    "op12_lexical_search": LEXICAL_SEARCH,
}
