"""SQL (DuckDB) for the rows of the queries whose operators SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WARC = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(unhex(sha1(coalesce(html, ''))) AS BIT) :: VARCHAR AS bits,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
         + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
         + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM hashed
"""

URLS = f"""
WITH parts AS (
  SELECT page_id, translate(url, '{UPPER}', '{LOWER}') AS whole,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
sites(rule, rhost, rpath, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN sites ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT p.page_id, host, path, b.rule,
       CASE WHEN b.rule IS NOT NULL THEN b.verdict
            WHEN regexp_matches(whole, '[/.](spam-farm|cheap-pills|casino-win|ads)\\.|/login/|/cgi-bin/|/tag/|/ads/')
                 AND NOT contains(whole, '/tag/press/') THEN 'block'
            ELSE 'allow' END AS verdict
FROM parts p LEFT JOIN best b USING (page_id)
"""

NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * pairs.n >= 80 * (x.n + y.n - pairs.n)),
either AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach(a, b) AS (SELECT a, b FROM either UNION SELECT r.a, e.b FROM reach r JOIN either e ON r.b = e.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(l.b, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""

REPEATS = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows JOIN again USING (s)),
kept AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS t, count(*) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words d LEFT JOIN kept USING (doc_id)
"""

LEAKS = """
WITH items AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL),
docs AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM items WHERE len(w) > 0),
a AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
      FROM (SELECT item_id, w, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM items WHERE len(w) > 0)),
b AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, lengths WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_shingles FROM a GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_found, any_value(n_shingles) AS n_shingles
FROM a JOIN b USING (k, s) JOIN n USING (item_id) GROUP BY doc_id, item_id
HAVING 100 * count(*) >= 80 * any_value(n_shingles)
"""

HARD = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
