"""SQL counterparts of the queries, for DuckDB."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_FILTER = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(host, '^(www|m)\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') AS canon FROM p),
listed AS (SELECT DISTINCT canon FROM c WHERE list_contains(string_split(host, '.'), 'ads-track')),
fit AS (SELECT *, ('.' || host) LIKE '%.net' AND starts_with(path, '/') AS net, ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') AS net_en,
    ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') AS com_de, ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') AS org_fr FROM c)
SELECT page_id, host, path,
  CASE WHEN net_en THEN 'example.net/en/' WHEN com_de THEN 'example.com/de/' WHEN org_fr THEN 'org/fr/' WHEN net THEN 'net/' END AS rule,
  CASE WHEN net_en THEN 'allow' WHEN com_de THEN 'block' WHEN org_fr THEN 'allow' WHEN net THEN 'block'
    WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM fit"""


LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM x),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

DECONTAMINATION = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
t AS (SELECT DISTINCT item_id, n, array_to_string(ws[i + 1:i + n], ' ') AS win
  FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(len(ws) - least(13, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i + 1:i + n], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM w JOIN (SELECT DISTINCT n FROM t) ON len(ws) >= n)),
h AS (SELECT DISTINCT doc_id, item_id, dw.i AS i, dw.n AS n FROM dw JOIN t ON dw.win = t.win AND dw.n = t.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hit ON hit.doc_id = w.doc_id LEFT JOIN its ON its.doc_id = w.doc_id"""


# CRC-32 by a table that follows from its polynomial, near words by shared words with one code point deleted.
SPELLING = f"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
once AS (SELECT doc_id, run, count(*) AS k, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM runs GROUP BY doc_id, run),
bytes AS (SELECT doc_id, run, k, list_transform(range(length(x) // 2), lambda i: ('0x' || substring(x, 2 * i + 1, 2))::BIGINT) AS b FROM once),
hashed AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, b), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) AS h FROM bytes, tab),
said AS (SELECT k, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
w AS (SELECT word, sum(k)::BIGINT AS n FROM said WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cut AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word < b.word
  UNION SELECT w.word, cut.word FROM w JOIN cut ON w.word = cut.rest),
near AS (SELECT a AS word, b AS other FROM pairs UNION ALL SELECT b, a FROM pairs),
best AS (
  SELECT near.word, w.word AS form, w.n AS form_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, w.word) AS place
  FROM near JOIN w ON w.word = near.other),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
    CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word AND place = 1),
up AS (SELECT word, word AS root, form FROM f UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON up.form = f.word)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON up.word = f.word AND up.form IS NULL"""


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.x) = 0 THEN 0 ELSE list_inner_product(q.x, c.x)::BIGINT END AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5"""


# Links inside labels, and the smallest id that each vector reaches.
EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings
  UNION SELECT links.a, reach.root FROM reach JOIN links ON links.b = reach.vec_id AND reach.root < links.a),
roots AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM roots LEFT JOIN counts USING (vec_id)"""

# Windows of 100 bytes in hexadecimal; a byte goes if a window over it starts earlier somewhere.
SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS x FROM documents),
w AS (SELECT doc_id, i, md5_number(substring(x, 2 * i + 1, 200)) AS win FROM (SELECT doc_id, x, unnest(range(length(x) // 2 - 99)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS place FROM w) WHERE place > 1),
starts AS (SELECT doc_id, i, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 100 AS fresh FROM again),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
  SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts) GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM runs),
sums AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substring(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS before
  FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(before, '') || substring(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id)"""
