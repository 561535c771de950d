"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op1_url_filter"] = r"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
f AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM f
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op2_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(LOW, '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS l FROM w),
s AS (SELECT doc_id, len(l) AS n, unnest(l) AS g FROM l),
e AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (min(a.n) + min(b.n) - count(*))),
r AS (
  SELECT doc_id, doc_id AS y FROM documents
  UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT doc_id, min(y) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, len(l)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM l JOIN c USING (doc_id)
""".replace("LOW", _LOWER.format("coalesce(text, '')"))

ORACLES["op6_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(LOW, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(LOW, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k,
         unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' '))) AS g
  FROM b WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: {'i': i, 'g': array_to_string(w[i:i + k - 1], ' ')})) AS p
  FROM d, k WHERE len(w) >= k),
m AS (SELECT doc_id, dw.k, p.i AS i, item_id FROM dw JOIN bw ON p.g = bw.g AND dw.k = bw.k),
h AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS q FROM m) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS sha
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
""".replace("LOW", _LOWER.format("coalesce(text, '')"))

ORACLES["op7_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
e AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS et,
         regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') AS er FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, et)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, et) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(er) + 1 + length(et) + 10 + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLES["op8_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, html, sha1(html) AS sha, min(page_id) OVER (PARTITION BY sha1(html)) AS lead FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:          'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || sha[(i // 4) * 5 + 1:(i // 4) * 5 + 5])::BIGINT) >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1]), '') AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM s
"""

ORACLES["op10_ann"] = r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i])), lambda x, y: x + y)) AS score
  FROM v q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLES["op12_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps,
         min(doc_id) OVER (PARTITION BY t) < doc_id AS copy FROM t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * caps > 5 * length(t),
                regexp_matches(t, '[#$%&*|]'), coalesce(copy, false)] AS fails,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w LEFT JOIN l USING (doc_id)),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
o AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT o, k AS step, o[k] AS own, o[1:k - 1] AS before FROM o, (SELECT x AS k FROM x)),
g AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic,
         len(list_filter(fails, lambda v: v)) AS k FROM f GROUP BY part, fails),
m AS (
  SELECT part, s.o, step, n, good, toxic, k, fails[own] AS own, len(list_filter(before, lambda i: fails[i])) > 0 AS earlier
  FROM g, s)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step::INT AS step,
       coalesce(sum(n) FILTER (NOT own AND NOT earlier), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (own AND NOT earlier), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (own AND earlier), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (own AND k = 1), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (own AND NOT earlier), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (own AND NOT earlier), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(k, 1)) FILTER (own), 0)::BIGINT AS shapley
FROM m GROUP BY part, o, step
"""
