"""DuckDB SQL for the operators that SQL can express over whole tables."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[i + 1:i + 5], ' '))
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.c
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""

TOOL_CALLS = """
WITH RECURSIVE u AS (
  SELECT conv_id, turn, coalesce(length(text), 0) AS n, coalesce(length(text), 0) % 7 AS kind FROM conversations WHERE role = 'user'
), r(conv_id, turn, depth) AS (
  SELECT conv_id, turn, 0 FROM u
  UNION SELECT u.conv_id, u.turn, r.depth + 1 FROM r JOIN u ON u.conv_id = r.conv_id AND u.kind <> 3 AND (u.turn = r.turn + 2 OR (u.turn = r.turn + 4 AND u.turn % 8 = 4))
), l AS (SELECT conv_id, turn, max(depth)::INTEGER AS level FROM r GROUP BY conv_id, turn),
c AS (
  SELECT u.conv_id, u.turn, 'turn-' || u.turn AS call_id, kind, level, a.turn AS result_turn, a.text AS content,
         CASE kind WHEN 0 THEN 'missing:n_chars' WHEN 1 THEN 'unknown:extra' WHEN 2 THEN 'type:n_chars' WHEN 3 THEN 'malformed,missing:n_chars' ELSE '' END AS problems,
         CASE WHEN kind = 3 THEN 'null' ELSE '{' || concat_ws(',',
           CASE WHEN u.turn >= 2 THEN '"after":"$turn-' || (u.turn - 2) || '"' END, CASE WHEN u.turn >= 4 AND u.turn % 8 = 4 THEN '"also":"$turn-' || (u.turn - 4) || '"' END,
           CASE WHEN kind = 1 THEN '"extra":true' END, CASE WHEN kind = 2 THEN '"n_chars":"many"' WHEN kind <> 0 THEN '"n_chars":' || n END) || '}' END AS arguments
  FROM u JOIN l ON l.conv_id = u.conv_id AND l.turn = u.turn LEFT JOIN conversations a ON a.role = 'assistant' AND a.conv_id = u.conv_id AND a.turn = u.turn + 1
)
SELECT conv_id, call_id, turn, level, lpad(level::VARCHAR, 10, '0') || ':' || lpad(turn::VARCHAR, 19, '0') || ':' || call_id AS place,
       CASE WHEN kind < 4 THEN 'invalid' WHEN result_turn IS NULL THEN 'no_result' ELSE 'ok' END AS status, problems, result_turn,
       sha256('{"arguments":' || arguments || ',"id":"' || call_id || '","name":"reply","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}') AS canonical_sha256
FROM c
UNION ALL
SELECT conv_id, call_id, turn + 1, NULL, '9999999999:' || lpad((turn + 1)::VARCHAR, 19, '0') || ':' || call_id, 'duplicate', '', NULL, NULL FROM c WHERE kind = 4
"""

DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, unnest(list_transform(range(greatest(len(ws) - 10, 0) + 1), lambda i: array_to_string(ws[i + 1:i + 10], ' '))) AS win FROM b WHERE len(ws) > 0
), dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i + 1:i + n], ' ') AS win FROM (
    SELECT doc_id, ws, n, unnest(range(greatest(len(ws) - n + 1, 0))) AS i FROM d, (SELECT DISTINCT n FROM bw))
), h AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), good AS (
  SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(vec_id, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.c
), n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT r.vec_id, coalesce(max(n.n), 0) AS n_links, min(r.c) AS component_id, r.vec_id = min(r.c) AS kept
FROM reach r LEFT JOIN n ON n.x = r.vec_id GROUP BY r.vec_id
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, coalesce(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
), p AS (
  SELECT * FROM s WHERE label = anchor_label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

#: Bytes as hexadecimal digits; windows are cut from pieces of a thousand, since a cut costs what lies before it.
PASSAGES = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents
), p AS (
  SELECT doc_id, k, substr(h, 2 * k + 1, 2198) AS c FROM (SELECT doc_id, h, unnest(range(0, n - 99, 1000)) AS k FROM d WHERE n >= 100)
), w AS (
  SELECT doc_id, k + j AS i, substr(c, 2 * j + 1, 200) AS s FROM (SELECT doc_id, k, c, unnest(range(least(1000, len(c) // 2 - 99))) AS j FROM p)
), r AS (
  SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1
), g AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, (i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, -1))::INTEGER AS new FROM r)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b, lag(max(i) + 100, 1, 0) OVER (PARTITION BY doc_id ORDER BY min(i)) AS was FROM g GROUP BY doc_id, run
), cut AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(h, 2 * was + 1, 2 * (a - was)), '' ORDER BY a) AS kept FROM spans JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
