"""DuckDB SQL that the registered queries must equal, where SQL can express them."""

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), ''))
         AS loss_sha256,
       sum(4 + length(role) + 2 + length(text) + 9
           + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', ''))
           + length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''),
                                                  '<', ''), ':', '')))::BIGINT
         AS formatted_chars
FROM turns GROUP BY conv_id
"""

DECONTAMINATE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
        FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS s, w
  FROM doc_words, sizes WHERE len(w) >= size
), hits AS (
  SELECT p.doc_id, p.s, p.size, v.item_id
  FROM (SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS words FROM places) p
  JOIN windows v ON v.size = p.size AND v.words = p.words
), covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS k FROM hits) GROUP BY doc_id
), item_lists AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(i, ',' ORDER BY i)) AS sha
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(l.n, 0) AS n_items, coalesce(l.sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c USING (doc_id) LEFT JOIN item_lists l USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY words ORDER BY doc_id, s) > 1 AS repeated
  FROM (SELECT doc_id, s, md5(array_to_string(w[s : s + 19], ' ')) AS words
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM doc_words))
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS k FROM windows WHERE repeated
), places AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM doc_words
), kept AS (
  SELECT p.doc_id, count(*) FILTER (g.k IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY p.k) FILTER (g.k IS NULL) AS text
  FROM places p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.k = p.k GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc_words d LEFT JOIN kept k USING (doc_id)
"""

JACCARD_JOIN = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[s : s + least(3, len(w)) - 1], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS s
        FROM doc_words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * i >= 90 * (a.n + b.n - i)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)
"""

BYTE_DEDUP = r"""
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) > 1 AS repeated
  FROM (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS m
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM bytes))
), edges AS (
  SELECT doc_id, k, sum(d) AS d
  FROM (SELECT doc_id, s AS k, 1 AS d FROM windows WHERE repeated
        UNION ALL SELECT doc_id, s + 100, -1 FROM windows WHERE repeated) GROUP BY 1, 2
), depth AS (
  SELECT doc_id, k, sum(d) OVER (PARTITION BY doc_id ORDER BY k) AS now,
         sum(d) OVER (PARTITION BY doc_id ORDER BY k) - d AS was FROM edges
), spans AS (
  SELECT doc_id, k AS low,
         lead(k) OVER (PARTITION BY doc_id ORDER BY k) AS high, now > 0 AS opens
  FROM depth WHERE (now > 0) <> (was > 0)
), gone AS (
  SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed,
         list(low ORDER BY low) AS lows, list(high ORDER BY low) AS highs
  FROM spans WHERE opens GROUP BY doc_id
)
SELECT b.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN g.doc_id IS NULL THEN sha256(unhex(h)) ELSE
         sha256(unhex(array_to_string(list_transform(range(0, len(lows) + 1), lambda k:
           substr(h, 2 * (CASE WHEN k = 0 THEN 0 ELSE highs[k] END) + 1,
                  2 * ((CASE WHEN k = len(lows) THEN length(h) // 2 ELSE lows[k + 1] END)
                       - (CASE WHEN k = 0 THEN 0 ELSE highs[k] END)))), ''))) END
         AS kept_sha256
FROM bytes b LEFT JOIN gone g USING (doc_id)
"""

HARD_NEGATIVES = r"""
WITH used AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS codes
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = c.label AS alike, c.r, c.vec_id,
         CAST(list_inner_product(a.codes, c.codes) AS BIGINT) AS score
  FROM used a JOIN used c ON a.r <> c.r WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor, r, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor, p.r ORDER BY score DESC, vec_id, s.r) AS INTEGER) AS rank
FROM scored s JOIN positives p USING (anchor)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

# The heads' lengths need crc32, which is spelled out over the bits of each digit's byte.
PREFIX_TRIE = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), crc(conv_id, name, k, value) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, 4294967295 FROM turns
  UNION ALL
  SELECT conv_id, name, k + 1,
         list_reduce(list_prepend(xor(value, CAST(ascii(substr(name, k + 1, 1)) AS BIGINT)),
                                  [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                     lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)
  FROM crc WHERE k < length(name)
), heads AS (
  SELECT conv_id, xor(value, 4294967295) % 6 AS h FROM crc WHERE k = length(name)
), rebuilt AS (
  SELECT c.conv_id, t.role, t.text, t.n AS place
  FROM heads c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.n <= c.h
  UNION ALL
  SELECT c.conv_id, t.role, t.text, 1000000 + t.n
  FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.n > c.h
), paths AS (
  SELECT conv_id, length(text) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth,
         md5(length(role)::VARCHAR || ':' || role || ':' || text) AS one
  FROM rebuilt
), named AS (
  SELECT conv_id, depth, chars,
         md5(string_agg(one, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
  FROM paths
  UNION ALL SELECT conv_id, 0, 0, '' FROM heads
), linked AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
         lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends
  FROM named
), nodes AS (
  SELECT node, depth, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * min(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                         FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY node, depth
), children AS (
  SELECT up AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node, depth)
), totals AS (
  SELECT a.node, a.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum(v.saved) AS saved_tokens
  FROM valued v JOIN named a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY 1, 2
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN totals t ON t.node = v.node AND t.depth = v.depth
LEFT JOIN nodes p ON p.node = v.up AND p.depth = v.depth - 1
"""
