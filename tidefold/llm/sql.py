"""DuckDB SQL of the queries that SQL can express."""

DECONTAMINATE = r"""
WITH norm AS (
  SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)
), item AS (
  SELECT id, w, least(10, len(w)) AS n FROM norm WHERE kind = 'b' AND len(w) > 0
), win AS (
  SELECT DISTINCT id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM item, unnest(range(1, len(w) - n + 2)) AS t(i)
), doc AS (SELECT id, w FROM norm WHERE kind = 'd'
), gram AS (
  SELECT doc.id, i, sizes.n, array_to_string(w[i:i + sizes.n - 1], ' ') AS s
  FROM doc, (SELECT DISTINCT n FROM win) AS sizes, unnest(range(1, len(w) - sizes.n + 2)) AS t(i)
), hit AS (
  SELECT gram.id, i, gram.n, win.id AS item FROM gram JOIN win ON gram.s = win.s AND gram.n = win.n
), words AS (
  SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT id, i, n FROM hit)) GROUP BY id
), items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hit) GROUP BY id
)
SELECT doc.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (id) LEFT JOIN items USING (id)
"""

SUBSTRINGS = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(0, n - 49)) AS t(i)
), f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s
), hit AS (
  SELECT w.doc_id, i FROM w JOIN f USING (s) WHERE m < w.doc_id
), run AS (
  SELECT doc_id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS r
  FROM (SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS fresh FROM hit)
), span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM run GROUP BY doc_id, r
), piece AS (
  SELECT doc_id, a, z, substr(h, 2 * p + 1, 2 * (a - p)) AS s
  FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM span) JOIN d USING (doc_id)
), out AS (
  SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last, string_agg(s, '' ORDER BY a) AS s FROM piece GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(s, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN out USING (doc_id)
"""

SENTENCES = r"""
WITH s AS (
  SELECT doc_id, [y FOR y IN [trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
           FOR x IN regexp_split_to_array(coalesce(text, ''), '[.!?\n\r]')] IF y <> ''] AS s
  FROM documents
), run AS (
  SELECT doc_id, i, s[i] AS a, s[i + 1] AS b, s[i + 2] AS c FROM s, unnest(range(1, len(s) - 1)) AS t(i)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i - 1, i + 2)) AS k
  FROM (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS r FROM run) WHERE r > 1
), out AS (SELECT doc_id, count(*) AS n, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS list FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, coalesce(n, 0) AS n_removed, coalesce(list, '') AS removed
FROM s LEFT JOIN out USING (doc_id)
"""

EMBEDDINGS = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links, min(reach.b) AS component_id,
       min(reach.b) = v.vec_id AS kept
FROM v JOIN reach ON reach.a = v.vec_id GROUP BY v.vec_id
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT lang, w, len(w) AS n FROM (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
      FROM documents))
), total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM piece GROUP BY lang
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS c
  FROM piece, (VALUES (1), (2), (3), (4), (5)) AS s(k), unnest(range(1, n - k + 2)) AS t(i) GROUP BY ALL HAVING count(*) >= 100
), cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cut AS (
  SELECT cand.*, j, x.c AS l, y.c AS r, total.n, CAST(1000 * a::HUGEINT * total.n // (x.c::HUGEINT * y.c) AS BIGINT) AS score
  FROM cand, unnest(range(1, cand.k)) AS t(j), f AS x, f AS y, total
  WHERE x.lang = cand.lang AND x.phrase = array_to_string(w[1:j], ' ') AND y.lang = cand.lang
    AND y.phrase = array_to_string(w[j + 1:cand.k], ' ') AND total.lang = cand.lang
), low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT DISTINCT cand.lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a AS longer
  FROM cand, unnest(range(2, k)) AS s(m), unnest(range(1, k - m + 2)) AS t(i)
), kept AS (
  SELECT * FROM low WHERE NOT EXISTS (
    SELECT 1 FROM inside WHERE inside.lang = low.lang AND inside.phrase = low.phrase AND 100 * longer >= 100 * a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

HARD_NEGATIVES = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), neg AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM pos JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""
