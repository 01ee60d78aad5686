"""DuckDB SQL of the queries that SQL can express."""

SUBSTRING_DEDUP = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
j AS (
  SELECT doc_id, ws[i] AS word, i,
         CASE WHEN i + 49 <= len(ws) THEN md5(array_to_string(ws[i:i + 49], ' ')) END AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
f AS (SELECT k, min(doc_id) AS first_id FROM j WHERE k IS NOT NULL GROUP BY k),
flagged AS (
  SELECT j.doc_id, j.i, j.word, max(CASE WHEN f.first_id < j.doc_id THEN 1 ELSE 0 END)
           OVER (PARTITION BY j.doc_id ORDER BY j.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM j LEFT JOIN f USING (k)),
kept AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS kept
  FROM flagged GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

JACCARD_COMPONENTS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - 4, 1) + 1 END)) AS i FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id, doc_id AS r FROM w
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

DECONTAMINATION = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
hits AS (
  SELECT doc_id, i, d.n, win.item_id
  FROM (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM win))) d
  JOIN win ON win.n = d.n AND win.k = d.k),
words_hit AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Base32 of the 20 digest bytes: 32 groups of 5 bits, read from the bits as text.
WARC_RECORDS = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
d AS (SELECT *, sha1(payload) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: right(bin(('0x' || hex[i])::INTEGER + 16), 4)), '') AS bits FROM d)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(0, 5), lambda j: (bits[5 * i + j + 1])::INTEGER * (16 >> j)::INTEGER))::INTEGER]), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM b
"""

HARD_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same, list_inner_product(a.c, r.c)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, row_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, row_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

COLLOCATIONS = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
f AS (
  SELECT lang, words, phrase, count(*)::BIGINT AS f
  FROM (SELECT lang, words, array_to_string(ws[i:i + words - 1], ' ') AS phrase
        FROM (SELECT lang, ws, words, unnest(range(1, len(ws) - words + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS words)))
  GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, words, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE words > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand)),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, (1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f), k) = 1),
held AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE words = 3)
  GROUP BY lang, phrase),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
