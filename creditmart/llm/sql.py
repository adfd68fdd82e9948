"""The same results in SQL, for the operators it can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""

CHAT_FORMAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, greatest(1, ceil(strlen(text) / 4.0) + 4) AS tokens,
         -- marks, line break, and a character more for each escaped one
         16 + length(role) + length(regexp_replace(role, '[^\\<\[\n]', '', 'g'))
            + length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')) AS chars,
         row_number() OVER o AS n
  FROM said WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)),
h AS (
  SELECT *, n = 1 AND role = 'system' AS sys,
         coalesce(max(CASE WHEN n = 1 AND role = 'system' THEN tokens END) OVER c, 0) AS head,
         coalesce(max(CASE WHEN n = 1 AND role = 'system' THEN chars END) OVER c, 0) AS head_chars,
         sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) AS e
  FROM t WINDOW c AS (PARTITION BY conv_id)),
p AS (
  SELECT *, e - tokens - head AS s, greatest(2048 - 512 - head, 256) AS f FROM h),
w AS (
  SELECT *, CASE WHEN sys THEN 0 ELSE 2 * floor(s / f)
              + CASE WHEN floor((e - head - 1) / f) != floor(s / f) THEN 1 ELSE 0 END END AS win,
         coalesce(sum(CASE WHEN sys THEN 0 ELSE chars END) OVER (
           PARTITION BY conv_id ORDER BY s RANGE BETWEEN 512 PRECEDING AND 1 PRECEDING), 0) AS past
  FROM p),
o AS (
  SELECT *, lag(win) OVER (PARTITION BY conv_id ORDER BY s) IS DISTINCT FROM win AS opens FROM w)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(chars + CASE WHEN opens AND NOT sys THEN past + head_chars ELSE 0 END)::BIGINT
         AS formatted_chars
FROM o GROUP BY conv_id
"""

WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
c AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER)
            & 31)::BIGINT + 1, 1), '' ORDER BY i) AS digest
  FROM (SELECT DISTINCT hex FROM p), range(32) r(i) GROUP BY hex)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = max(page_id) OVER g THEN NULL ELSE max(page_id) OVER g END AS refers_to
FROM p JOIN c USING (hex) WINDOW g AS (PARTITION BY hex)
"""

LINE_DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
         string_split(regexp_replace(coalesce(text, ''),
           '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), chr(10)) AS masked
  FROM documents),
t AS (
  SELECT doc_id, pos, list_filter(regexp_split_to_array(masked[pos], '[\x20\x09\x0B\x0C\x0D]+'),
                                  lambda x: x != '') AS form
  FROM (SELECT doc_id, masked, unnest(range(1, len(masked) + 1)) AS pos FROM d)),
l AS (
  SELECT *, (len(form), form[1:3])::VARCHAR AS leaf FROM t WHERE len(form) >= 1),
f AS (
  SELECT leaf, form, count(*) AS n FROM l
  WHERE leaf IN (SELECT leaf FROM l GROUP BY leaf HAVING count(DISTINCT doc_id) >= 3)
  GROUP BY leaf, form),
s AS (
  SELECT leaf, form, n, 1 AS step, 3 AS depth,
         first_value(form) OVER (PARTITION BY leaf ORDER BY n DESC, form) AS seed
  FROM f
  UNION ALL
  SELECT leaf, form, n, step, depth,
         first_value(form) OVER (PARTITION BY leaf, form[1:depth] ORDER BY n DESC, form)
  FROM (SELECT leaf, form, n, step + 1 AS step,
               CASE WHEN step < 4 THEN depth ELSE depth + 1 + depth // 8 END AS depth
        FROM s
        WHERE len(list_filter(range(1, len(form) + 1), lambda i: form[i] = seed[i])) < 0.7 * len(form))),
m AS (
  SELECT leaf, form, seed AS template FROM s
  WHERE len(list_filter(range(1, len(form) + 1), lambda i: form[i] = seed[i])) >= 0.7 * len(form)),
r AS (
  SELECT l.doc_id, l.pos, leaf, template FROM l JOIN m USING (leaf, form)),
c AS (
  SELECT leaf, template, min((doc_id, pos)) AS first FROM r
  GROUP BY leaf, template HAVING count(DISTINCT doc_id) >= 3),
x AS (
  SELECT r.doc_id, r.pos FROM r JOIN c USING (leaf, template) WHERE (r.doc_id, r.pos) != c.first),
k AS (
  SELECT d.doc_id, p.pos, d.lines[p.pos] AS line, x.pos IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos FROM d) p JOIN d USING (doc_id)
  LEFT JOIN x ON x.doc_id = p.doc_id AND x.pos = p.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       length(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_chars,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""

JACCARD_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x != '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)
         AS grams
  FROM w),
g AS (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id != b.doc_id
  GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, len(s.grams) AS n_shingles, min(r.b) AS component_id
FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.grams)
"""

TOPK_SEARCH = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))), 0) = 0),
q AS (
  SELECT row_number() OVER () AS qn, vec_id AS query_id, x AS y FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT qn, query_id, vec_id, list_inner_product(x, y)::BIGINT AS score
  FROM q JOIN v ON vec_id IS DISTINCT FROM query_id)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY qn ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY rank <= 10
"""

LEXICAL_SEARCH = r"""
WITH t AS (
  SELECT row_number() OVER () AS dn, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
c AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM t WHERE len(terms) > 0),
p AS (
  SELECT dn, doc_id, len(terms) AS n, unnest(terms) AS term FROM t),
f AS (
  SELECT dn, doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM f, c GROUP BY term, n_docs),
i AS (
  SELECT item, item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS item, * FROM benchmark)),
s AS (
  SELECT item, item_id, dn, doc_id, sum(w * ((1000000000 * tf)
           // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN w USING (term), c GROUP BY item, item_id, dn, doc_id)
SELECT item_id, (row_number() OVER r)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
WINDOW r AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY rank <= 20
"""

HARD_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))), 0) = 0),
a AS (
  SELECT row_number() OVER () AS an, vec_id AS anchor_id, label AS anchor_label, x AS y
  FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT an, anchor_id, vec_id, label = anchor_label AS same, list_inner_product(x, y)::BIGINT AS score
  FROM a JOIN v ON vec_id IS DISTINCT FROM anchor_id),
p AS (
  SELECT an, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER w AS place
  FROM s WHERE same WINDOW w AS (PARTITION BY an ORDER BY score DESC, vec_id NULLS LAST)
  QUALIFY place <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (an, anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY an, place ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY rank <= 10
"""

SQL = {
    "op2_exact_dedup": EXACT_DEDUP,
    "op3_warc": WARC,
    "op5_line_dedup": LINE_DEDUP,
    "op7_chat_format": CHAT_FORMAT,
    "op8_jaccard_join": JACCARD_JOIN,
    "op11_topk_search": TOPK_SEARCH,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_hard_negatives": HARD_NEGATIVES,
}
