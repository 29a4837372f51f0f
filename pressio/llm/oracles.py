"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import line_rules

OP2 = """
WITH t AS (
  SELECT page_id, coalesce(html, '') AS p FROM pages WHERE page_id IS NOT NULL
), d AS (
  SELECT page_id, octet_length(encode(p)) AS payload_bytes, sha1(p) AS h FROM t
), b AS (
  SELECT page_id, payload_bytes, h,
    list_aggregate(list_transform(range(0, 32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
        CAST('0x' || substr(h, CAST(10 * (i // 8) + 1 AS BIGINT), 10) AS BIGINT)
        >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest
  FROM d
), m AS (SELECT payload_digest, max(page_id) AS top FROM b GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b JOIN m USING (payload_digest)
"""

OP1 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 85 * (nx.n + ny.n - c)
), sides AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, sides.y FROM reach JOIN sides ON reach.r = sides.x
)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r) AS component_id,
  d.doc_id = min(r) AS kept
FROM documents d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
"""

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), p AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), n AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
), reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON reach.r = links.x
)
SELECT vec_id, coalesce(max(n.n), 0) AS n_links, min(r) AS component_id, vec_id = min(r) AS kept
FROM reach LEFT JOIN n ON n.x = reach.vec_id GROUP BY vec_id
"""

OP11 = """
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM t
), win AS (
  SELECT rid, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS c FROM win)
  WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) AS o(d) GROUP BY rid
), f AS (
  SELECT rid, doc_id, t, ws, ls, list_filter(ls, lambda x:
    NOT regexp_matches(x, '[.!?…。！？]["''”’»)\\]]*[\\x20\\x09-\\x0D]*\\z')
    OR 100 * len(regexp_extract_all(x, '[!?#*$%&|<>]{2,}')) >= 30 * len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))
    OR (len(regexp_extract_all(x, SEPARATORS)) >= 3 AND
        4 * len(regexp_extract_all(x, SEPARATORS)) >= len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')))
    OR (length(x) <= 200 AND regexp_matches(LOW, MENU)) OR regexp_matches(LOW, BOILERPLATE)) AS gone
  FROM w
), c AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(gone) AS BIGINT) AS n_removed_lines,
    CAST(length(regexp_replace(array_to_string(gone, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS lost_chars
  FROM f LEFT JOIN rep USING (rid)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 30 * word_chars AS kept
FROM c
"""
_QUOTED = {"SEPARATORS": line_rules.SEPARATORS, "MENU": line_rules.MENU, "BOILERPLATE": line_rules.BOILERPLATE}
for _name, _pattern in _QUOTED.items():
    OP11 = OP11.replace(_name, "'" + _pattern.replace("'", "''") + "'")
OP11 = OP11.replace("LOW,", "translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),")

OP13 = """
WITH RECURSIVE orders(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS l(x)
  WHERE NOT contains(filter_order, x)
), t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM t
), f AS (
  SELECT doc_id, part,
    CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS failed
  FROM w
), l AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), p AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, failed
), s AS (
  SELECT filter_order, step, substr(filter_order, CAST(step AS BIGINT), 1) AS x,
    substr(filter_order, 1, CAST(step - 1 AS BIGINT)) AS before
  FROM orders, range(1, 6) AS r(step) WHERE length(filter_order) = 5
), c AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, x,
    coalesce(sum(n) FILTER (NOT earlier AND NOT here), 0) AS kept,
    coalesce(sum(n) FILTER (NOT earlier AND here), 0) AS removed,
    coalesce(sum(n) FILTER (earlier AND here), 0) AS redundant,
    coalesce(sum(n) FILTER (failed = x), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT earlier AND here), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (NOT earlier AND here), 0) AS toxic_lost
  FROM (SELECT *, translate(failed, before, '') <> failed AS earlier, contains(failed, x) AS here FROM p, s)
  GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM c
"""

# The turns row by row through the states of the repaired order: 0 nothing yet,
# 1 after s, 2 after u, 3 after a; x is the least (cost, audit) of each.
OP12 = """
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS b
  FROM conversations
), h AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(range(0, octet_length(b)),
      lambda i: CAST('0x' || substr(hex(b), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, y: list_reduce([xor(c, y)] || [0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 20 AS h
  FROM k
), d AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM h WHERE h <> 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || ':' || text, role, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM d
), f AS (
  SELECT *, substr(role, 1, 1) AS c, CASE
    WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault,
    substr(role, 1, 1) || lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pair
  FROM n
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS m
  FROM f GROUP BY conv_id
), ins(s, e, audit, cost) AS (
  VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 3), (1, 2, 'I', 3), (3, 2, 'I', 3),
    (2, 3, 'I', 3), (0, 3, 'II', 6), (1, 3, 'II', 6)
), edit(s, e, letter, cost, c) AS (
  VALUES (0, 0, 'D', 4, NULL), (1, 1, 'D', 4, NULL), (2, 2, 'D', 4, NULL), (3, 3, 'D', 4, NULL),
    (0, 2, 'R', 3, NULL), (1, 2, 'R', 3, NULL), (3, 2, 'R', 3, NULL), (2, 3, 'R', 3, NULL),
    (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a')
), dp AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, {'cost': 0, 'audit': ''} AS x FROM f
  UNION ALL
  SELECT dp.conv_id, f.i, edit.e AS s, min({
    'cost': CAST(dp.x.cost + ins.cost + edit.cost + CASE WHEN letter <> 'D' AND fault = 't' THEN 3 ELSE 0 END AS INTEGER),
    'audit': dp.x.audit || ins.audit || letter}) AS x
  FROM dp JOIN f ON dp.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = dp.i + 1 JOIN ins ON ins.s = dp.s
    JOIN edit ON edit.s = ins.e
  WHERE (letter = 'D' OR fault NOT IN ('b', 'd')) AND (edit.c IS NULL OR edit.c = f.c)
  GROUP BY dp.conv_id, f.i, edit.e
), a AS (
  SELECT dp.conv_id, min({'cost': dp.x.cost + ins.cost, 'audit': dp.x.audit || ins.audit}) AS x
  FROM dp JOIN g ON dp.conv_id IS NOT DISTINCT FROM g.conv_id AND dp.i = g.m JOIN ins ON ins.s = dp.s
  WHERE ins.e IN (0, 3) GROUP BY dp.conv_id
), e AS (
  SELECT conv_id, x.audit AS audit, unnest(range(1, length(x.audit) + 1)) AS p FROM a
), o AS (
  SELECT conv_id, p, letter,
    sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS i,
    sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w - 1 AS place,
    sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS outs
  FROM (SELECT *, substr(audit, CAST(p AS BIGINT), 1) AS letter FROM e) WINDOW w AS (PARTITION BY conv_id ORDER BY p)
), r AS (
  SELECT o.conv_id, string_agg(CASE letter WHEN 'K' THEN role ELSE
      CASE WHEN (place + outs) % 2 = 0 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS t
  FROM o JOIN f ON o.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = greatest(o.i, 1) WHERE letter <> 'D' GROUP BY o.conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(a.x.cost, 0) AS BIGINT) AS cost, coalesce(a.x.audit, '') AS audit,
  sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id
  LEFT JOIN a ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""

ORACLES = {
    "op5_embedding_dedup": OP5,
    "op10_knn_join": OP10,
    "op11_quality_rules": OP11,
    "op12_turn_repair": OP12,
    "op13_filter_audit": OP13,
    "op1_minhash": OP1,
    "op2_warc_revisit": OP2,
}
