"""DuckDB SQL with the results of those queries that SQL can express."""

from __future__ import annotations

import string

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), " + _LOWER + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BENCH = f"""
dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
        FROM bw, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, i AS p, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM dw, lens, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, p, n, item_id FROM dg JOIN win USING (n, g)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)"""

#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, u: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END)))"""

ORACLES = {
    "op2_decontamination": f"""
WITH {_BENCH}
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op3_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_LOWER}) AS key FROM l),
hot AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot USING (key) GROUP BY doc_id""",
    "op4_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM f""",
    "op11_prefix_trie": f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
m AS (SELECT c, {_CRC.format(c="c")} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
b AS (SELECT m.c, pos, r, t FROM m JOIN t ON t.c = m.c - m.c % 100 AND pos <= h UNION ALL SELECT m.c, pos, r, t FROM m JOIN t ON t.c = m.c AND pos > h),
p AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, length(t) AS chars, list({{'r': r, 't': t}}) OVER (PARTITION BY c ORDER BY pos) AS k FROM b),
a AS (SELECT c, d, chars, k FROM p UNION ALL SELECT c, 0, 0, [] FROM m),
l AS (SELECT c, max(d) AS l FROM a GROUP BY c),
n AS (SELECT k, d, min(c) AS conv, count(*) AS n, any_value(chars) AS chars, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = l), '') AS ends FROM a JOIN l USING (c) GROUP BY k, d),
path AS (SELECT a.c, a.d, n.conv FROM a JOIN n USING (k, d)),
x AS (SELECT n.conv, n.d, n.n, (n.n - 1) * n.chars AS saved, n.ends, u.conv AS up FROM n LEFT JOIN path u ON u.c = n.conv AND u.d = n.d - 1),
ch AS (SELECT up AS conv, d - 1 AS d, count(*) AS children FROM x WHERE d > 0 GROUP BY ALL),
y AS (SELECT x.*, coalesce(children, 0) AS children FROM x LEFT JOIN ch USING (conv, d)),
s AS (SELECT path.conv, path.d, sum(CAST(y.children = 0 AS INT)) AS leaves, sum(y.saved) AS saved FROM y JOIN path ON path.c = y.conv AND path.d <= y.d GROUP BY ALL)
SELECT y.conv AS conv_id, y.d AS depth, y.up AS parent_conv_id, y.n AS n_convs, y.children AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(y.ends) AS ends_sha256
FROM y JOIN s USING (conv, d)""",
    "op12_vector_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a) USING (vec_id) JOIN (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a) c USING (vec_id)""",
}
