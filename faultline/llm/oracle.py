"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

ORACLE["op2_url_filter"] = r"""
WITH rules(rule, verdict) AS (VALUES
  ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'),
  ('net/es/', 'block'), ('net/fr/', 'block')),
r AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM rules),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM h),
m AS (SELECT p.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
      FROM p JOIN r ON (p.host = r.rh OR ends_with(p.host, '.' || r.rh)) AND starts_with(p.path, r.rp)
      GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id
"""

ORACLE["op3_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
h AS (SELECT *, ('0x' || substr(md5('17:' || doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS h FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
k AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM s),
w AS (SELECT *, [3, 1, 2][(i % 3 + 1)::INT] AS weight, 2.0 * source_size AS cap FROM k),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, i) AS o,
        coalesce(sum(source_size) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
        sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
        sum(source_size) OVER () AS total FROM w),
l AS (SELECT coalesce(arg_min((1.5 * total - 2.0 * capped) / open_weight, o), 0) AS level FROM o
      WHERE cap / weight > (1.5 * total - 2.0 * capped) / open_weight),
t AS (SELECT source, i, source_size, least(weight * level, cap) AS target FROM o, l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        ('0x' || substr(md5('17:offset:' || i::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS off FROM t),
r AS (SELECT h.*, row_number() OVER (PARTITION BY source ORDER BY size, h, doc_id) - 1 AS rk FROM h)
SELECT r.doc_id, r.source, r.size, u.source_size, u.target,
       ((floor(off + rate * (rk + 1)::DOUBLE) - floor(off + rate * rk::DOUBLE))::BIGINT * size)::BIGINT AS taken
FROM r JOIN u ON r.source IS NOT DISTINCT FROM u.source
"""

ORACLE["op7_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
WHERE rank <= 20
"""

ORACLE["op6_sharding"] = """
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
e AS (SELECT d.*, depth::INT AS depth, h >> (60 - depth) AS prefix FROM d, range(0, 61) r(depth)),
b AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes FROM e GROUP BY depth, prefix),
f AS (SELECT e.doc_id, e.n_bytes, e.depth, e.prefix, b.shard_bytes,
             row_number() OVER (PARTITION BY e.doc_id ORDER BY e.depth) AS k
      FROM e JOIN b ON e.depth = b.depth AND e.prefix = b.prefix WHERE b.shard_bytes <= 1048576)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, depth, shard_bytes
FROM f WHERE k = 1
"""

ORACLE["op13_spelling_variants"] = """
WITH RECURSIVE
bits AS (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
grouped AS (SELECT doc_id, w, count(*) AS k, row_number() OVER () AS id FROM runs GROUP BY doc_id, w),
-- crc32 is linear: what a byte adds depends on its value and on the number of bytes behind it
chars AS (SELECT id, unnest(string_split(doc_id::VARCHAR || ':' || w, '')) AS ch, generate_subscripts(string_split(doc_id::VARCHAR || ':' || w, ''), 1) AS pos FROM grouped WHERE doc_id IS NOT NULL),
bytes AS (
  SELECT id, pos, 0 AS part, CASE WHEN unicode(ch) < 128 THEN unicode(ch) ELSE 195 END AS b FROM chars
  UNION ALL SELECT id, pos, 1, unicode(ch) - 64 FROM chars WHERE unicode(ch) >= 128),
placed AS (SELECT id, b, row_number() OVER (PARTITION BY id ORDER BY pos DESC, part DESC) - 1 AS behind FROM bytes),
adds AS (
  SELECT i AS b, 0::BIGINT AS behind, v FROM bits
  UNION ALL SELECT a.b, a.behind + 1, xor(a.v >> 8, t.v) FROM adds a JOIN bits t ON t.i = (a.v & 255) WHERE a.behind < (SELECT max(behind) FROM placed)),
zeros AS (
  SELECT 0::BIGINT AS n, 4294967295::BIGINT AS c
  UNION ALL SELECT z.n + 1, xor(z.c >> 8, t.v) FROM zeros z JOIN bits t ON t.i = (z.c & 255) WHERE z.n <= (SELECT max(behind) FROM placed)),
crcs AS (SELECT id, xor(xor(max(z.c), bit_xor(a.v)), 4294967295) AS h FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM placed) p JOIN adds a USING (b, behind) JOIN zeros z USING (n) GROUP BY id),
written AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, k
  FROM grouped LEFT JOIN crcs USING (id)),
words AS (SELECT word, sum(k)::BIGINT AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
inserted AS (SELECT DISTINCT c.word AS long, c.n AS long_n, s.word AS short, s.n AS short_n FROM cut c JOIN words s ON c.rest = s.word),
near AS (
  SELECT long AS word, long_n AS n, short AS other, short_n AS other_n FROM inserted
  UNION ALL SELECT short, short_n, long, long_n FROM inserted
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS here, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON c.here = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(here, steps) AS root FROM chain GROUP BY word) r USING (word)
"""
