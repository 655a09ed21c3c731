"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda g:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST(((CAST('0x' || substr(x, 1 + 5 * (g // 4), 5) AS BIGINT)) >> (15 - 5 * (g % 4))) & 31 AS INTEGER), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to
FROM d
"""

# Largest source once, smallest twice: the exponent by 60 halvings, then quotas, cuts and copies as in mixing.py.
ORACLES["op9_mixing"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, source, coalesce('s' || source, 'null') AS s, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0) AS BIGINT) AS n FROM documents),
sh AS (SELECT s, sum(n) AS n, sum(n) / (SELECT CAST(sum(n) AS DOUBLE) FROM t) AS p FROM t GROUP BY s HAVING sum(n) > 0),
bis(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1,
    CASE WHEN (SELECT max(pow(p, (lo + hi) / 2 - 1)) / min(pow(p, (lo + hi) / 2 - 1)) FROM sh) > 2.0 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN (SELECT max(pow(p, (lo + hi) / 2 - 1)) / min(pow(p, (lo + hi) / 2 - 1)) FROM sh) > 2.0 THEN hi ELSE (lo + hi) / 2 END
  FROM bis WHERE i < 60),
a AS (SELECT CASE WHEN (SELECT max(1 / p) / min(1 / p) FROM sh) > 2.0 THEN (SELECT hi FROM bis WHERE i = 60) ELSE 0.0 END AS a),
q AS (SELECT s, n, pow(p, a) AS q FROM sh, a),
z AS (SELECT sum(q) AS z, max(n / q) AS once FROM q),
plan0 AS (SELECT s, n, q / z AS weight, CAST(floor(once * z * q / z + 1e-6) AS BIGINT) AS quota FROM q, z),
plan AS (SELECT *, CAST(quota // n AS BIGINT) AS full_, quota - (quota // n) * n AS rest FROM plan0),
pl AS (SELECT t.*, weight, full_, rest, md5('17:' || full_ || ':' || t.s || ':' || substr(k, 1, 2)) AS p1,
    md5('17:' || full_ || ':' || t.s || ':' || substr(k, 1, 2) || ':' || substr(k, 3, 3)) AS p2
  FROM t LEFT JOIN plan USING (s)),
cum AS (SELECT *, sum(n) OVER (PARTITION BY s ORDER BY p1, p2, k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM pl),
ep AS (SELECT *, CASE WHEN full_ IS NULL THEN 1 ELSE full_ + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END END AS copies FROM cum),
out_ AS (SELECT doc_id, source, s, k, n, weight, unnest(range(CAST(copies AS BIGINT))) AS epoch FROM ep)
SELECT doc_id, source, n AS n_tokens, weight, epoch,
  substr(md5('17:' || epoch || ':' || s || ':' || substr(k, 1, 2)), 1, 8)
  || substr(md5('17:' || epoch || ':' || s || ':' || substr(k, 1, 2) || ':' || substr(k, 3, 3)), 1, 8) || substr(k, 1, 16) AS place
FROM out_
"""

ORACLES["op6_exact_top_k"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

# Levels 0 to 8 of the groups' trees and 0 to 3 of the tree over the groups; crc32 bit by bit.
ORACLES["op11_merkle"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, doc_id IS NOT NULL AND
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS INTEGER), 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))), CAST(4294967295 AS BIGINT)) % 3 = 0 AS hit,
    CASE WHEN doc_id IS NULL THEN '-' ELSE length(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE length(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END AS body,
    CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS low
  FROM documents),
l AS (SELECT doc_id, g, sha256(head || body) AS leaf, CASE WHEN hit THEN sha256(head || low) ELSE sha256(head || body) END AS seen FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
tree(h, g, pos, node, more) AS (
  SELECT 0, g, pos, leaf, count(*) OVER (PARTITION BY g) > 1 FROM r
  UNION ALL
  SELECT h, g, pos, node, count(*) OVER (PARTITION BY g) > 1 FROM (
    SELECT h + 1 AS h, g, pos // 8 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node FROM tree WHERE more GROUP BY h, g, pos // 8)),
subroot AS (SELECT g, h, node, row_number() OVER (ORDER BY g) - 1 AS pos FROM tree WHERE NOT more),
over(h, pos, node, more) AS (
  SELECT 0, pos, node, count(*) OVER () > 1 FROM subroot
  UNION ALL
  SELECT h, pos, node, count(*) OVER () > 1 FROM (
    SELECT h + 1 AS h, pos // 8 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node FROM over WHERE more GROUP BY h, pos // 8)),
nodes AS (
  SELECT g, h, pos, node FROM tree WHERE more
  UNION ALL SELECT s.g, s.h + o.h, o.pos, o.node FROM subroot s, over o WHERE o.more),
runs AS (SELECT g, h, pos // 8 AS run, list(node ORDER BY pos) AS list FROM nodes GROUP BY g, h, pos // 8),
way(doc_id, g, leaf, h, pos, seen, proof) AS (
  SELECT doc_id, g, leaf, 0, pos, seen, '' FROM r
  UNION ALL
  SELECT w.doc_id, w.g, w.leaf, w.h + 1, p // 8,
    sha256(array_to_string(list_concat(list[:CAST(p % 8 AS INTEGER)], [w.seen], list[CAST(p % 8 + 2 AS INTEGER):]), '')),
    w.proof || array_to_string(list_concat(list[:CAST(p % 8 AS INTEGER)], list[CAST(p % 8 + 2 AS INTEGER):]), '')
  FROM (SELECT w.*, CASE WHEN w.h = s.h THEN s.pos ELSE w.pos END AS p FROM way w JOIN subroot s USING (g)) w
  JOIN runs ON runs.g = w.g AND runs.h = w.h AND runs.run = w.p // 8)
SELECT w.doc_id, w.leaf, s.node AS subroot, o.node AS root, sha256(w.proof) AS proof_sha256, w.seen AS folded_root, w.seen = o.node AS verified
FROM way w JOIN subroot s USING (g), over o WHERE NOT o.more AND w.h = s.h + o.h
"""

ORACLES["op12_debruijn"] = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT k, doc_id, pos, sha256(array_to_string(w[pos:pos + 12], ' ')) AS x FROM (SELECT *, unnest(range(1, len(w) - 11)) AS pos FROM d)),
gone AS (SELECT DISTINCT k, pos + o AS pos FROM (
    SELECT k, doc_id, pos, min(doc_id) OVER (PARTITION BY x) AS lo FROM win) h, range(13) t(o) WHERE lo < coalesce(doc_id, 9223372036854775807)),
at_ AS (SELECT k, list(pos) AS gone FROM gone GROUP BY k),
word AS (SELECT k, i, w[i] AS w FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (SELECT k, string_agg(w, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone ON word.k = gone.k AND word.i = gone.pos GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN at_ USING (k) LEFT JOIN kept USING (k)
"""

ORACLES["op13_pair_search"] = r"""
WITH t AS (SELECT k, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS k, * FROM documents)),
n AS (SELECT k, count(*) AS n FROM t GROUP BY k),
c AS (SELECT CAST(count(*) AS BIGINT) AS N_, CAST(sum(n) AS BIGINT) AS L_ FROM n),
m AS (SELECT k, 50 + ((50 * n * N_) // L_) AS m FROM n, c),
tf AS (SELECT k, doc_id, term, count(*) AS tf FROM t GROUP BY k, doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * N_ + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (k) GROUP BY item_id, k, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
