"""Oracle SQL of the operators that SQL can express."""

from __future__ import annotations

# Unsigned crc32 of a decimal number: a fold over its characters, each followed by eight shifts.
CRC = ("xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({x}::VARCHAR, ''), "
       "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) "
       "WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)")


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
              for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN 'n' ELSE 'v' || lang END AS t, {_leaf('text')} AS leaf,
    CASE WHEN {CRC.format(x='doc_id')} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         ELSE {_leaf('text')} END AS claim
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY t) AS n, row_number() OVER () AS rid FROM leaves),
tree AS (
  SELECT t, 0 AS level, idx, leaf AS digest, n FROM ranked
  UNION ALL
  SELECT t, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8
  FROM tree WHERE n > 1 GROUP BY t, level, idx // 8, n),
subroots AS (
  SELECT t, digest, row_number() OVER (ORDER BY t) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, idx, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8
  FROM top WHERE n > 1 GROUP BY level, idx // 8, n),
way AS (
  SELECT r.rid, x.level AS step, x.idx, x.digest, r.idx // (8 ** x.level)::BIGINT AS own
  FROM ranked r JOIN tree x ON x.t = r.t AND x.n > 1 AND x.idx // 8 = r.idx // (8 ** (x.level + 1))::BIGINT
  UNION ALL
  SELECT r.rid, 100 + x.level, x.idx, x.digest, s.idx // (8 ** x.level)::BIGINT
  FROM ranked r JOIN subroots s ON s.t = r.t JOIN top x ON x.n > 1 AND x.idx // 8 = s.idx // (8 ** (x.level + 1))::BIGINT),
sides AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY step) AS k,
    coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE idx < own), '') AS l,
    coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE idx > own), '') AS r
  FROM way GROUP BY rid, step),
proof AS (SELECT rid, string_agg(l || r, '' ORDER BY k) AS siblings FROM sides GROUP BY rid),
fold AS (
  SELECT rid, 0 AS k, claim AS digest FROM ranked
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(s.l || f.digest || s.r) FROM fold f JOIN sides s ON s.rid = f.rid AND s.k = f.k + 1),
folded AS (SELECT rid, arg_max(digest, k) AS digest FROM fold GROUP BY rid)
SELECT r.doc_id, r.leaf, s.digest AS subroot, g.digest AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = g.digest AS verified
FROM ranked r JOIN subroots s ON s.t = r.t JOIN top g ON g.n = 1 JOIN folded f ON f.rid = r.rid
LEFT JOIN proof p ON p.rid = r.rid
"""

# Matches of a word with a later one, p words on, form islands; an island is a run of period p.
RUNS = f"""
WITH original AS (
  SELECT row_number() OVER () AS rid, doc_id, {CRC.format(x='doc_id')} AS h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sized AS (SELECT *, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS plant FROM original),
plan AS (SELECT *, CASE WHEN plant THEN g % n END AS a, CASE WHEN plant THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sized),
word AS (
  SELECT rid, i, CASE WHEN plant AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM plan)),
same AS (
  SELECT u.rid, u.i, v.i - u.i AS q FROM word u JOIN word v ON v.rid = u.rid AND v.x = u.x AND v.i > u.i),
island AS (
  SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM same) GROUP BY rid, q, k),
run AS (
  SELECT rid, start, length, min(q) AS period FROM island
  WHERE length >= greatest(12, 2 * q) GROUP BY rid, start, length),
best AS (
  SELECT rid, count(*) AS n_runs, arg_max({{'s': start, 'l': length, 'p': period}}, [length, -start, -period]) AS top,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS every
  FROM run GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (
  SELECT w.rid, string_agg(w.x, ' ' ORDER BY w.i) AS words
  FROM word w ANTI JOIN gone g ON g.rid = w.rid AND g.i = w.i GROUP BY w.rid)
SELECT o.doc_id, coalesce(b.n_runs, 0) AS n_runs, b.top.s AS start, b.top.l AS length, b.top.p AS period,
  (1000 * b.top.l) // b.top.p AS exponent_milli, sha256(coalesce(b.every, '')) AS runs_sha256,
  sha256(coalesce(k.words, '')) AS collapsed_sha256
FROM original o LEFT JOIN best b ON b.rid = o.rid LEFT JOIN kept k ON k.rid = o.rid
"""

# Pairs by shared shingles, then every document reachable over links.
NEAR = """
WITH RECURSIVE original AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM original),
member AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.rid AS l, b.rid AS r, a.n AS nl, b.n AS nr, count(*) AS shared
  FROM member a JOIN member b ON a.x = b.x AND a.rid <> b.rid AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY ALL),
link AS (SELECT l, r FROM common WHERE 100 * shared >= 75 * (nl + nr - shared)),
reach AS (
  SELECT rid AS l, rid AS r FROM sets
  UNION
  SELECT reach.l, link.r FROM reach JOIN link ON link.l = reach.r),
component AS (SELECT reach.l AS rid, min(s.doc_id) AS component_id FROM reach JOIN sets s ON s.rid = reach.r GROUP BY reach.l)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN component c ON c.rid = s.rid
"""

ORACLE = {"op13_periodic_runs": RUNS, "op11_merkle_manifest": MERKLE, "op8_near_duplicates": NEAR}
