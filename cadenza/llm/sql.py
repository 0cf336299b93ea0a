"""DuckDB text of the queries that SQL can express."""

from __future__ import annotations

#: Water filling is solved by trying every number of capped sources; the queue and
#: the cut are plain windows.
MIXING = """
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM docs GROUP BY source),
caps AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / CAST(weight AS DOUBLE) AS ratio FROM src),
levels AS (
  SELECT a.ratio,
         ((SELECT sum(source_size) FROM caps) - coalesce(sum(b.cap) FILTER (b.ratio < a.ratio), 0))
         / CAST(sum(b.weight) FILTER (b.ratio >= a.ratio) AS DOUBLE) AS level
  FROM (SELECT DISTINCT ratio FROM caps) a CROSS JOIN caps b GROUP BY a.ratio),
lev AS (SELECT min_by(level, ratio) AS level FROM levels WHERE level <= ratio),
plan AS (
  SELECT source, source_size, least(level * CAST(weight AS DOUBLE), CAST(cap AS DOUBLE)) AS target FROM caps, lev),
queued AS (
  SELECT d.*, p.source_size, p.target,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
units AS (
  SELECT *, CAST(greatest(1, ceil(target / 1000)) AS BIGINT) AS q FROM queued WHERE size > 0 AND target > 0),
epochs AS (SELECT *, unnest([0, 1, 2]) AS epoch FROM units),
ks AS (SELECT *, unnest(range(1, CAST(ceil(size / q) AS BIGINT) + 1)) AS k FROM epochs),
packets AS (
  SELECT source, least(k * q, size) - (k - 1) * q AS words,
         CAST(epoch * source_size + start + least(k * q, size) AS DOUBLE) / target AS finish FROM ks),
run AS (
  SELECT source, words, coalesce(sum(words) OVER (ORDER BY finish, source NULLS LAST, words
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM packets),
lim AS (
  SELECT source, CAST(sum(greatest(0, least(words, (SELECT sum(size) FROM docs) - before))) AS BIGINT) AS words
  FROM run GROUP BY source)
SELECT doc_id, q.source, size, source_size, target,
       CAST(greatest(0, least(coalesce(words, 0) - start, size))
          + greatest(0, least(coalesce(words, 0) - source_size - start, size))
          + greatest(0, least(coalesce(words, 0) - 2 * source_size - start, size)) AS BIGINT) AS taken
FROM queued q LEFT JOIN lim l ON q.source IS NOT DISTINCT FROM l.source
"""

#: Every order of the five letters over counts by part and set of failures.
FILTER_AUDIT = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least_id
  FROM documents),
marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
          'C': 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
          'E': coalesce(doc_id > least_id, false)} AS f
  FROM docs LEFT JOIN marks USING (doc_id)),
sets AS (
  SELECT part, (CASE WHEN f['A'] THEN 'A' ELSE '' END) || (CASE WHEN f['B'] THEN 'B' ELSE '' END)
      || (CASE WHEN f['C'] THEN 'C' ELSE '' END) || (CASE WHEN f['D'] THEN 'D' ELSE '' END)
      || (CASE WHEN f['E'] THEN 'E' ELSE '' END) AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
rows AS (
  SELECT part, filter_order, step, n, good, toxic, fails, contains(fails, substr(filter_order, step, 1)) AS own,
         fails <> translate(fails, substr(filter_order, 1, step - 1), '') AS before
  FROM sets CROSS JOIN steps),
counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step,
         sum(CASE WHEN NOT own AND NOT before THEN n ELSE 0 END) AS kept, sum(CASE WHEN own AND NOT before THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN own AND before THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN own AND NOT before THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN own AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
  FROM rows GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM counted
"""

#: Prefixes named by a hash of all their turns; CRC-32 bit by bit; a node meets
#: each of its ancestors on the path of its smallest member.
CONVERSATION_TRIE = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, count(*) AS n, c - c % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                     lambda crc, code: list_reduce(list_prepend(xor(crc, code), [0, 0, 0, 0, 0, 0, 0, 0]),
                                                   lambda v, i: xor(v // 2, (v % 2) * 3988292384))), 4294967295) % 4 AS h
  FROM turns GROUP BY c),
kept AS (
  SELECT v.c, v.base, v.h, least(v.h, coalesce(b.n, 0)) AS k FROM convs v LEFT JOIN convs b ON b.c = v.base),
made AS (
  SELECT t.c, p - h + k + 1 AS depth, role, text FROM turns t JOIN kept USING (c) WHERE p >= h
  UNION ALL
  SELECT kept.c, p + 1, role, text FROM kept JOIN turns t ON t.c = kept.base WHERE p < k),
paths AS (
  SELECT c, depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         sha256(string_agg(sha256(role || chr(1) || text), ',') OVER (PARTITION BY c ORDER BY depth)) AS name
  FROM made
  UNION ALL SELECT c, 0, 0, '' FROM kept),
nodes AS (
  SELECT name, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY name, depth),
parents AS (
  SELECT n.name, p.name AS pname FROM nodes n JOIN paths p ON p.c = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT pname AS name, count(*) AS n_children FROM parents GROUP BY pname),
trie AS (
  SELECT n.*, o.conv_id AS parent_conv_id, coalesce(n_children, 0) AS n_children
  FROM nodes n LEFT JOIN parents USING (name) LEFT JOIN nodes o ON o.name = pname LEFT JOIN children k ON k.name = n.name),
subtrees AS (
  SELECT p.name, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * t.words) AS saved_tokens
  FROM trie t JOIN paths p ON p.c = t.conv_id AND p.depth <= t.depth GROUP BY p.name),
ends AS (
  SELECT name, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT c, arg_max(name, depth) AS name FROM paths GROUP BY c) GROUP BY name)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM trie JOIN subtrees USING (name) LEFT JOIN ends USING (name)
"""
