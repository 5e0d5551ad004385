"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Every window of 35 words is counted as text; words in a repeated one go.
SUBSTRING_DEDUP = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(w[i:i+34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
twice AS MATERIALIZED (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
hit AS MATERIALIZED (SELECT doc_id, i FROM win WHERE h IN (SELECT h FROM twice)),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM hit),
word AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0),
kept AS (
  SELECT a.doc_id, count(g.p) AS n_removed,
         coalesce(string_agg(a.x, ' ' ORDER BY a.p) FILTER (WHERE g.p IS NULL), '') AS t
  FROM word a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.p = g.p GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id"""

# All pairs of texts that share a shingle, then the closure of the links.
NGRAM_JACCARD = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i+4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT e.b, reach.r FROM reach JOIN edge e ON e.a = reach.doc_id)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, t.component_id
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) t LEFT JOIN n ON n.doc_id = t.doc_id"""

# The same, with the number of links of every text.
NGRAM_JACCARD_LINKS = NGRAM_JACCARD.rpartition("\nSELECT")[0] + r"""
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, t.component_id, CAST(coalesce(e.k, 0) AS BIGINT) AS n_links
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) t LEFT JOIN n ON n.doc_id = t.doc_id
LEFT JOIN (SELECT a, count(*) AS k FROM edge GROUP BY a) e ON e.a = t.doc_id"""

# The windows by prefix sums; the digests straight from the turns.
CHAT_FORMAT = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
a AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
         row_number() OVER o - 1 AS i
  FROM src WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
b AS (
  SELECT *, i = 0 AND role = 'system' AND tokens <= 640 AS is_system,
         coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prefix,
         max(CASE WHEN i = 0 AND role = 'system' AND tokens <= 640 THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS sys
  FROM a),
c AS (SELECT *, (1024 - 256 - sys) // 2 AS cell FROM b),
e AS (SELECT *, (prefix - sys) // cell AS slot, NOT is_system AND tokens > cell AS alone FROM c),
k AS (SELECT *, CASE WHEN alone THEN least(256, 1024 - sys - tokens) ELSE 256 END AS room FROM e),
f AS (
  SELECT *, CASE WHEN is_system THEN coalesce(lead(room) OVER o < 0, false)
                 ELSE coalesce(slot <> lag(slot) OVER o OR alone OR lag(alone) OVER o OR lag(is_system) OVER o, true) END AS opens
  FROM k WINDOW o AS (PARTITION BY conv_id ORDER BY i)),
g AS (
  SELECT *, greatest(sum(CAST(opens AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY i) - 1, 0) AS win FROM f),
h AS (
  SELECT *, 1 + sum(CAST(opens AND NOT is_system AND win > 0 AND room >= 0 AS INTEGER)) OVER (PARTITION BY conv_id) AS wins,
         CASE WHEN coalesce(lead(opens, 1) OVER o, false) AND lead(prefix, 1) OVER o - prefix <= lead(room, 1) OVER o THEN lead(win, 1) OVER o END AS w1,
         CASE WHEN coalesce(lead(opens, 2) OVER o, false) AND lead(prefix, 2) OVER o - prefix <= lead(room, 2) OVER o THEN lead(win, 2) OVER o END AS w2
  FROM g WINDOW o AS (PARTITION BY conv_id ORDER BY i)),
shown AS (
  SELECT *, CASE WHEN is_system THEN wins ELSE 1 + CAST(w1 IS NOT NULL AS INTEGER)
                 + CAST(w2 IS NOT NULL AND w2 IS DISTINCT FROM w1 AS INTEGER) END AS times,
         3 + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C')) + 1
         + length(replace(replace(replace(replace(replace(text, '\', '\0'), '<s>', '\1'), '</s>', '\2'), '[INST]', '\3'), '[/INST]', '\4'))
         + 4 AS chars
  FROM h),
l AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS said,
         coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS lost,
         sum(times * chars) AS formatted_chars
  FROM shown GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
       CAST(length(lost) AS BIGINT) AS loss_chars, sha256(lost) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM l"""

# One round: the nearest centroid of every vector, then exact floors of the means.
_ROUND = r"""
n{i} AS MATERIALIZED (
  SELECT r, arg_min(c, struct_pack(d, c)) AS c, min(d) AS d FROM (
    SELECT v.r, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN c{p} m ON v.i = m.i GROUP BY v.r, m.c)
  GROUP BY r),
c{i} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(CAST((s.t - ((s.t % s.n) + s.n) % s.n) // s.n AS BIGINT), o.x) AS x
  FROM c{p} o LEFT JOIN (SELECT n.c, v.i, sum(v.x) AS t, count(*) AS n FROM v JOIN n{i} n ON n.r = v.r GROUP BY n.c, v.i) s
    ON s.c = o.c AND s.i = o.i),"""

# Ten rounds from the eight vectors with the smallest hashes.
LLOYD = r"""
WITH a AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
k AS MATERIALIZED (
  SELECT vec_id, r, list_transform(e, lambda x: CAST(floor(1024 * x) AS BIGINT)) AS w FROM a
  WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, unnest(w) AS x, unnest(range(64)) AS i FROM k),
c0 AS MATERIALIZED (
  SELECT c, unnest(w) AS x, unnest(range(64)) AS i FROM (
    SELECT w, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), w) - 1 AS c FROM k)
  WHERE c < 8),""" + "".join(_ROUND.format(i=i, p=i - 1) for i in range(1, 11)) + r"""
f AS MATERIALIZED (
  SELECT r, arg_min(c, struct_pack(d, c)) AS c, min(d) AS d FROM (
    SELECT v.r, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN c10 m ON v.i = m.i GROUP BY v.r, m.c)
  GROUP BY r),
g AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c10 GROUP BY c)
SELECT k.vec_id, CAST(f.c AS INTEGER) AS cluster, CAST(f.d AS BIGINT) AS distance,
       CAST(sum(f.d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
       g.h AS centroid_sha256
FROM k JOIN f ON f.r = k.r JOIN g ON g.c = f.c"""

# Every document follows every order; counts by part, order and step.
FILTER_AUDIT = r"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS MATERIALIZED (
  SELECT t.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
         {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
          'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'),
          'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM t LEFT JOIN k ON t.doc_id = k.doc_id),
c AS MATERIALIZED (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, f),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)),
s AS (
  SELECT o AS filter_order, CAST(i AS INTEGER) AS step, o[i] AS x
  FROM (SELECT o, unnest([1, 2, 3, 4, 5]) AS i FROM orders WHERE length(o) = 5)),
j AS MATERIALIZED (
  SELECT part, filter_order, step, x, n, good, toxic,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: CASE y WHEN 'A' THEN f['A'] WHEN 'B' THEN f['B']
           WHEN 'C' THEN f['C'] WHEN 'D' THEN f['D'] ELSE f['E'] END) AS fails
  FROM c CROSS JOIN s),
m AS (
  SELECT *, list_contains(fails, x) AS own, len(list_filter(fails, lambda y: position(y IN filter_order) < step)) > 0 AS gone
  FROM j),
r AS (
  SELECT part, filter_order, step, x AS filter,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT own), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND own), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND own), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE own AND len(fails) = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND own), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND own), 0) AS toxic_lost
  FROM m GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r"""

ORACLE_SQL = {
    "op6_substring_dedup": SUBSTRING_DEDUP.strip(),
    "op7_chat_format": CHAT_FORMAT.strip(),
    "op8_ngram_jaccard": NGRAM_JACCARD.strip(),
    "ngram_jaccard_links": NGRAM_JACCARD_LINKS.strip(),
    "op11_lloyd": LLOYD.strip(),
    "op12_filter_audit": FILTER_AUDIT.strip(),
}
