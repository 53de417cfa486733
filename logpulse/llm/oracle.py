"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

#: Quality rules, fingerprints, suffix arrays, random draws and tokens have no SQL;
#: tests/llm compares those with brute force.
ORACLE_SQL: dict[str, str] = {
    "op8_preference_pairs": """
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS last FROM t WHERE role = 'assistant' GROUP BY conv_id),
a AS (SELECT t.conv_id, last, min(text) AS answer FROM t JOIN l ON l.conv_id = t.conv_id
      WHERE turn = last AND role = 'assistant' GROUP BY t.conv_id, last),
o AS (SELECT *, row_number() OVER (ORDER BY sha256(conv_id::VARCHAR), conv_id) AS place, count(*) OVER () AS n FROM a),
g AS (SELECT o.conv_id, o.last, d.answer AS other FROM o JOIN o d ON d.place = o.place % o.n + 1 WHERE d.conv_id <> o.conv_id),
own AS (SELECT t.conv_id AS pair_id, t.turn, t.role, t.text, g.last FROM t JOIN g ON g.conv_id = t.conv_id
        WHERE t.turn < g.last OR (t.turn = g.last AND t.role = 'assistant')),
p AS (
  SELECT pair_id, true AS is_chosen, turn, role, text FROM own
  UNION ALL SELECT pair_id, false, turn, role, text FROM own WHERE turn < last
  UNION ALL SELECT conv_id, false, last, 'assistant', other FROM g),
m AS (SELECT pair_id, turn, role, text, bool_or(is_chosen) AS c, bool_or(NOT is_chosen) AS r FROM p GROUP BY ALL),
d AS (SELECT *, min(CASE WHEN NOT (c AND r) THEN turn END) OVER (PARTITION BY pair_id) AS first_diff,
             '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered FROM m),
s AS (
  SELECT *, 'prompt' AS side FROM d WHERE first_diff IS NULL OR turn < first_diff
  UNION ALL SELECT *, 'chosen' FROM d WHERE turn >= first_diff AND c
  UNION ALL SELECT *, 'rejected' FROM d WHERE turn >= first_diff AND r),
e AS (SELECT *, sum(length(rendered)) OVER (PARTITION BY pair_id, side ORDER BY turn, role, rendered
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS stop FROM s),
f AS (SELECT *, CASE WHEN side <> 'prompt' AND role = 'assistant'
                     THEN (stop - length(rendered) + length(role) + 5) || ':' || stop END AS stretch FROM e)
SELECT pair_id,
       coalesce(string_agg(rendered, '' ORDER BY stop) FILTER (WHERE side = 'prompt'), '') AS prompt,
       coalesce(string_agg(rendered, '' ORDER BY stop) FILTER (WHERE side = 'chosen'), '') AS chosen,
       coalesce(string_agg(rendered, '' ORDER BY stop) FILTER (WHERE side = 'rejected'), '') AS rejected,
       coalesce(string_agg(stretch, ',' ORDER BY stop) FILTER (WHERE side = 'chosen'), '') AS chosen_train,
       coalesce(string_agg(stretch, ',' ORDER BY stop) FILTER (WHERE side = 'rejected'), '') AS rejected_train
FROM f GROUP BY pair_id HAVING count(*) FILTER (WHERE side <> 'prompt') > 0
""",
    "op10_content_sort": r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
""",
    "op13_lag_lead_merkle": r"""
WITH RECURSIVE
poly(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM poly WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM poly WHERE k = 8),
f AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars, coalesce('=' || lang, '') AS g,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS body,
         list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT) AS b, t
  FROM documents, crc),
d AS (
  SELECT r, g, doc_id, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || body) AS leaf,
         CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])),
                       4294967295) % 7 = 0
              THEN sha256(head || coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') || body) END AS shown
  FROM f),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n FROM d),
tree(g, lvl, pos, n, digest) AS (
  SELECT g, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT g, lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY g, lvl, pos // 2),
sub AS (
  SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1),
upper_tree(lvl, pos, n, digest) AS (
  SELECT 0, pos, n, subroot FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_tree WHERE n > 1 GROUP BY lvl, pos // 2),
root AS (SELECT digest AS root FROM upper_tree WHERE n = 1),
steps AS (
  SELECT l.r, v.lvl AS lvl, coalesce(s.digest, '') AS sib, (l.pos >> v.lvl) & 1 = 1 AS behind
  FROM leaves l JOIN (SELECT DISTINCT g, lvl FROM tree WHERE n > 1) v ON v.g = l.g
  LEFT JOIN tree s ON s.g = l.g AND s.lvl = v.lvl AND s.pos = xor(l.pos >> v.lvl, 1)
  UNION ALL
  SELECT l.r, 100 + v.lvl, coalesce(s.digest, ''), (b.pos >> v.lvl) & 1 = 1
  FROM leaves l JOIN sub b ON b.g = l.g CROSS JOIN (SELECT DISTINCT lvl FROM upper_tree WHERE n > 1) v
  LEFT JOIN upper_tree s ON s.lvl = v.lvl AND s.pos = xor(b.pos >> v.lvl, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lvl) AS k FROM steps),
fold(r, k, cur) AS (
  SELECT r, 0::BIGINT, coalesce(shown, leaf) FROM leaves
  UNION ALL
  SELECT fold.r, fold.k + 1, sha256(CASE WHEN s.behind THEN s.sib || fold.cur ELSE fold.cur || s.sib END)
  FROM fold JOIN numbered s ON s.r = fold.r AND s.k = fold.k + 1),
last_fold AS (SELECT r, arg_max(cur, k) AS folded_root FROM fold GROUP BY r),
proofs AS (SELECT r, sha256(string_agg(sib, '' ORDER BY k)) AS proof FROM numbered GROUP BY r)
SELECT l.doc_id, l.leaf, b.subroot, root.root, coalesce(p.proof, sha256('')) AS proof_sha256, x.folded_root,
       x.folded_root = root.root AS verified
FROM leaves l JOIN sub b ON b.g = l.g CROSS JOIN root JOIN last_fold x ON x.r = l.r LEFT JOIN proofs p ON p.r = l.r
""",
    "op11_counting_bloom_audit": r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, s::INT AS step, filter_order[s] AS f, filter_order[1:s - 1] AS earlier
          FROM orders, unnest(range(1, 6)) AS t(s)),
words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
          FROM labels GROUP BY doc_id),
fails AS (
  SELECT words.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN min(words.doc_id) OVER (PARTITION BY text) < coalesce(words.doc_id::HUGEINT, 170141183460469231731687303715884105727) THEN 'E' ELSE '' END AS m
  FROM words LEFT JOIN marks ON marks.doc_id = words.doc_id),
masks AS (SELECT part, m, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM fails GROUP BY part, m),
shapley AS (
  SELECT part, l.f, sum(CASE WHEN contains(m, l.f) THEN n * (120 // length(m)) ELSE 0 END) AS shapley
  FROM masks, letters l GROUP BY part, l.f),
run AS (
  SELECT part, filter_order, step, s.f, m, n, good, toxic, contains(m, s.f) AS failing,
         length(translate(m, earlier, '')) < length(m) AS gone FROM masks, steps s)
SELECT r.part, filter_order, step,
       sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN gone AND failing THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN m = r.f THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN NOT gone AND failing THEN r.good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN NOT gone AND failing THEN r.toxic ELSE 0 END)::BIGINT AS toxic_lost,
       max(x.shapley)::BIGINT AS shapley
FROM run r JOIN shapley x ON x.part = r.part AND x.f = r.f
GROUP BY r.part, filter_order, step
""",
}
