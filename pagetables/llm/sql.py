"""SQL over the same tables for the queries that SQL can express."""

# Lengths follow from the template: "<turn:" role ">" body "</turn>" newline, and one more character per escaped one.
_OP9 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(15 + length(role) + length(text) + len(regexp_extract_all(role || text, '[\\<>]')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

# Words of a text by ASCII white space, A-Z lower-cased; shingles of three; all pairs that share one; components by reach.
_OP7 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
keys AS (SELECT doc_id, md5(array_to_string(list_sort(s), chr(1))) AS k FROM sets),
counted AS (
  SELECT l.a, count(DISTINCT y.k) AS n FROM links l JOIN keys x ON x.doc_id = l.a JOIN keys y ON y.doc_id = l.b AND y.k <> x.k GROUP BY l.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, coalesce(n, 0) AS n_links
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = doc_id LEFT JOIN counted c ON c.a = doc_id
"""

# Four draws from a hash of the id; cuts in code points. The last columns are hashes of the written and of the given text.
_OP11 = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
numbers AS (
  SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM drawn),
cuts AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM cuts)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

# Levels by recursion: first the nodes of every source, then those of the tree over the sources; each row climbs both with its siblings.
_OP12 = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, coalesce('=' || source, '') AS branch,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head, text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda d: ascii(d)::BIGINT)),
      lambda x, d: list_reduce(list_prepend(xor(x, d), range(8)), lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, branch, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(kept) || ':' || kept, '-')) AS tampered
  FROM (SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS kept FROM fields)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY branch ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY branch) AS n FROM leaves),
nodes AS (
  SELECT branch, 0 AS level, idx, leaf AS digest, n FROM ranked
  UNION ALL
  SELECT branch, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY branch, level, idx // 3, n),
beside AS (
  SELECT a.branch, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.branch = b.branch AND a.level = b.level AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, leaf, branch, idx AS place, 0 AS level, idx, tampered AS digest, '' AS proof FROM ranked
  UNION ALL
  SELECT doc_id, leaf, branch, place, level + 1, idx // 3, sha256(l || digest || r), proof || l || r FROM climb JOIN beside USING (branch, level, idx)),
lower AS (SELECT doc_id, leaf, branch, place, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM climb GROUP BY ALL),
subroots AS (SELECT branch, digest AS subroot, row_number() OVER (ORDER BY branch) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
nodes2 AS (
  SELECT 0 AS level, idx, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM nodes2 WHERE n > 1 GROUP BY level, idx // 3, n),
beside2 AS (
  SELECT a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes2 a JOIN nodes2 b ON a.level = b.level AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL),
climb2 AS (
  SELECT doc_id, leaf, branch, place, 0 AS level, idx, digest, proof, subroot FROM lower JOIN subroots USING (branch)
  UNION ALL
  SELECT doc_id, leaf, branch, place, level + 1, idx // 3, sha256(l || digest || r), proof || l || r, subroot FROM climb2 JOIN beside2 USING (level, idx)),
ends AS (SELECT doc_id, leaf, branch, place, subroot, arg_max(digest, level) AS folded_root, arg_max(proof, level) AS proof FROM climb2 GROUP BY ALL)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM ends JOIN (SELECT digest AS root FROM nodes2 WHERE n = 1) ON true
"""

ORACLE = {
    "op7_set_join": _OP7,
    "op9_chat_format": _OP9,
    "op11_fill_in_middle": _OP11,
    "op12_manifest": _OP12,
}
