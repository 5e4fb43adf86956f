"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP5 = """
WITH w AS (SELECT doc_id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
v AS (SELECT DISTINCT item, least(10, len(words)) AS n,
    array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS win
  FROM b, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS t(i) WHERE len(words) > 0),
s AS (SELECT DISTINCT n FROM v),
h AS (SELECT d.doc_id, d.i, d.n, v.item FROM (
    SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
    FROM w, s, unnest(range(1, len(words) - n + 2)) AS t(i)) d JOIN v USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + n)) AS t(p) GROUP BY 1),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items,
    string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""


OP8 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, coalesce(html, '') AS body,
    unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages),
d AS (SELECT page_id, n, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
      + 16 * substr(bits, (5 * i + 1)::INT, 1)::INT + 8 * substr(bits, (5 * i + 2)::INT, 1)::INT
      + 4 * substr(bits, (5 * i + 3)::INT, 1)::INT + 2 * substr(bits, (5 * i + 4)::INT, 1)::INT
      + substr(bits, (5 * i + 5)::INT, 1)::INT, 1)), 'string_agg', '') AS digest,
    max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""


OP12 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id
    ORDER BY score DESC, id))::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _tagged(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}, '-')"


_LEAF = "sha256({} || {} || {} || {} || {})"
_STEP = """CASE WHEN s.digest IS NULL THEN 'N' WHEN {own} & 1 = 1 THEN 'L' || s.digest ELSE 'R' || s.digest END"""

OP13 = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce('+' || lang, '') AS tree,
    {_LEAF.format(*map(_tagged, ("doc_id", "source", "lang", "n_chars", "text")))} AS leaf,
    CASE WHEN n_chars IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b:
        list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z:
          xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 7 = 0
      THEN {_LEAF.format(*map(_tagged, ("doc_id", "source", "lang", "(n_chars + 1)", "text")))} END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents),
t(tree, level, i, digest, n) AS (
  SELECT tree, 0, i, leaf, count(*) OVER (PARTITION BY tree) FROM d
  UNION ALL SELECT tree, level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (n + 1) // 2
  FROM t WHERE n > 1 GROUP BY tree, level, i // 2, n),
g AS MATERIALIZED (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i FROM t WHERE n = 1),
u(level, i, digest, n) AS (
  SELECT 0, i, subroot, count(*) OVER () FROM g
  UNION ALL SELECT level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (n + 1) // 2
  FROM u WHERE n > 1 GROUP BY level, i // 2, n),
below AS (SELECT d.doc_id, list({_STEP.format(own="o.i")} ORDER BY o.level) FILTER (WHERE o.n > 1) AS path
  FROM d JOIN t o ON o.tree = d.tree AND o.i = d.i >> o.level
  LEFT JOIN t s ON s.tree = o.tree AND s.level = o.level AND s.i = xor(o.i, 1) AND o.n > 1 GROUP BY d.doc_id),
above AS (SELECT g.tree, g.subroot, list({_STEP.format(own="o.i")} ORDER BY o.level) FILTER (WHERE o.n > 1) AS path
  FROM g JOIN u o ON o.i = g.i >> o.level
  LEFT JOIN u s ON s.level = o.level AND s.i = xor(o.i, 1) AND o.n > 1 GROUP BY g.tree, g.subroot),
f AS (SELECT doc_id, leaf, changed, subroot, (SELECT digest FROM u WHERE n = 1) AS root,
    list_concat(coalesce(b.path, []), coalesce(a.path, [])) AS path
  FROM d JOIN below b USING (doc_id) JOIN above a USING (tree))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(
    list_filter(path, lambda x: x <> 'N'), lambda x: substr(x, 2)), '')) AS proof_sha256,
  list_reduce(list_prepend(coalesce(changed, leaf), path), lambda x, y: sha256(CASE left(y, 1)
    WHEN 'L' THEN substr(y, 2) || x WHEN 'R' THEN x || substr(y, 2) ELSE x END)) AS folded_root,
  folded_root = root AS verified
FROM f
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_decontamination": OP5, "op8_arc_to_warc": OP8, "op12_hard_negatives": OP12, "op13_merkle_manifest": OP13,
    }
