"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

import math

from tidemark.llm import license_scan

#: unsigned crc32 of the decimal form of a number, bit by bit
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({x}::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda d, k: xor(d >> 1, (d & 1) * 3988292384))), 4294967295)"""

OP11 = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32.format(x="conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)),
all_turns AS (
  SELECT c.conv_id, 0 AS part, o.r, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.r <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.r, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.r > c.h),
prefixes AS (
  SELECT conv_id, list(sha256(role) || sha256(text)) OVER w AS path, length(text) AS n, count(*) OVER (PARTITION BY conv_id) AS size
  FROM all_turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, r)),
reached AS (
  SELECT conv_id, path, n, len(path) = size AS last FROM prefixes
  UNION ALL
  SELECT conv_id, [], 0, conv_id NOT IN (SELECT conv_id FROM all_turns) FROM convs),
nodes AS (
  SELECT path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved, bool_and(last) AS leaf,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends
  FROM reached GROUP BY path),
subtree AS (
  SELECT list_slice(path, 1, i) AS path, sum(leaf::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT path, leaf, saved, unnest(range(len(path) + 1)) AS i FROM nodes) GROUP BY 1),
children AS (SELECT list_slice(path, 1, len(path) - 1) AS path, count(*) AS n_children FROM nodes WHERE len(path) > 0 GROUP BY 1)
SELECT n.conv_id, len(n.path)::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN subtree s ON s.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON len(n.path) > 0 AND p.path = list_slice(n.path, 1, len(n.path) - 1)"""

#: exact top 20 by inner product of the integer vectors; queries are the ids divisible by 20
OP6 = """
WITH v AS (
  SELECT vec_id, any_value(list_transform(embedding, lambda x: floor(64 * x::DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20"""


def _licenses() -> str:
    """Every window of every text against every notice: the windows that begin at a word of
    the notice, in the texts that hold enough of its words at all."""
    rows = ",\n    ".join(
        f"({k}, '{label}', {size}, {math.ceil(license_scan.CONTAINMENT * len(words) - 1e-9)}, {sorted(words)!r})"
        for k, ((label, words), size) in enumerate(zip(license_scan.template_sets(license_scan.TEMPLATES), license_scan.block_sizes(license_scan.TEMPLATES))))
    phrases = []
    for phrase, label in license_scan.PHRASES.items():
        here = " AND ".join(f"words[i + {j}] = '{w}'" for j, w in enumerate(phrase.split()))
        phrases.append(f"SELECT row, '{label}' AS label, unnest(list_filter(range(1, len(words) + 1), lambda i: coalesce({here}, false))) AS i FROM docs")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
notices(k, label, block, need, held) AS (VALUES
    {rows}),
places AS ({" UNION ALL ".join(phrases)}),
base AS (
  SELECT row, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list_distinct(list(label)) AS labels FROM places GROUP BY row),
near AS (
  SELECT d.row, d.words, n.* FROM docs d JOIN notices n ON len(list_intersect(list_distinct(d.words), n.held)) >= n.need),
windows AS (
  SELECT row, label, need, held, unnest(list_transform(list_filter(range(1, len(words) + 1), lambda i: list_contains(held, words[i])),
         lambda i: len(list_intersect(list_distinct(words[i:i + block - 1]), held)))) AS n FROM near),
more AS (
  SELECT row, list_distinct(list(label)) AS labels, max(n::DOUBLE / len(held)) AS best FROM windows WHERE n >= need GROUP BY row)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(b.n_base, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word,
       b.last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(m.best, 0.0)::DOUBLE END AS score
FROM docs d LEFT JOIN base b ON b.row = d.row LEFT JOIN more m ON m.row = d.row"""


ORACLE: dict[str, str] = {"op5_license_scan": _licenses(), "op6_exact_top_k": OP6, "op11_prefix_trie": OP11}
