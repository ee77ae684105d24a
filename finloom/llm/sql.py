"""DuckDB SQL for the queries of this package that SQL can express, over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

# Escaping adds one character for each `<|`, with any backslashes between; a turn is printed as
# <|im_start|>role, line break, text, <|im_end|>, line break.
CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (
  SELECT *, 24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|'))
    + len(regexp_extract_all(role, '<\\*\|')) AS printed,
    CASE WHEN role = 'assistant' THEN text ELSE '' END AS trained
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(length(trained))::BIGINT AS loss_chars,
  sha256(string_agg(trained, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(printed)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

HARD_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""

QUERIES: dict[str, str] = {"op1_exact_dedup": EXACT_DEDUP, "op6_chat": CHAT, "op13_hard_negatives": HARD_NEGATIVES}
